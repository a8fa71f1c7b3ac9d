"""Refresh of the cleaned sales: raw lines land in batches, the clean table follows.

Cleaning one table and cleaning it in batches differ in two things.  A line that lands
later can take the place of one with the same order id, and medians and trim edges move
with all lines.  So the sink keeps the deduplicated raw lines and what the medians and
edges need, and the clean lines are a view on both:

* ``lines/batch=<n>/bucket=<b>``: lines by a hash of the order id.  A batch rewrites
  the buckets it touches, each as a new version; the other buckets aren't read.
* ``counts/batch=<n>``: how often each value that a median or an edge is taken from
  occurs, as changes against the batches before (a replaced line counts down).  Every
  ``COMPACT`` batches they are added up into one table.
* ``manifest/batch=<n>``: which versions and counts are valid after the batch.  It is
  written last: a batch that stops halfway leaves the one before in force, and a batch
  that is run again starts from the manifests before it and gives the same state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import clean
from tidemark.operators.ordered import running_totals
from tidemark.schemas import SALES
from tidemark.session import exists, measured

BUCKETS = 64
COMPACT = 16
COUNTS = "kind string, grp string, value double, n long"
MANIFEST = "item string, name string, batch long"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, sink: str, before: int | None = None) -> list[tuple[str, str, int]]:
    """Rows (item, name, batch) of the last manifest, or of the last one before a batch.

    A manifest has a row per bucket, table of counts and setting.
    """
    if not exists(spark, f"{sink}/manifest"):
        return []
    saved = spark.read.schema(f"{MANIFEST}, number long").parquet(f"{sink}/manifest")
    if before is not None:
        saved = saved.where(F.col("number") < before)
    last = saved.agg(F.max("number")).first()[0]
    return [tuple(r) for r in saved.where(F.col("number") == last).select("item", "name", "batch").collect()]


def _lines(spark: SparkSession, sink: str, versions: dict[int, int], schema: T.StructType) -> DataFrame:
    """The lines of the given versions (bucket -> batch); other buckets aren't even listed."""
    paths = [f"{sink}/lines/batch={n}/bucket={b}" for b, n in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def value_counts(lines: DataFrame) -> DataFrame:
    """Counts of the values that medians (by product type) and price edges are taken from."""
    known = lines.where(F.col("ram_gb").isNotNull() & F.col("product_type").isNotNull())
    ram = known.select(F.lit("ram_gb").alias("kind"), F.col("product_type").alias("grp"), F.col("ram_gb").cast("double").alias("value"))
    price = clean.usable_lines(lines).select(F.lit("price"), F.lit(""), F.col("price").cast("double")).toDF("kind", "grp", "value")
    return ram.unionByName(price).groupBy("kind", "grp", "value").agg(F.count(F.lit(1)).alias("n"))


def counted_quantiles(counts: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Exact, linearly interpolated quantiles per group from (grp, value, n)."""
    ranked = running_totals(counts.select("grp", "value", "n"), "value", ["n"], ["grp"])

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n")), F.col("value")))

    picks = []
    for name, q in quantiles.items():
        spot = (F.col("n_total") - 1) * F.lit(float(q))
        low = F.floor(spot)
        picks += [at(low).alias(f"_{name}_lo"), at(F.least(low + 1, F.col("n_total") - 1)).alias(f"_{name}_hi"), F.max(spot - low).alias(f"_{name}_part")]
    found = ranked.groupBy("grp").agg(*picks)
    return found.select(
        "grp", *[(F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_part")).alias(n) for n in quantiles]
    )


def merge_batch(batch: DataFrame, number: int, sink: str, buckets: int = BUCKETS) -> None:
    """Take one batch of raw lines into the sink; running it again changes nothing."""
    spark = batch.sparkSession
    columns = batch.columns
    prior = _manifest(spark, sink, number)
    setting = [n for item, _, n in prior if item == "buckets"]
    if setting and setting[0] != buckets:
        raise ValueError(f"the sink has {setting[0]} buckets")
    landed = measured(clean.dedupe_sales(batch.select(*columns)).withColumn("bucket", _bucket(buckets)), "landed")
    touched = {r["bucket"] for r in landed.select("bucket").distinct().collect()}  # at most ``buckets``
    versions = {int(name): n for item, name, n in prior if item == "lines"}
    old = _lines(spark, sink, {b: n for b, n in versions.items() if b in touched}, batch.schema)
    # at most two lines per id from here on: they are dealt by bucket once, for the deduplication and for the write
    dealt = old.withColumn("bucket", _bucket(buckets)).unionByName(landed).repartition(buckets, "bucket")
    merged = clean.dedupe_sales(dealt, F.col("bucket"))
    merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{sink}/lines/batch={number}")
    versions |= dict.fromkeys(touched, number)

    now = value_counts(clean.repair_text(_lines(spark, sink, {b: number for b in touched}, batch.schema)))
    before = value_counts(clean.repair_text(old)).withColumn("n", -F.col("n"))
    change = now.unionByName(before)
    parts = sorted(n for item, _, n in prior if item == "counts")
    if len(parts) >= COMPACT:
        change, parts = change.unionByName(_counts(spark, sink, parts)), []
    summed = change.groupBy("kind", "grp", "value").agg(F.sum("n").alias("n")).where("n <> 0")
    summed.write.mode("overwrite").parquet(f"{sink}/counts/batch={number}")

    rows = [("buckets", "", buckets), *[("lines", str(b), n) for b, n in sorted(versions.items())]]
    rows += [("counts", "", n) for n in [*parts, number]]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{sink}/manifest/number={number}")


def _counts(spark: SparkSession, sink: str, numbers: list[int]) -> DataFrame:
    if not numbers:
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(*[f"{sink}/counts/batch={n}" for n in numbers])


def current_sales(spark: SparkSession, sink: str, schema: T.StructType = SALES) -> DataFrame:
    """The clean lines of all batches so far: the rows of one ``clean_sales`` over all raw lines."""
    state = _manifest(spark, sink)
    lines = clean.repair_text(_lines(spark, sink, {int(b): n for item, b, n in state if item == "lines"}, schema))
    counts = _counts(spark, sink, [n for item, _, n in state if item == "counts"])
    counts = measured(counts.groupBy("kind", "grp", "value").agg(F.sum("n").alias("n")).where("n > 0"), "counts")
    medians = measured(counted_quantiles(counts.where("kind = 'ram_gb'"), {"_median": 0.5}), "medians")
    low, high = clean.TRIM_QUANTILES
    edges = measured(counted_quantiles(counts.where("kind = 'price'"), {"low": low, "high": high}), "edges")
    filled = lines.join(medians, lines["product_type"] == medians["grp"], "left").withColumn(
        "ram_gb", F.coalesce(F.col("ram_gb"), F.col("_median").cast(lines.schema["ram_gb"].dataType))
    ).select(*lines.columns)
    return clean.derive_sales(clean.between_edges(clean.usable_lines(filled), "price", edges))


def vacuum(spark: SparkSession, sink: str) -> int:
    """Delete the versions and counts that neither the last manifest nor the one before it needs; how many there were.

    The one before stays, so that the last batch can still be run again.
    """
    last = _manifest(spark, sink)
    if not last:
        return 0
    number = spark.read.schema(f"{MANIFEST}, number long").parquet(f"{sink}/manifest").agg(F.max("number")).first()[0]
    kept = {(item, name, n) for item, name, n in [*last, *_manifest(spark, sink, number)]}
    system_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = system_path(sink).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = 0
    for item, pattern in (("lines", "lines/batch=*/bucket=*"), ("counts", "counts/batch=*")):
        for status in system.globStatus(system_path(f"{sink}/{pattern}")) or []:
            parts = dict(p.split("=") for p in status.getPath().toString().split("/") if p.startswith(("batch=", "bucket=")))
            if (item, parts.get("bucket", ""), int(parts["batch"])) not in kept:
                system.delete(status.getPath(), True)
                gone += 1
    return gone


def sales_refresh(stream: DataFrame, sink: str, checkpoint: str, buckets: int = BUCKETS) -> None:
    """Take in all raw lines that have landed since the last run."""
    query = (
        stream.writeStream.foreachBatch(lambda batch, number: merge_batch(batch, number, sink, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
