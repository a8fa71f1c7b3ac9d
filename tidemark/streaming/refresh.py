"""Refresh jobs: each run takes what has landed since the last one and stops.

The checkpoint folder remembers what was read.  Batch sinks write every batch
to its own ``batch=<id>`` folder and overwrite it on a retry, so a batch that
is run twice after a failure still counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.clean import keep_first
from tidemark.operators.growth import drop_alerts, month_growth, monthly_revenue
from tidemark.session import measured


def landing(
    spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A stream over the files that land under ``path`` (a folder or a glob)."""
    reader = spark.readStream.schema(schema).format(kind)
    if kind == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def write_batches(stream: DataFrame, sink: str, checkpoint: str, each: Callable[[DataFrame], DataFrame], mode: str = "append") -> None:
    """Run ``each`` on every pending batch and keep its rows under the batch id."""

    def keep(batch: DataFrame, number: int) -> None:
        each(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(keep)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def incremental_refresh(
    stream: DataFrame, sink: str, checkpoint: str, clean: Callable[[DataFrame], DataFrame]
) -> None:
    """Clean what is new and append it to the fact under ``sink``."""
    write_batches(stream, sink, checkpoint, clean)


def deduped(stream: DataFrame, keys: Sequence[str], event_time: str, lateness: str) -> DataFrame:
    """Skip keys seen within ``lateness``; older rows are dropped and older keys forgotten.

    Only for streams where that is meant; ``append_new`` knows every key for good.
    """
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(keys))


def append_new(stream: DataFrame, sink: str, checkpoint: str, keys: Sequence[str], buckets: int = 64) -> None:
    """Append the rows whose key no earlier batch has brought, however late they come.

    Of several rows with one key in a batch the first in the order of all columns
    stays.  Keys are looked up in the sink itself, so nothing is kept as state and
    nothing is forgotten; a batch that is run again sees the batches before it only.
    The sink is kept by a hash of the keys, and only the hashes that a batch has are
    read again.
    """

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        placed = batch.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        first = measured(keep_first(placed, [*keys, "bucket"], list(batch.columns)), "batch")
        touched = [r["bucket"] for r in first.select("bucket").distinct().collect()]  # at most ``buckets``
        schema = T.StructType([*placed.schema.fields, T.StructField("batch", T.LongType())])
        spark.createDataFrame([], batch.schema).write.mode("ignore").parquet(f"{sink}/batch=-1/bucket=-1")
        saved = spark.read.schema(schema).option("basePath", sink).parquet(sink)
        known = saved.where((F.col("batch") < number) & F.col("bucket").isin(touched)).select(*keys)
        fresh = first.join(known, list(keys), "left_anti")
        fresh.select(*batch.columns, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{sink}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_files(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Append-only file sink; each batch is committed exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def windowed_totals(stream: DataFrame, event_time: str, amount: str, width: str = "1 day") -> DataFrame:
    """Revenue and count of every event with the start of its time bucket, for ``keep_current`` to sum.

    Nothing is kept as state, so an event counts however late it comes.  Events
    without a time are in no bucket.
    """
    return stream.select(
        F.window(event_time, width)["start"].alias("bucket_start"),
        F.col(amount).cast("decimal(14,2)").alias("revenue"),
        F.lit(1).cast("long").alias("events"),
    )


COMPACT = 16  # every so many batches the sums so far become one


def _since_compaction(spark: SparkSession, sink: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """The sums that add up to the totals, of all batches or of those before one: the last compacted batch and what follows it."""
    saved = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(sink)
    if before is not None:
        saved = saved.where(F.col("batch") < before)
    last = saved.agg(F.max("batch")).first()[0]
    return saved.where(F.col("batch") >= (last or 0) // COMPACT * COMPACT).drop("batch")


def keep_current(totals: DataFrame, sink: str, checkpoint: str, key: str = "bucket_start") -> None:
    """Every batch writes its own sums of the buckets it touches.

    Each ``COMPACT``-th batch writes the sums of all batches up to it, so a reader never
    needs more than ``COMPACT`` of them; ``drop_compacted`` deletes the others.
    """
    rest = [c for c in totals.columns if c != key]
    kind = totals.schema

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(*[F.sum(c).cast(kind[c].dataType).alias(c) for c in rest])

    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = summed(batch).select(*totals.columns)
        if number and number % COMPACT == 0:
            own = summed(own.unionByName(_since_compaction(spark, sink, kind, number))).select(*totals.columns)
        own.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    query = (
        totals.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current_totals(spark: SparkSession, sink: str, key: str = "bucket_start") -> DataFrame:
    """The sums of all batches for every bucket."""
    kind = T.StructType([f for f in spark.read.parquet(sink).schema if f.name != "batch"])
    rest = [f for f in kind if f.name != key]
    saved = _since_compaction(spark, sink, kind)
    return saved.groupBy(key).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in rest])


def drop_compacted(spark: SparkSession, sink: str) -> int:
    """Delete the batches that a later compacted one holds already; how many there were.

    The batches since the compaction before stay, so that the last one can be run again.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(sink).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {int(s.getPath().getName().split("=")[1]): s.getPath() for s in system.globStatus(path(f"{sink}/batch=*")) or []}
    first = (max(found, default=0) - 1) // COMPACT * COMPACT
    gone = [p for n, p in found.items() if n < first]
    for p in gone:
        system.delete(p, True)
    return len(gone)


REVISION = "start_ms long, cents long, events long, version long, correction boolean"
REVISED = "cents long, events long, version long"


def _task_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per bucket of every Arrow batch, so that a hot bucket is not shuffled event by event."""
    for batch in batches:
        yield batch.groupby(["start_ms", "end_ms", "bucket_start"], as_index=False)[["cents", "events"]].sum()


def _revise(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Add a batch's sums to the bucket's state and give its new totals."""
    start_ms, end_ms = key
    cents, events, version = state.get if state.exists else (0, 0, 0)
    for batch in batches:
        cents, events = cents + int(batch["cents"].sum()), events + int(batch["events"].sum())
    version += 1
    state.update((cents, events, version))
    closed = end_ms <= state.getCurrentWatermarkMs()
    yield pd.DataFrame({"start_ms": [start_ms], "cents": [cents], "events": [events], "version": [version], "correction": [closed]})


def revised_totals(stream: DataFrame, event_time: str, amount: str, width: str = "1 day", lateness: str = "7 days") -> DataFrame:
    """A row per time bucket and batch that changes it: the bucket's totals so far and the row's version.

    Totals are kept as keyed state, one small row per bucket, and nothing is
    dropped for being late.  A bucket is closed once a bucket that starts
    ``lateness`` after its end has been seen in an earlier batch; a row that
    changes a closed bucket is marked as a ``correction``.  A missing amount counts
    as an event of no revenue; events without a time are in no bucket.
    """
    bucket = F.window(event_time, width)
    placed = stream.select(
        F.unix_millis(bucket["start"]).alias("start_ms"),
        F.unix_millis(bucket["end"]).alias("end_ms"),
        bucket["start"].alias("bucket_start"),
        F.coalesce((F.col(amount).cast("decimal(14,2)") * 100).cast("long"), F.lit(0)).alias("cents"),
        F.lit(1).cast("long").alias("events"),
    )
    revised = (
        placed.mapInPandas(_task_sums, placed.schema)
        .withWatermark("bucket_start", lateness)
        .groupBy("start_ms", "end_ms")
        .applyInPandasWithState(_revise, REVISION, REVISED, "update", GroupStateTimeout.NoTimeout)
    )
    return revised.select(
        F.timestamp_millis("start_ms").alias("bucket_start"),
        (F.col("cents").cast("decimal(20,0)") / 100).cast("decimal(20,2)").alias("revenue"),
        "events", "version", "correction",
    )


def keep_revisions(revisions: DataFrame, sink: str, checkpoint: str, partitions: int = 16) -> None:
    """Write every batch's revisions under its id; the state lies in the checkpoint folder.

    State has one row per bucket, so it needs few partitions, however many events
    there are; their number is fixed by the first run.
    """
    spark = revisions.sparkSession
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        write_batches(revisions, sink, checkpoint, lambda batch: batch, mode="update")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def latest_revisions(spark: SparkSession, sink: str) -> DataFrame:
    """Every bucket's last totals, how many versions it had and how many of them were corrections."""
    newest = F.max_by(F.struct("revenue", "events"), "version").alias("_last")
    return (
        spark.read.parquet(sink).groupBy("bucket_start")
        .agg(newest, F.count(F.lit(1)).alias("versions"), F.count_if("correction").alias("corrections"))
        .select("bucket_start", "_last.revenue", "_last.events", "versions", "corrections")
    )


def batch_score(stream: DataFrame, sink: str, checkpoint: str, scorer: Callable[[DataFrame], DataFrame]) -> None:
    """Score every new entity-month with a fitted model."""
    write_batches(stream, sink, checkpoint, scorer)


def alert_refresh(stream: DataFrame, fact_sink: str, alert_sink: str, checkpoint: str, limit_pct: float = 10.0) -> None:
    """Append every batch's monthly revenue and re-check the growth over all months."""

    def check(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        monthly_revenue(batch).write.mode("overwrite").parquet(f"{fact_sink}/batch={number}")
        so_far = spark.read.parquet(fact_sink)
        monthly = so_far.groupBy("month").agg(F.sum("monthly_revenue").alias("monthly_revenue"))
        alerts = drop_alerts(month_growth(monthly), limit_pct)
        alerts.write.mode("overwrite").parquet(alert_sink)

    query = (
        stream.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
