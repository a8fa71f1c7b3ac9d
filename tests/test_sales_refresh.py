"""Sales that land in batches next to one cleaning of everything."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import clean
from tidemark.schemas import SALES
from tidemark.streaming import refresh, sales


def lines(rng, ids):
    out = []
    for i in ids:
        day = dt.date(2024, rng.randint(1, 12), rng.randint(1, 28))
        out.append((
            i, f"c{rng.randrange(9)}", rng.choice(["laptop ", "Phone", None]), "b", None, rng.choice([4.0, 8.0, 16.0, None]), 64.0,
            rng.choice([None, 0, 10, 10, 12, *[rng.randrange(1, 900)] * 4]), rng.choice([1, 2, 3, 4, None]), rng.choice(["north", "South ", "east", "nan", None]),
            rng.choice([day, day, day, None]), day + dt.timedelta(rng.randrange(5)), rng.choice([15, 30, 60, None]), "f", "x",
        ))
    return out


def table(spark, rows):
    from decimal import Decimal

    return spark.createDataFrame([(*r[:7], None if r[7] is None else Decimal(r[7]), *r[8:]) for r in rows], SALES)


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / n) for n in ("in", "sink", "mark")]


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_batches_give_the_rows_of_one_cleaning(spark, places):
    rng = random.Random(1)
    source, sink, mark = places
    first, second, third = lines(rng, range(200)), lines(rng, range(150, 320)), lines(rng, [5, 5, 7, 400, None, None])
    second += first[20:60]                     # repeated in full, in another file
    landed = []
    for part in (first, second, third):
        landed += part
        table(spark, part).coalesce(2).write.mode("append").parquet(source)
        sales.sales_refresh(refresh.landing(spark, source, SALES), sink, mark, buckets=8)
        assert rows_of(sales.current_sales(spark, sink)) == rows_of(clean.clean_sales(table(spark, landed)))
    assert len(rows_of(sales.current_sales(spark, sink))) > 50


def test_a_batch_run_again_changes_nothing(spark, places):
    rng = random.Random(2)
    _, sink, _ = places
    parts = [table(spark, lines(rng, range(k * 40, k * 40 + 60))) for k in range(3)]
    for number, part in enumerate(parts):
        sales.merge_batch(part, number, sink, 8)
    want, state = rows_of(sales.current_sales(spark, sink)), sorted(sales._manifest(spark, sink))
    sales.merge_batch(parts[2], 2, sink, 8)
    assert rows_of(sales.current_sales(spark, sink)) == want and sorted(sales._manifest(spark, sink)) == state
    assert sales.vacuum(spark, sink) > 0 and rows_of(sales.current_sales(spark, sink)) == want
    sales.merge_batch(parts[2], 2, sink, 8)    # the manifest before it is still whole
    assert rows_of(sales.current_sales(spark, sink)) == want


def test_untouched_buckets_are_left_alone_and_counts_compacted(spark, places, monkeypatch):
    monkeypatch.setattr(sales, "COMPACT", 2)
    rng = random.Random(3)
    _, sink, _ = places
    sales.merge_batch(table(spark, lines(rng, range(100))), 0, sink, 16)
    one = table(spark, lines(rng, [3]))
    home = one.select(sales._bucket(16)).first()[0]
    for number in range(1, 5):
        sales.merge_batch(one, number, sink, 16)
        state = sales._manifest(spark, sink)
        assert {b for item, b, n in state if item == "lines" and n == number} == {str(home)}
        assert len([n for item, _, n in state if item == "counts"]) <= 2
    sales.merge_batch(one.limit(0), 5, sink, 16)
    every = table(spark, []).unionByName(spark.read.schema(SALES).parquet(f"{sink}/lines/batch=0").drop("bucket"))
    assert sales.current_sales(spark, sink).count() == clean.clean_sales(every.unionByName(one)).count()
    with pytest.raises(ValueError, match="16 buckets"):
        sales.merge_batch(one, 6, sink, 8)


def test_counted_quantiles_are_those_of_the_rows(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), float(rng.randrange(12))) for _ in range(501)] + [("c", 3.0)]
    df = spark.createDataFrame(rows, "grp string, value double")
    counts = df.groupBy("grp", "value").agg(F.count(F.lit(1)).alias("n"))
    got = {r.grp: (r.lo, r.mid) for r in sales.counted_quantiles(counts, {"lo": 0.1, "mid": 0.5}).collect()}
    want = df.groupBy("grp").agg(F.percentile("value", F.lit(0.1)).alias("lo"), F.percentile("value", F.lit(0.5)).alias("mid"))
    assert {r.grp: pytest.approx((r.lo, r.mid)) for r in want.collect()} == got


def test_a_batch_deals_its_lines_once(spark, places, monkeypatch):
    """The shuffle by bucket serves the deduplication and the write."""
    rng = random.Random(3)
    plans, whole = [], clean.dedupe_sales

    def seen(raw, together=None):
        out = whole(raw, together)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(clean, "dedupe_sales", seen)
    for number in range(2):
        sales.merge_batch(table(spark, lines(rng, range(number * 40, number * 40 + 60))), number, places[1], 8)
    merged = plans[1::2]
    assert len(merged) == 2 and all(p.count("Exchange ") == p.count("Exchange hashpartitioning(bucket") == 1 for p in merged)
