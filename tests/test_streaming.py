"""Refresh jobs: new files only, restarts, duplicates and alerts."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.streaming import refresh

SCHEMA = "id int, ts timestamp, value double"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_refresh_takes_only_new_files(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    run = lambda: refresh.incremental_refresh(
        refresh.landing(spark, source, schema(spark)), sink, mark, lambda b: b.where("value > 0")
    )
    land(spark, source, [(1, at(1), 5.0), (2, at(1), -1.0)])
    run()
    assert spark.read.parquet(sink).count() == 1
    run()
    assert spark.read.parquet(sink).count() == 1
    land(spark, source, [(3, at(2), 7.0)])
    run()
    assert {r.id for r in spark.read.parquet(sink).collect()} == {1, 3}


def test_dedupe_spans_refreshes(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    run = lambda: refresh.append_files(
        refresh.deduped(refresh.landing(spark, source, schema(spark)), ["id"], "ts", "10 days"), sink, mark
    )
    land(spark, source, [(1, at(1), 5.0), (1, at(1), 5.0), (2, at(1), 5.0)])
    run()
    land(spark, source, [(2, at(2), 5.0), (3, at(2), 5.0)])
    run()
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [1, 2, 3]


def test_windows_stay_current(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    run = lambda: refresh.keep_current(
        refresh.windowed_totals(refresh.landing(spark, source, schema(spark)), "ts", "value"), sink, mark
    )
    land(spark, source, [(1, at(1, 3), 5.0), (2, at(2, 4), 2.5)])
    run()
    land(spark, source, [(3, at(2, 9), 1.5)])
    run()
    got = {r.bucket_start.day: (float(r.revenue), r.events) for r in refresh.current_totals(spark, sink).collect()}
    assert got == {1: (5.0, 1), 2: (4.0, 2)}


def test_late_events_count_in_their_window(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    run = lambda: refresh.keep_current(
        refresh.windowed_totals(refresh.landing(spark, source, schema(spark)), "ts", "value"), sink, mark
    )
    land(spark, source, [(1, at(1, 3), 5.0), (2, at(20, 4), 2.5)])
    run()
    land(spark, source, [(3, at(21), 1.0)])
    run()
    land(spark, source, [(4, at(1, 9), 1.5), (5, at(1, 10), None), (6, None, 9.0)])   # weeks behind the newest event
    run()
    got = {r.bucket_start.day: (float(r.revenue), r.events) for r in refresh.current_totals(spark, sink).collect()}
    assert got == {1: (6.5, 3), 20: (2.5, 1), 21: (1.0, 1)}


def test_sums_are_compacted_and_nothing_is_lost(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(refresh, "COMPACT", 2)
    source, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for k in range(6):
        land(spark, source, [(k, at(1 + k % 2, k), float(k)), (k, at(9), 1.0)])
        refresh.keep_current(refresh.windowed_totals(refresh.landing(spark, source, schema(spark)), "ts", "value"), sink, mark)
    totals = lambda: {r.bucket_start.day: (float(r.revenue), r.events) for r in refresh.current_totals(spark, sink).collect()}
    want = {1: (6.0, 3), 2: (9.0, 3), 9: (6.0, 6)}
    assert totals() == want
    assert refresh.drop_compacted(spark, sink) == 4 and totals() == want


def test_a_late_event_corrects_a_closed_bucket(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    usual = spark.conf.get("spark.sql.shuffle.partitions")

    def run():
        stream = refresh.landing(spark, source, schema(spark))
        refresh.keep_revisions(refresh.revised_totals(stream, "ts", "value", lateness="3 days"), sink, mark, partitions=2)

    land(spark, source, [(1, at(1, 3), 5.0), (2, at(1, 4), 2.25), (3, at(2), 1.0)])
    run()
    land(spark, source, [(4, at(20), 1.0), (5, at(2, 5), 4.0)])              # day 2 is still open
    run()
    run()                                                                     # nothing new, nothing revised
    land(spark, source, [(6, at(1, 9), -0.5), (7, at(1, 10), None), (8, None, 9.0), (9, at(19), 3.0)])
    run()
    rows = sorted((r.bucket_start.day, r.version, float(r.revenue), r.events, r.correction) for r in spark.read.parquet(sink).collect())
    assert rows == [
        (1, 1, 7.25, 2, False), (1, 2, 6.75, 4, True),
        (2, 1, 1.0, 1, False), (2, 2, 5.0, 2, False),
        (19, 1, 3.0, 1, False), (20, 1, 1.0, 1, False),
    ]
    got = {r.bucket_start.day: (float(r.revenue), r.events, r.versions, r.corrections) for r in refresh.latest_revisions(spark, sink).collect()}
    assert got == {1: (6.75, 4, 2, 1), 2: (5.0, 2, 2, 0), 19: (3.0, 1, 1, 0), 20: (1.0, 1, 1, 0)}
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual


def test_alerts_follow_the_running_totals(spark, tmp_path):
    source, fact, alerts, mark = (str(tmp_path / n) for n in ("in", "fact", "alerts", "mark"))
    lines = "inward_date date, revenue double"
    kind = spark.createDataFrame([], lines).schema
    write = lambda rows: spark.createDataFrame(rows, lines).coalesce(1).write.mode("append").parquet(source)
    run = lambda: refresh.alert_refresh(refresh.landing(spark, source, kind), fact, alerts, mark)
    write([(dt.date(2024, 1, 3), 100.0), (dt.date(2024, 2, 3), 60.0)])
    run()
    assert [r.month_num for r in spark.read.parquet(alerts).collect()] == [2]
    write([(dt.date(2024, 2, 20), 35.0), (dt.date(2024, 3, 1), 10.0)])
    run()
    assert [r.month_num for r in spark.read.parquet(alerts).collect()] == [3]


def test_batch_scores_land_once_per_batch(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    land(spark, source, [(1, at(1), 5.0)])
    land(spark, source, [(2, at(2), 9.0)])
    stream = refresh.landing(spark, source, schema(spark), files_per_batch=1)
    refresh.batch_score(stream, sink, mark, lambda b: b.withColumn("score", F.col("value") / 10))
    saved = spark.read.parquet(sink)
    assert saved.select("batch").distinct().count() == 2
    assert {(r.id, r.score) for r in saved.collect()} == {(1, 0.5), (2, 0.9)}


def test_keyed_append_loses_no_late_row_and_knows_keys_for_good(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    run = lambda: refresh.append_new(
        refresh.landing(spark, source, schema(spark), files_per_batch=1), sink, mark, ["id"]
    )
    land(spark, source, [(1, at(20), 5.0), (1, at(20), 4.0), (2, at(20), 5.0)])
    run()
    land(spark, source, [(2, at(28), 9.0), (3, at(1), 5.0)])   # a known key, and a row weeks late
    run()
    land(spark, source, [(1, at(28), 9.0), (4, at(28), 5.0)])
    run()
    rows = sorted((r.id, r.value) for r in spark.read.parquet(sink).collect())
    assert rows == [(1, 4.0), (2, 5.0), (3, 5.0), (4, 5.0)]
