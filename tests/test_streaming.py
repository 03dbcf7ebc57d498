from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskweave.operators import drift
from riskweave.sources import tables
from riskweave.sources.shared import fresh_path
from riskweave.streaming import drift as streaming

EDGES = {"a": [0.0, 1.0], "b": [5.0]}
DAY = datetime(2026, 3, 1)


def rows(day, values):
    return [(DAY + timedelta(days=day, hours=k % 24), None if v is None else float(v), float(k % 9)) for k, v in enumerate(values)]


def drop_file(spark, source, data):
    spark.createDataFrame(data, "at timestamp, a double, b double").coalesce(1).write.mode("append").parquet(source)


def counted(spark, target):
    return {(r["window_start"], r["feature_name"], r["bin"]): r["actual_rows"] for r in tables.read_table(spark, target).collect()}


@pytest.fixture
def places(spark):
    return [fresh_path(spark, n) for n in ("source", "target", "checkpoint")]


def follow(spark, places, **options):
    schema = spark.createDataFrame([], "at timestamp, a double, b double").schema
    return streaming.follow(spark, places[0], schema, places[1], places[2], "at", EDGES, files_per_batch=1, **options)


def test_stream_equals_the_batch_and_goes_on_where_it_stopped(spark, places):
    source, target, _ = places
    data = [rows(0, [-1, 0, 0.5, 2]), rows(1, [None, float("nan"), 3, 3]), rows(2, [0.2] * 30), rows(1, [1.0, 1.5]), [(None, 1.0, 1.0)]]
    for part in data[:3]:
        drop_file(spark, source, part)
    assert follow(spark, places) == 3
    for part in data[3:]:  # a day that was counted before gets more rows, within the allowed lateness
        drop_file(spark, source, part)
    assert follow(spark, places) == 2 and follow(spark, places) == 0
    whole = streaming.window_counts(spark.read.parquet(source), "at", EDGES, "1 day", "2 days")
    want = {(r["window_start"], r["feature_name"], r["bin"]): r["actual_rows"] for r in whole.collect()}
    assert counted(spark, target) == want and want[DAY + timedelta(days=1), "a", 1] == 1


def test_rows_of_closed_windows_are_dropped(spark, places):
    source, target, _ = places
    drop_file(spark, source, rows(0, [0.5]))
    drop_file(spark, source, rows(9, [0.5]))
    follow(spark, places, lateness="1 day")
    before = counted(spark, target)
    drop_file(spark, source, rows(0, [0.5, 0.5]) + rows(8, [2.0]))
    follow(spark, places, lateness="1 day")
    after = counted(spark, target)
    assert {k: v for k, v in after.items() if k in before} == before
    assert after[DAY + timedelta(days=8), "a", 2] == 1 and after[DAY, "a", 1] == 1


def test_window_drift_equals_the_batch_index(spark):
    base = spark.createDataFrame([(float(k % 7) / 3, float(k % 11)) for k in range(200)], "a double, b double")
    edges = drift.fit_edges(base, ["a", "b"], 5)
    days = {0: [(float(k % 5) / 2, float(k % 4)) for k in range(50)], 1: [(9.0, 0.0)] * 20}
    stamped = spark.createDataFrame([(DAY + timedelta(days=d), *v) for d, values in days.items() for v in values], "at timestamp, a double, b double")
    counts = streaming.window_counts(stamped, "at", edges, "1 day", "1 day")
    got = {(r["window_start"], r["feature_name"]): (r["psi_score"], r["drift_status"]) for r in streaming.window_drift(counts, streaming.expected_shares(base, edges)).collect()}
    for d in days:
        part = stamped.where(F.col("at") == DAY + timedelta(days=d))
        want = drift.psi_from_histogram(drift.drift_histogram(base, part, edges)).collect()
        assert {f: got[DAY + timedelta(days=d), f] for f in edges} == {r["feature_name"]: (r["psi_score"], r["drift_status"]) for r in want}
