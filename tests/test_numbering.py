from pyspark.sql import functions as F

from riskweave.operators.numbering import dense_numbers


def test_numbers_follow_the_values_and_are_dense(spark):
    rows = [(k % 5 or None, "x" if k % 3 else None, float(k // 7)) for k in range(200)] + [(9, "same", 1.0)] * 150
    first = dense_numbers(spark.createDataFrame(rows, "a int, b string, c double").repartition(7), "n")
    again = dense_numbers(spark.createDataFrame(rows[::-1], "a int, b string, c double").repartition(3), "n")
    got = sorted((r["n"], r["a"], r["b"], r["c"]) for r in first.collect())
    key = lambda r: [(v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in r]
    assert [g[1:] for g in got] == sorted(rows, key=key) and [g[0] for g in got] == list(range(350))
    assert sorted((r["n"], r["a"], r["b"], r["c"]) for r in again.collect()) == got


def test_equal_rows_are_spread_over_ranges_and_nothing_gives_nothing(spark):
    same = spark.range(5000).select(F.lit(1).alias("a"))
    plan = dense_numbers(same, "n")
    assert plan.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (0, 4999, 5000)
    assert dense_numbers(same.where("a > 1"), "n", ["a"]).count() == 0
