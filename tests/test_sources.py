import pytest
from pyspark.sql import functions as F

from riskweave.functions import text as tx
from riskweave.sources import files, tables
from riskweave.sources.shared import fresh_path


def test_csv_names_are_sanitized(spark, tmp_path):
    (tmp_path / "in.csv").write_text("Credit amount,Sex\n10,male\n20,female\n")
    df = files.sanitize_names(files.scan_csv(spark, str(tmp_path / "in.csv")))
    assert df.columns == ["Credit_amount", "Sex"]
    assert dict(df.dtypes)["Credit_amount"] == "int"
    typed = files.scan_csv(spark, str(tmp_path / "in.csv"), "a long, b string")
    assert typed.agg(F.sum("a")).first()[0] == 30


def test_text_file_becomes_paragraphs(spark, tmp_path):
    long_head = "x" * 90 + ": late marker"
    (tmp_path / "policy.txt").write_text(f"LENDING: be fair.\n\n\n\n  plain words here \n\n{long_head}")
    df = files.split_paragraphs(files.scan_text(spark, str(tmp_path)), ["source_path"], ingested_at="2026-01-01")
    rows = df.orderBy("paragraph_id").collect()
    assert [r["paragraph_id"] for r in rows] == [1, 2, 3]
    assert [r["section"] for r in rows] == ["LENDING", "GENERAL", "GENERAL"]
    assert rows[1]["text"] == "plain words here" and rows[1]["word_count"] == 3
    assert rows[1]["char_count"] == 16 and rows[1]["ingestion_timestamp"] == "2026-01-01"


def test_missing_table_reads_as_empty(spark):
    df = tables.read_or_empty(spark, fresh_path(spark, "nothing"), "a int, b string")
    assert df.columns == ["a", "b"] and df.count() == 0
    assert tables.read_or_empty(spark, "no_such_table", "a int").count() == 0


def test_read_or_empty_does_not_hide_other_errors(spark, tmp_path):
    (tmp_path / "broken.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        tables.read_or_empty(spark, str(tmp_path), "a int").collect()


def test_overwrite_append_and_latest_run(spark):
    path = fresh_path(spark, "t")
    one, two = spark.range(3), spark.range(5)
    tables.save_table(one, path)
    tables.save_table(two, path)
    assert tables.read_table(spark, path).count() == 5
    history = fresh_path(spark, "h")
    tables.append_history(one, history, "r2", "2026-01-01")
    tables.append_history(two, history, "r1", "2026-02-01")
    assert tables.latest_run(tables.read_table(spark, history)).count() == 5


def test_catalog_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS gold LOCATION '{tmp_path}/gold'")
    tables.save_table(spark.range(4), "gold.numbers")
    tables.save_table(spark.range(2), "gold.numbers", mode="append")
    assert tables.read_table(spark, "gold.numbers").count() == 6
    spark.sql("DROP DATABASE gold CASCADE")


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 2, "c")], "k int, t int, x string")
    got = {r["k"]: r["x"] for r in tables.latest_per_key(df, ["k"], ["t"]).collect()}
    assert got == {1: "b", 2: "c"}


@pytest.mark.parametrize("size, expected", [(0, [0]), (1, [1]), (500, [500]), (501, [500, 51]), (950, [500, 500]), (951, [500, 500, 51])])
def test_chunk_lengths(spark, size, expected):
    text = "".join(chr(97 + i % 26) for i in range(size))
    parts = spark.createDataFrame([(text,)], "t string").select(tx.chunks(F.col("t"))).first()[0]
    assert [len(p) for p in parts] == expected
    assert parts[0] + "".join(p[50:] for p in parts[1:]) == text
