from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from riskweave.operators import models, registry
from riskweave.sources import committed, tables
from riskweave.sources.committed import Committed
from riskweave.sources.shared import fresh_path


@pytest.fixture
def table(spark):
    return Committed(spark, fresh_path(spark, "committed"))


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, v string")


def held(df):
    return sorted((r["k"] is not None, r["k"] or 0, r["v"]) for r in df.collect())


def test_a_name_is_claimed_once(spark):
    path = fresh_path(spark, "claims")
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda k: committed.claim(spark, f"{path}/one.json", f"writer {k}"), range(64)))
    assert won.count(True) == 1
    assert spark.read.text(f"{path}/one.json").first()["value"] == f"writer {won.index(True)}"


def test_versions_append_overwrite_and_vacuum(spark, table):
    assert table.state().version == 0 and not committed.is_committed(spark, table.path)
    with pytest.raises(FileNotFoundError):
        table.read()
    assert [table.append(frame(spark, [(1, "a")])), table.append(frame(spark, [(2, "b")])), table.overwrite(frame(spark, [(3, "c")]))] == [1, 2, 3]
    assert held(table.read(2)) == [(True, 1, "a"), (True, 2, "b")]
    assert held(tables.read_table(spark, table.path)) == [(True, 3, "c")]
    assert table.append(lambda state: None) == 3
    assert table.vacuum(keep=2) == 1 and table.vacuum(keep=1) == 1 and table.versions() == [3]
    assert held(table.read()) == [(True, 3, "c")]


def test_writers_at_the_same_time_lose_nothing(spark, table):
    start = Barrier(6)

    def write(k):
        start.wait()
        return table.append(frame(spark, [(k, "x")]))

    with ThreadPoolExecutor(6) as pool:
        versions = list(pool.map(write, range(6)))
    assert sorted(versions) == [1, 2, 3, 4, 5, 6]
    assert [k for _, k, _ in held(table.read())] == list(range(6))


def test_two_registrations_get_two_versions(spark):
    rows = spark.createDataFrame([(float(k), k % 2) for k in range(20)], "x double, y int")
    model = models.fit("logistic", rows, ["x"], "y", {"maxIter": 1})
    store, where, start = fresh_path(spark, "registry"), fresh_path(spark, "models"), Barrier(2)

    def write(k):
        start.wait()
        return registry.register(spark, store, "risk", model, where, "Champion", {"auc": k / 10}, f"t{k}")

    with ThreadPoolExecutor(2) as pool:
        versions = list(pool.map(write, range(2)))
    rows = tables.read_table(spark, store).orderBy("version").collect()
    assert sorted(versions) == [1, 2] == [r["version"] for r in rows]
    assert [r["set_no"] for r in rows] == [1, 2] and len({r["path"] for r in rows}) == 2
    # a repeated step finds its version, and adds neither a row nor a model
    for _ in range(2):
        assert registry.register(spark, store, "risk", model, where, "Champion", {}, "t3", run="run-1/train") == 3
    assert tables.read_table(spark, store).count() == 3


def batches(spark):
    first = frame(spark, [(k, "old") for k in range(300)] + [(None, "old")])
    second = frame(spark, [(7, "new"), (400, "new"), (None, "new")])
    third = frame(spark, [(7, "newer"), (8, "newer")])
    return first, second, third


def test_upsert_equals_a_rebuild_and_leaves_other_buckets_alone(spark, table):
    parts = batches(spark)
    want = {}
    for n, part in enumerate(parts, 1):
        before = dict(table.state().live)
        assert table.upsert(part, ["k"], buckets=16) == n
        want |= {r["k"]: r["v"] for r in part.collect()}
        after = table.state().live
        touched = {str(r["b"]) for r in part.select(F.pmod(F.xxhash64("k"), F.lit(16)).alias("b")).distinct().collect()}
        assert {b for b in after if before.get(b) != after[b]} == touched
        assert {r["k"]: r["v"] for r in table.read().collect()} == want
    first, last = table.state(1).live, table.state().live
    untouched = [b for b in first if last[b] == first[b]]
    names = lambda version: {f.split("/data/")[1] for f in table.read(version).inputFiles()}
    kept = {f for f in names(1) for b in untouched if f.startswith(first[b].split("/", 1)[1] + "/")}
    assert len(untouched) >= 10 and len(kept) >= 10 and kept <= names(3) and table.read().columns == ["k", "v"]


def test_upsert_adds_columns_and_refuses_repeated_keys(spark, table):
    table.upsert(frame(spark, [(1, "a"), (2, "b")]), ["k"], buckets=4)
    table.upsert(spark.createDataFrame([(2, "c", 0.5)], "k long, v string, w double"), ["k"])
    assert {(r["k"], r["v"], r["w"]) for r in table.read().collect()} == {(1, "a", None), (2, "c", 0.5)}
    with pytest.raises(ValueError, match="comes twice"):
        table.upsert(frame(spark, [(9, "a"), (9, "b")]), ["k"])
    with pytest.raises(ValueError, match="not keyed"):
        table.upsert(frame(spark, [(9, "a")]), ["v"])
    assert table.state().version == 2


def test_upserts_at_the_same_time(spark, table):
    table.upsert(frame(spark, [(k, "old") for k in range(40)]), ["k"], buckets=4)
    start = Barrier(3)

    def write(n):
        start.wait()
        return table.upsert(frame(spark, [(n, f"w{n}"), (100 + n, "new")]), ["k"])

    with ThreadPoolExecutor(3) as pool:
        assert sorted(pool.map(write, range(3))) == [2, 3, 4]
    rows = {r["k"]: r["v"] for r in table.read().collect()}
    assert rows == {**{k: "old" for k in range(40)}, 0: "w0", 1: "w1", 2: "w2", 100: "new", 101: "new", 102: "new"}
