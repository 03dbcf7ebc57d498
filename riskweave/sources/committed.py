"""Tables whose state is a numbered manifest. Writers store their data first and then claim the next number, which one gets.

A manifest lists the folders that make up the table. Readers take the highest number, so they see all of a commit or
nothing of it; a writer that lost looks at the new state and tries again. Old versions stay readable until ``vacuum``.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.sources.shared import remove

_MANIFESTS, _DATA = "_manifests", "data"
_ATTEMPTS = 50


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def is_committed(spark: SparkSession, path: str) -> bool:
    files, folder = _file_system(spark, f"{path}/{_MANIFESTS}")
    return files.exists(folder)


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with its whole content, or return false if it exists already.

    The content is written beside it and then put in place in one step that fails on an existing name: a hard link where
    the path is a local or mounted one, a rename elsewhere. A store whose rename replaces files is no place for this.
    """
    files, target = _file_system(spark, path)
    beside = f"{path}.{uuid.uuid4().hex}"
    if files.getScheme() == "file":
        own, whole = (unquote(urlparse(p).path) if "://" in p or p.startswith("file:") else p for p in (beside, path))
        os.makedirs(os.path.dirname(own), exist_ok=True)
        with open(own, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(own, whole)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    _, other = _file_system(spark, beside)
    stream = files.create(other, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not files.exists(target) and files.rename(other, target):
        return True
    files.delete(other, False)
    return False


@dataclass(frozen=True)
class State:
    """One version: folders by name, relative to the table, and what the table is keyed by."""

    version: int = 0
    live: Mapping[str, str] = field(default_factory=dict)
    layout: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Committed:
    spark: SparkSession
    path: str

    def versions(self) -> list[int]:
        files, folder = _file_system(self.spark, f"{self.path}/{_MANIFESTS}")
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def state(self, version: int | None = None) -> State:
        """The given version, or the latest; version 0 is the table before its first commit."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return State()
        text = self.spark.read.text(self._manifest(version), wholetext=True).first()["value"]
        return State(version, **json.loads(text))

    def _manifest(self, version: int) -> str:
        return f"{self.path}/{_MANIFESTS}/{version:020d}.json"

    def read(self, version: int | None = None) -> DataFrame:
        return self.frame(self.state(version))

    def frame(self, state: State) -> DataFrame:
        if not state.live:
            raise FileNotFoundError(f"PATH_NOT_FOUND: {self.path} has no rows yet")
        folders = sorted({f"{self.path}/{f}" for f in state.live.values()})
        return self.spark.read.option("mergeSchema", True).parquet(*folders)

    def store(self, df: DataFrame) -> str:
        """Write rows to a folder of their own, which no reader sees before it is committed."""
        folder = f"{_DATA}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        return folder

    def try_commit(self, base: State, live: Mapping[str, str], layout: Mapping | None = None) -> bool:
        """Make ``live`` the version after ``base``, unless another writer did so first."""
        text = json.dumps({"live": dict(live), "layout": dict(base.layout if layout is None else layout)}, sort_keys=True)
        return claim(self.spark, self._manifest(base.version + 1), text)

    def append(self, rows: DataFrame | Callable[[State], DataFrame | None]) -> int:
        """Add rows and return the version that holds them.

        Rows that depend on the table are made by a function of its state, which is called again if another writer was
        first; it may return None when there is nothing to add. Plain rows are stored once, and only claimed again.
        """
        folder, made_for = None, None
        for _ in range(_ATTEMPTS):
            state = self.state()
            if folder is None or (callable(rows) and made_for != state.version):
                if folder:
                    remove(self.spark, f"{self.path}/{folder}")
                new = rows(state) if callable(rows) else rows
                if new is None:
                    return state.version
                folder, made_for = self.store(new), state.version
            if self.try_commit(state, {**state.live, folder: folder}):
                return state.version + 1
        raise RuntimeError(f"{self.path}: {_ATTEMPTS} commits in a row were lost to other writers")

    def overwrite(self, rows: DataFrame) -> int:
        """Replace the table; readers of the version before keep it."""
        folder = self.store(rows)
        for _ in range(_ATTEMPTS):
            state = self.state()
            if self.try_commit(state, {folder: folder}, {}):
                return state.version + 1
        raise RuntimeError(f"{self.path}: {_ATTEMPTS} commits in a row were lost to other writers")

    def upsert(self, rows: DataFrame, keys: Sequence[str], buckets: int = 64) -> int:
        """Insert or replace rows by key, writing only the hash buckets that ``rows`` touch.

        The number of buckets is fixed by the first commit. A key must come once in ``rows`` (a null key is one value like
        any other). Buckets that are not touched keep their files. If another writer commits meanwhile, only buckets that
        both touched are merged again. Missing columns on either side are null.
        """
        layout = {"keys": list(keys), "buckets": buckets}
        given = None
        for _ in range(_ATTEMPTS):
            state = self.state()
            if state.version and state.layout.get("keys") != list(keys):
                raise ValueError(f"{self.path} is not keyed by {', '.join(keys)}")
            layout = dict(state.layout) or layout
            if given is None:
                given, staged = self._stage(rows, keys, layout["buckets"])
            touched = [str(r["_bucket"]) for r in given.select("_bucket").distinct().collect()]  # at most the buckets
            merged, base = self._merge(given, keys, state, touched), {b: state.live.get(b) for b in touched}
            while all(state.live.get(b) == base[b] for b in touched):
                if self.try_commit(state, {**state.live, **merged}, layout):
                    remove(self.spark, f"{self.path}/{staged}")
                    return state.version + 1
                state = self.state()
            for folder in {m.rsplit("/", 1)[0] for m in merged.values()}:
                remove(self.spark, f"{self.path}/{folder}")
        raise RuntimeError(f"{self.path}: {_ATTEMPTS} commits in a row were lost to other writers")

    def _stage(self, rows: DataFrame, keys: Sequence[str], buckets: int) -> tuple[DataFrame, str]:
        """The batch with its buckets, stored once; a key that comes twice is an error."""
        staged = self.store(rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
        given = self.spark.read.parquet(f"{self.path}/{staged}")
        if not given.groupBy(*keys).count().where("count > 1").isEmpty():
            remove(self.spark, f"{self.path}/{staged}")
            raise ValueError(f"a key of {', '.join(keys)} comes twice in the batch")
        return given, staged

    def _merge(self, given: DataFrame, keys: Sequence[str], state: State, touched: Sequence[str]) -> dict[str, str]:
        """New folders of the touched buckets: the old rows whose key is not in the batch, and the batch."""
        old = [f"{self.path}/{state.live[b]}" for b in touched if b in state.live]
        whole = given
        if old:
            held = self.spark.read.option("mergeSchema", True).parquet(*old)
            bucket = F.pmod(F.xxhash64(*keys), F.lit(int(state.layout["buckets"]))).cast("int")
            held, new = held.withColumn("_bucket", bucket), given.select("_bucket", *keys)
            same = [held["_bucket"] == new["_bucket"], *[held[k].eqNullSafe(new[k]) for k in keys]]
            whole = held.join(new, same, "left_anti").unionByName(given, allowMissingColumns=True)
        folder = f"{_DATA}/{uuid.uuid4().hex}"
        whole.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        return {b: f"{folder}/_bucket={b}" for b in touched}

    def vacuum(self, keep: int = 1) -> int:
        """Drop all versions but the last ``keep``, and the folders that only they list; returns how many were dropped."""
        versions = self.versions()
        gone, kept = versions[: max(0, len(versions) - keep)], versions[max(0, len(versions) - keep) :]
        used = {f for v in kept for f in self.state(v).live.values()}
        old = {f for v in gone for f in self.state(v).live.values()} - used
        for version in gone:
            remove(self.spark, self._manifest(version))
        for folder in old:
            remove(self.spark, f"{self.path}/{folder}")
        return len(gone)
