"""Spelling variants, quality rules and the Merkle manifest against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from check import connect, difference
from riskweave.llm import merkle, rules, spelling
from riskweave.llm.common import stored
from riskweave.llm.oracles import ORACLES
from riskweave.llm.queries import QUERIES
from tests.llm.test_operators import SCHEMA, corpus, frame, rows_of


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


# -- 11 -----------------------------------------------------------------------------------------------------------------


def brute_counts(rows):
    total = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            at = h % len(run)
            total[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute_variants(counts):
    form, out = {}, {}
    for w, n in counts.items():
        near = [v for v in counts if abs(len(v) - len(w)) < 2 and one_edit(v, w)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
        out[w] = [n, len(near), counts[form[w]] if form[w] else None]
    rows = Counter()
    for w, rest in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows[w, form[w], root, *rest] += 1
    return rows


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


@pytest.mark.parametrize("crowd", [3, 40, 256])
def test_variants_of_a_dense_vocabulary(spark, crowd):
    rng = random.Random(crowd)
    words = {"".join(rng.choice("abéÿ") for _ in range(rng.randint(5, 7))) for _ in range(500)}
    words |= {"x" * 3000 + c + "y" * 2000 for c in ("", "a", "b", "ab")} | {"abcde" + "fg" * k for k in range(5)}
    words |= {f"chain{'z' * k}" for k in range(9)}
    counts = {w: rng.choice([3, 3, 4, 6, 8, 12, 24, 100, 2**40]) for w in sorted(words)}
    counts |= {f"chain{'z' * k}": 3 * 2**k for k in range(9)}
    table = stored(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3), "words")
    got, scratch = spelling.variants(table, crowd)
    assert rows_of(got, *COLUMNS) == brute_variants(counts)
    assert len(scratch) == 2
    if crowd == 3:  # most buckets are cut at least once, down to one place of the edit
        cut, _ = spelling.buckets(table, crowd)
        assert cut.where("hi - lo = 1").count() > 100


def test_spelling_query(spark, none):
    rng = random.Random(9)
    say = lambda: "".join(rng.choice("abcö") for _ in range(rng.randint(4, 7)))
    base = [say() for _ in range(120)]
    rows = corpus() + [(k, " ".join(rng.choice(base).title() + rng.choice(["", ",", "'s", "—x", "×"]) for _ in range(60))) for k in range(-20, 60)]
    rows += [(None, " ".join(base)), (None, None), (7, ""), (8, "q" * 5000 + " Qq"), (9, "q" * 5000), (10, "q" * 5000), rows[-1], rows[-1]]
    counts = brute_counts(rows)
    assert len(counts) > 100 and "q" * 5000 in counts
    assert rows_of(spelling.spelling_variants(frame(spark, rows)), *COLUMNS) == brute_variants(counts)
    assert spelling.spelling_variants(none).count() == 0


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(spelling, "_COUNTED", 3)
    batch = pa.RecordBatch.from_pylist([{"doc_id": k, "text": b"first second third fourth"} for k in range(4)])
    parts = list(spelling._counts(iter([batch])))
    total = Counter()
    for p in parts:
        for r in p.to_pylist():
            total[r["word"]] += r["n"]
    assert len(parts) > 1 and sum(total.values()) >= 12


# -- 12 -----------------------------------------------------------------------------------------------------------------


def brute_measures(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_unlettered": sum(not re.search("[A-Za-z]|[^\x00-\x7f]", w) for w in words),
        "n_shouted": sum(bool(re.match("[A-ZÀ-Þ]{2}", w)) for w in words),
        "n_marked": sum(w[-2:-1] in tuple(".!?:;,") and w[-1:] in tuple(".!?:;,") for w in words),
        "longest_bytes": max((len(w.encode()) for w in words), default=0),
    }


def texts():
    rng = random.Random(3)
    tokens = ["a", "be", "CD", "ÉÀx", "é", "|", "#1", "12", "end..", "why?!", "Ok.", "x y", "w" * 1200]
    out = [" ".join(rng.choice(tokens[:-1]) for _ in range(rng.choice([1, 2, 3, 40, 60, 300]))) for _ in range(40)]
    out += ["\n".join(rng.choice([" a b c", "a b c", "", " \t", "d e"]) for _ in range(40)) for _ in range(5)]
    out += [" ".join(f"word{k}" for k in range(80)), "w" * 1200 + " " + " ".join(f"word{k}" for k in range(80)), "x y z " * 30, "a b a b a b", "\x0b\x0c", "é" * 9]
    return out


def test_rules_query(spark, none):
    rows = corpus() + list(enumerate(texts(), 5000)) + [(5000, "again " * 60)]
    want = Counter()
    for d, t in rows:
        m = brute_measures(t or "")
        base = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        fails = sum(1 << k for k, r in enumerate(rules.RULES) if eval(r.fails, {}, m))
        want[d, *m.values(), fails, base, fails == 0] += 1
    got = rules.verdicts(frame(spark, rows))
    assert rows_of(got, "doc_id", *rules.MEASURES, "failures", "base_failed", "kept") == want
    assert len({k[-3] for k in want}) > 8 and rules.verdicts(none).count() == 0


def test_policies_and_ablations(spark):
    book = stored(rules.ledger(rules.measured(frame(spark, corpus() + list(enumerate(texts(), 5000))))).withColumn("side", F.col("n_words") % 2), "book")
    held = [(r.side, r.failures) for r in book.collect()]
    got = {(r.side, r.policy, r.version): (r.n_docs, r.n_kept) for r in rules.outcomes(book, by=["side"]).collect()}
    for side in (0, 1):
        for (name, version), bits in rules.POLICIES.items():
            mine = [f for s, f in held if s == side]
            assert got[side, name, version] == (len(mine), sum(f & bits == 0 for f in mine))
    for policy in rules.POLICIES:
        bits = rules.POLICIES[policy]
        names = {r.name: 1 << k for k, r in enumerate(rules.RULES) if bits >> k & 1}
        want = {n: (sum(f & b != 0 for _, f in held), sum(f & bits == b for _, f in held), sum(f & bits == 0 for _, f in held), sum(f & (bits - b) == 0 for _, f in held)) for n, b in names.items()}
        assert {r.rule: (r.n_failed, r.n_only, r.n_kept, r.n_kept_without) for r in rules.ablations(book, policy).collect()} == want
    gone = spark.createDataFrame([(None,) * len(rules.MEASURES)], ", ".join(f"{m} long" for m in rules.MEASURES))
    assert rules.ledger(gone).first().failures == 0
    plan = rules.ablations(book)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


# -- 13 -----------------------------------------------------------------------------------------------------------------


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(values):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def walk(tree, at):
    """Digests left and right of a node, level by level."""
    for level in tree[:-1]:
        low = at - at % 8
        yield "".join(level[low:at]), "".join(level[at + 1 : low + 8])
        at //= 8


def brute_manifest(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    first = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted((first(r[0]), brute_leaf(r), r) for r in [x for x in rows if x[2] == lang])
        trees[lang] = (mine, levels([m[1] for m in mine]))
    top = levels([trees[lang][1][-1][0] for lang in langs])
    out = Counter()
    for t, lang in enumerate(langs):
        mine, tree = trees[lang]
        for at, (_, digest, row) in enumerate(mine):
            bad = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                bad = brute_leaf((*row[:4], "".join(c.lower() if c.isascii() else c for c in row[4])))
            steps, listed = [*walk(tree, at), *walk(top, t)], ""
            for left, right in steps:
                bad, listed = h([left, bad, right]), listed + left + right
            out[row[0], digest, tree[-1][0], top[-1][0], h([listed]), bad, bad == top[-1][0]] += 1
    return out


DIGEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, "de": 9, None: 1, "": 3}, {"en": 1100, None: 65, "Zz": 513, "é": 64, "fr": 512, **{f"l{k}": 2 for k in range(9)}}])
def test_manifest(spark, sizes):
    rng = random.Random(4)
    rows = []
    for lang, n in sizes.items():
        ids = rng.sample(range(-500, 10**6), n)
        rows += [(i, rng.choice(["s1", None, ""]), lang, rng.choice([None, 5]), rng.choice(["Some Text é", "plain", "", None, "X" * 5000])) for i in ids]
    if len(rows) > 10:  # a null id, ids that come twice with one text or two, and repeated rows
        rows += [(None, None, "en", None, None), (None, "s", "en", 1, "A"), (rows[0][0], "s9", "en", 2, "Other"), rows[1], rows[1], rows[1]]
    docs = spark.createDataFrame([(i, t, lang, s, n, "k", None, 1, "s", 2) for i, s, lang, n, t in rows], SCHEMA).repartition(5)
    want = brute_manifest(rows)
    assert rows_of(merkle.digest(docs), *DIGEST) == want
    if len(rows) > 100:
        assert 0 < sum(n for k, n in want.items() if not k[-1]) < len(rows) / 3
    whole = merkle.manifest(docs)
    assert whole.where(merkle.fold(F.col("leaf"), F.col("steps")) != F.col("root")).count() == 0


def test_manifest_of_nothing(spark, none):
    assert merkle.digest(none).count() == 0 and merkle.digest(none).columns == list(DIGEST)


def test_manifest_blocks_are_bounded(spark):
    """One language with all rows and one id with a third of them: no block holds more than its span."""
    ids = spark.range(6000).select(F.lit("en").alias("tree"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("hash"), F.lit(1).alias("item"))
    ranked, most, _ = merkle._ranked(ids.repartition(4), ["doc_id"])
    assert most == 6000 and ranked.select("rank").distinct().count() == 6000
    sizes = merkle._blocks(ranked).select(F.expr("aggregate(kids, 0, (n, a) -> n + aggregate(a.kids, 0, (m, b) -> m + size(b.kids)))").alias("n"))
    assert sizes.agg(F.max("n"), F.sum("n")).first() == (512, 6000)


def test_digest_of_whole_table_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    note = difference(QUERIES["op13_merkle"](spark, folder).toPandas(), connect(folder).execute(ORACLES["op13_merkle"]).df())
    assert note == ""
