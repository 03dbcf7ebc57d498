"""Every operator against a brute-force version, over tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from riskweave.llm import bpe, decontaminate, lattice, line_dedup, quality, simhash, substring_dedup, suffix_dedup, superwindows, toxicity, warc
from riskweave.llm.common import LAST_KEY, stored
from riskweave.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, digest string, keep int, spans string, m int"
SPACE = "[\x20\x09-\x0d]"
RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def frame(spark, rows):
    """(doc_id, text) pairs as a table with columns that operators also use inside."""
    return spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), "k", None, 1, "s", 2) for i, t in rows], SCHEMA).repartition(3)


def corpus():
    """Texts that share words, lines and passages; ids are out of order, some null, two rows repeated, one id used twice."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, line = say(30), "  A Shared LINE of some words\t"
    rows = [(100 - k, "\n".join([say(rng.randint(1, 12)) for _ in range(rng.randint(1, 8))])) for k in range(30)]
    rows += [(200 + k, f"{say(5)}\n{line if k % 2 else line.lower()}\n{passage} {say(3)}\n\n{say(4)}") for k in range(12)]
    rows += [(300, "ab " * 400), (301, "x" * 3000), (302, ""), (303, None), (None, rows[3][1]), (None, None), (304, " \t\n\x0b "), (305, passage)]
    rows += [rows[3], rows[35], (100, say(40)), (306, rows[31][1] + " tail"), (307, say(2)), (308, "Ünï " + passage.upper()), (309, say(4000))]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus())


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def lower(raw):
    return raw.translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


# -- components ---------------------------------------------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1040)] + [(7, 7)]
    low = {v: v for e in edges if e[0] != e[1] for v in e}
    for _ in range(len(low)):
        before = dict(low)
        for a, b in edges:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
        if low == before:
            break
    got = components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"))
    assert rows_of(got, "node", "label") == Counter(low.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 1 ------------------------------------------------------------------------------------------------------------------

PAGES = [
    (1, "http://a.example/x?q=1#f", "<p>hi</p>"), (2, "https://b.example", "<p>hi</p>"), (9, None, "<p>hi</p>"), (3, "http://a.example/ü\r\nz", ""), (4, "u", None),
    (5, "http://c.example/", "body\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nHTTP/1.1 200 OK\r\n\r\n"), (6, "http://d.example/", "é" * 70_000),
    (7, "http://e.example/", "WARC/1."), (8, "http://e.example/2", "﻿x\n"), (None, "http://f.example/", "<p>hi</p>"), (None, None, "alone"), (5, "again", "other"),
]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, 1, "x") for p in PAGES], "page_id long, url string, html string, digest int, value string").repartition(3)
    want = Counter()
    for page, _, html in PAGES:
        raw = (html or "").encode()
        ids = [p for p, _, h in PAGES if (h or "").encode() == raw and p is not None]
        last = max(ids, default=None)
        again = last is not None and page != last
        want[page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", last if again else None] = 1
    got = warc.page_captures(spark, pages, str(tmp_path / "archive"))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows_of(got, *columns) == want
    twice = warc.page_captures(spark, pages.union(pages), str(tmp_path / "twice"))
    assert rows_of(twice, *columns) == want
    kept = warc.read_archives(spark, str(tmp_path / "archive")).where("type = 'response' and payload is not null").select("payload").collect()
    assert {bytes(r.payload) for r in kept} == {(h or "").encode() for _, _, h in PAGES}
    empty = warc.page_captures(spark, pages.where("false"), str(tmp_path / "none"))
    assert empty.count() == 0


def test_warc_assembly_and_foreign_archive(spark, tmp_path):
    def record(kind, uri, near, block, content="text/plain"):
        head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{uri}>", *(f"WARC-Concurrent-To: <{n}>" for n in near), f"Content-Type: {content}", f"Content-Length: {len(block)}"]
        return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n\x00\xff\r\n\r\nbin"
    raw = record("warcinfo", "i", [], b"") + record("response", "r1", ["q1"], http, "application/http; msgtype=response") + record("request", "q1", [], b"GET")
    raw += record("metadata", "m1", ["q1"], b"a: b") + record("metadata", "m2", ["r1", "q1"], b"c: d") + record("request", "q2", ["lost"], b"G") + record("metadata", "m3", ["lost"], b"e")
    (tmp_path / "one.warc").write_bytes(raw)
    records = warc.read_archives(spark, str(tmp_path / "one.warc"))
    assert records.count() == 7
    got = {r.capture_id: r for r in warc.assemble(records).collect()}
    assert set(got) == {"r1", "lost"}
    assert bytes(got["r1"].response.payload) == b"\x00\xff\r\n\r\nbin" and got["r1"].request.record_id == "q1"
    assert sorted(m.record_id for m in got["r1"].metadata) == ["m1", "m2"]
    assert got["lost"].response is None and got["lost"].request.record_id == "q2" and len(got["lost"].metadata) == 1
    (tmp_path / "cut.warc").write_bytes(raw[:-30])
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_archives(spark, str(tmp_path / "cut.warc")).collect()


def test_warc_keeps_all_requests_and_captures(spark, tmp_path):
    def record(kind, uri, near, block):
        head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{uri}>", *(f"WARC-Concurrent-To: <{n}>" for n in near), f"Content-Length: {len(block)}"]
        return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    raw = record("request", "q2", ["r1"], b"two") + record("response", "r1", [], b"page") + record("request", "q1", ["r1"], b"one")
    raw += record("resource", "s1", [], b"file") + record("conversion", "c1", [], b"text") + record("metadata", "m1", ["s1"], b"a: b")
    (tmp_path / "all.warc").write_bytes(raw)
    got = {r.capture_id: r for r in warc.assemble(warc.read_archives(spark, str(tmp_path / "all.warc"))).collect()}
    assert {i: r.response.type for i, r in got.items()} == {"r1": "response", "s1": "resource", "c1": "conversion"}
    assert [(q.record_id, bytes(q.payload)) for q in got["r1"].requests] == [("q1", b"one"), ("q2", b"two")] and got["r1"].request.record_id == "q1"
    assert bytes(got["s1"].response.payload) == b"file" and [m.record_id for m in got["s1"].metadata] == ["m1"]


# -- 2 ------------------------------------------------------------------------------------------------------------------


def plain_words(text):
    import re

    return [w for w in re.split("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f\x80-\xbf -⁯　]+", (text or "").lower()) if w]


def test_decontamination(spark, docs, none):
    rows = corpus()
    passage = dict(rows)[305]
    words = passage.split()
    items = [(1, passage), (2, " ".join(words[:3])), (3, "no such words in any text at all"), (4, None), (5, ""), (6, ", ".join(words[2:28]).upper()), (None, passage + " more"), (1, passage), (8, rows[-1][1][:2000])]
    rows = [*rows, (400, "“" + " ".join(words[:3]) + "”"), (401, " ".join([*words[:8], "other", *words[9:]]))]
    want = set()
    for item, text in items:
        w = plain_words(text)
        k = min(5, len(w))
        mine = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
        for doc, t in rows:
            d = plain_words(t)
            shared = len(mine & {tuple(d[i : i + k]) for i in range(len(d) - k + 1)})
            if mine and shared >= 0.8 * len(mine):
                want.add((doc, item, len(mine), shared))
    table = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, hash string")
    got = decontaminate.benchmark_pairs(frame(spark, rows), table)
    assert set(rows_of(got, "doc_id", "item_id", "n_shingles", "n_shared")) == want and len(want) > 12
    left = decontaminate.decontaminate(frame(spark, rows), table)
    gone = {(d, i) for d, i, *_ in want}
    assert Counter(r.text for r in left.collect()) == Counter(t for d, t in rows if not any(g[0] == d for g in gone) or (d == 100 and t is None))
    assert left.columns == docs.columns
    assert decontaminate.benchmark_pairs(none, table).count() == 0 and decontaminate.benchmark_pairs(docs, table.where("false")).count() == 0


# -- 3, 9 ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("name", "label", "least"), [("op3_quality", "quality", 0.97), ("op9_toxicity", "toxic", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    from riskweave.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.1"
    held = QUERIES[name](spark, sf_dir).where("held_out").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    right, ones, hit = held.agg(F.avg((F.col("predicted") == F.col(label)).cast("double")), F.sum(label), F.sum(F.col("predicted") * F.col(label))).first()
    assert right > least and hit > 0.8 * ones


def test_pairs_of_the_machine_are_all_pairs():
    rng = np.random.default_rng(1)
    machine = quality.Machine(0.3, rng.normal(size=quality.SIZE), rng.normal(size=(quality.SIZE, 3)))
    x = quality.Features(np.array([0, 5, 7]), rng.integers(0, quality.SIZE, 7), rng.normal(size=7))
    for r, (a, b) in enumerate(((0, 5), (5, 7))):
        want = 0.3 + sum(machine.weight[x.index[i]] * x.value[i] for i in range(a, b))
        want += sum(machine.factor[x.index[i]] @ machine.factor[x.index[j]] * x.value[i] * x.value[j] for i in range(a, b) for j in range(a, i))
        assert np.isclose(machine.parts(x)[0][r], want)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_take_any_row(spark, docs, none, module):
    labels = spark.createDataFrame([(k, k % 2, k % 3 % 2) for k in range(70, 101)] + [(None, 1, 1), (90, None, None), (305, 1, 1)], "doc_id long, quality int, toxic int")
    fitted = module.train(docs, labels)
    score = (lambda d: module.score(d, fitted)) if module is quality else (lambda d: module.score(d, *fitted))
    got = score(docs)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    assert got.where("score is null or score < 0 or score > 1 or predicted <> int(score >= 0.7) or held_out is null").count() == 0
    same = got.where("doc_id in (302, 303)").select("score").distinct()
    assert same.count() == 1 or module is quality  # null and empty differ at most by their metadata
    assert score(none).count() == 0
    for nothing in (module.train(none, labels), module.train(docs, labels.where("false"))):
        blank = module.score(docs, nothing) if module is quality else module.score(docs, *nothing)
        assert blank.where("score <> 0.5 or predicted <> 0").count() == 0
    if module is quality:
        kept = quality.keep_good(docs, fitted)
        assert kept.schema == docs.schema
        assert rows_of(kept, "doc_id", "text").total() == got.where("predicted = 1").count()


def test_nothing_learnt_keeps_all(spark, docs):
    labels = spark.createDataFrame([(80, None), (None, 1), (-5, 0), (-6, 1), (-7, 1), (-8, 0)], "doc_id long, quality int")
    for some in (labels, labels.where("false")):
        fitted = quality.train(docs, some)
        with pytest.warns(UserWarning, match="all rows are kept"):
            kept = quality.keep_good(docs, fitted)
        assert kept.schema == docs.schema and rows_of(kept, "doc_id", "text") == rows_of(docs, "doc_id", "text")
        assert quality.score(docs, fitted).where("score <> 0.5 or predicted <> 0").count() == 0


def edits(a, b):
    """Letters put in, left out, replaced, or swapped with a neighbour."""
    table = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        table.append([i])
        for j, y in enumerate(b, 1):
            steps = [table[i - 1][j] + 1, table[i][j - 1] + 1, table[i - 1][j - 1] + (x != y)]
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                steps.append(table[i - 2][j - 2] + 1)
            table[i].append(min(steps))
    return table[-1][-1]


def test_planted_misspellings():
    import pyarrow as pa

    rng = random.Random(6)
    terms = ["scum", "idiot", "moron", "pathetic", "worthless", "disgusting", "trash", "loser"]
    finder = toxicity.Finder(dict.fromkeys(terms, 3.0), frozenset({"closer", "slum", "sum", "motor"}))

    def misspell(term):
        at = rng.randrange(1, len(term) - 1)
        letter = rng.choice("abcdefghijklmnopqrstuvwxyz0135")
        put_in, left_out, replaced = term[:at] + letter + term[at:], term[:at] + term[at + 1 :], term[:at] + letter + term[at + 1 :]
        swapped = term[:at] + term[at + 1] + term[at] + term[at + 2 :]
        marked = term[:at] + rng.choice("!*@-.$") + term[at + 1 :]
        return rng.choice([put_in, left_out, replaced, swapped, marked, rng.choice("-.*").join(term)])

    planted = [misspell(rng.choice(terms)) for _ in range(600)]
    x = finder.features(pa.array([f"so, what a {w} indeed (it's so)".encode() for w in planted], pa.binary()))
    assert (x[:, 0] + x[:, 1] > 0).mean() >= 0.98
    clean = ["we are closer to the slum", "it's a well-known motor", "don't re-enter e.g. a.b.c", "see http://a.example/b-c_d.html", "sum of the parts", "", "- - -", "a"]
    assert not finder.features(pa.array([c.encode() for c in clean], pa.binary())).any()
    assert finder.look_up_linked(b"it's") is None and finder.look_up_linked(b"i.d.i.o.t") == ("idiot", 1)
    hit = finder.features(pa.array([b"idiot-like", b"an id!ot", b"idoit"], pa.binary()))
    assert hit[0, 0] > 0 and hit[0, 1] == 0 and (hit[1:, 1] > 0).all()


def test_toxicity_learns_the_same_from_repeated_ids(spark):
    rows = [(k, f"the w{k} {'grobian' if k % 2 else 'grobion' if k % 4 else 'garden'} of things") for k in range(120)]
    rows += [(k, f"another text w{k} {'grobian' if k % 2 else 'garden'}") for k in range(0, 40)] + [(3, None), (5, "")]
    labels = spark.createDataFrame([(k, k % 2) for k in range(120)], "doc_id long, toxic int")
    fits = [toxicity.train(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels) for r, n in ((rows, 2), (rows[::-1], 5))]
    assert fits[0][0] == fits[1][0] and fits[0][2] == fits[1][2] and np.allclose(fits[0][1], fits[1][1])
    assert "grobian" in fits[0][0] and "grobion" in fits[0][2]


def test_trie_finds_what_edit_distance_finds():
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    lexicon = {word(rng.randint(3, 11)): 1.0 for _ in range(60)}
    trie = toxicity.Trie(lexicon)
    for _ in range(1500):
        w = word(rng.randint(1, 13))
        near = [(edits(w, t), t) for t in lexicon if edits(w, t) <= toxicity.allowed_edits(len(t))]
        assert trie.near(w) == (min(near)[::-1] if near else None)
    assert toxicity.Trie({}).near("a") is None


def test_quotation_lowers_a_hit():
    import pyarrow as pa

    finder = toxicity.Finder({"moronic": 3.0})
    x = finder.features(pa.array([b"you are moronic indeed", 'the word "moronic" is old'.encode(), b"such a m0ronic plan", b"", "sagte: „moronic“.".encode()], pa.binary()))
    assert x[0, 0] > 0 and x[0, 2] == 0
    assert x[1, 2] > x[1, 0] and x[4, 2] > x[4, 0]
    assert x[2, 1] > 0 and x[2, 0] == 0
    assert not x[3].any()


# -- 4, 6 ---------------------------------------------------------------------------------------------------------------


def test_suffix_array_is_sorted():
    rng = random.Random(3)
    for _ in range(200):
        n, kinds = rng.randint(0, 60), rng.choice([1, 2, 4, 256])
        text = [rng.randint(1, kinds) + 1 if rng.random() < 0.95 else 1 for _ in range(n)] + [0]
        got = suffix_dedup.suffix_array(np.array(text, np.int16)).tolist()
        assert got == sorted(range(len(text)), key=lambda i: text[i:])


def brute_bytes(rows, size):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = Counter()
    for (doc, _), t in zip(rows, texts, strict=True):
        gone = [False] * len(t)
        for i in range(len(t) - size + 1):
            if count[t[i : i + size]] > 1:
                gone[i : i + size] = [True] * size
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out[doc, len(t), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), sha(kept)] += 1
    return out


def test_windows_of_long_grams_last():
    assert superwindows.levels(4, 20) == [4, 8, 16, 20] and superwindows.levels(32, 200) == [32, 64, 128, 200] and superwindows.levels(7, 7) == [7]


@pytest.mark.parametrize("both_ways", [True, False])
def test_one_string_everywhere_stays_small_in_its_bucket(both_ways):
    import pyarrow as pa

    most = [0]

    def judge(bucket):
        most[0] = max(most[0], sum(map(len, bucket.chunks)))
        count, first = Counter(bucket.chunks), {}
        for c, k, f in zip(bucket.chunks, bucket.key.tolist(), bucket.first.tolist(), strict=True):
            first[c] = min(first.get(c, (k, f)), (k, f))
        place = list(zip(bucket.chunks, bucket.key.tolist(), bucket.first.tolist(), strict=True))
        row = np.array([i for i, (c, k, f) in enumerate(place) if (count[c] > 1 if both_ways else first[c] < (k, f))], np.int64)
        return row, np.zeros(len(row), np.int64), bucket.n[row].astype(np.int64)

    rng = random.Random(8)
    rows = [(1, b"seldom", 5, 5, 0, 1, False)]
    rows += [(2, rng.choice([b"the same words", b"others"]) if rng.random() < 0.98 else f"own {k}".encode(), rng.randint(0, 3000), k, rng.randint(0, 3), 1, False) for k in range(9000)]
    rows += [(3, b"last", 1, 1, 0, 1, False), (4, None, 9, 9, 2, 3, True)]
    columns = list(zip(*rows, strict=True))
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, superwindows._SCHEMA, strict=True)], schema=superwindows._SCHEMA)
    parts = [batch.slice(i, 500) for i in range(0, batch.num_rows, 500)]
    got = set().union(*(zip(*(c.to_pylist() for c in b.columns), strict=True) for b in superwindows._in_buckets(judge, both_ways, 1000)(iter(parts))))
    count, first = Counter(r[:2] for r in rows), {}
    for m, c, k, _, f, _, _ in rows:
        first[m, c] = min(first.get((m, c), (k, f)), (k, f))
    want = {(k, d, f, n) for m, c, k, d, f, n, sure in rows if sure or (count[m, c] > 1 if both_ways else first[m, c] < (k, f))}
    assert got == want and most[0] < 20_000 < sum(len(r[1] or b"") for r in rows)


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_suffix_dedup(spark, docs, none, monkeypatch, crowd):
    monkeypatch.setattr(superwindows, "CROWD", crowd)
    got = suffix_dedup.byte_digest(docs, size=40, gram=8)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = brute_bytes(corpus(), 40)
    assert rows_of(got, *columns) == want and sum(k[2] > 0 for k in want) > 15
    assert suffix_dedup.byte_digest(none, size=40, gram=8).count() == 0


def brute_words(rows, size):
    words = [(LAST_KEY if d is None else d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, (d, i)), (d, i))
    out = Counter()
    for (doc, _), (d, w) in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < (d, i):
                gone[i : i + size] = [True] * size
        out[doc, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone, strict=True) if not g))] += 1
    return out


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_substring_dedup(spark, docs, none, monkeypatch, crowd):
    monkeypatch.setattr(superwindows, "CROWD", crowd)
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    got = substring_dedup.word_digest(docs, size=7, gram=2)
    want = brute_words(corpus(), 7)
    assert rows_of(got, *columns) == want and sum(k[2] > 0 for k in want) > 12
    assert rows_of(substring_dedup.word_digest(docs), *columns) == brute_words(corpus(), 20)
    assert substring_dedup.word_digest(none).count() == 0


def test_window_ranks():
    ids = np.random.default_rng(0).integers(0, 2, 500)
    for size in (1, 2, 3, 7, 20):
        got = substring_dedup.window_ranks(ids, size)
        runs = [tuple(ids[i : i + size]) for i in range(len(ids) - size + 1)]
        assert len(set(zip(got.tolist(), runs, strict=True))) == len(set(runs)) == len(set(got.tolist()))


# -- 5 ------------------------------------------------------------------------------------------------------------------


def test_nearest_lattice_point():
    y = np.random.default_rng(1).normal(0, 2, (400, 8))
    got = lattice.nearest_e8(y)
    for step in lattice.roots():
        assert (((y - got) ** 2).sum(1) <= ((y - got - step) ** 2).sum(1) + 1e-9).all()
    assert np.allclose(2 * got, np.rint(2 * got)) and np.allclose(got.sum(1) % 2, 0)


def test_embedding_links(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(150, 24))
    base /= np.linalg.norm(base, axis=1)[:, None]
    noise = rng.normal(size=base.shape)
    noise -= (noise * base).sum(1)[:, None] * base
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    tilt = np.arccos(rng.uniform(0.951, 0.97, 150))[:, None]  # just inside the threshold, where the index is weakest
    vectors = [(k, v.tolist()) for k, v in enumerate([*base, *(np.cos(tilt) * base + np.sin(tilt) * noise), *(3 * base[:5])])]
    odd = [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] + [1.0] * 23), (904, [None] + [1.0] * 23), (905, [1.0] * 7), (906, [1.0] * 7), (None, vectors[0][1]), (907, [float("inf")] * 24), (905, [1.0] * 7)]
    table = spark.createDataFrame([(i, v, 1, "n") for i, v in vectors + odd], "vec_id long, embedding array<double>, label int, node string").repartition(3)
    got = lattice.near_duplicates(table).collect()
    assert len(got) == len(vectors) + len(odd)
    unit = np.array([v for _, v in vectors])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    links = {i: int(near[i].sum()) - 1 + int(near[i, 0]) for i in range(len(vectors))}
    found = {r.vec_id: r for r in got if r.vec_id is not None and r.vec_id < 900}
    assert sum(r.n_links for r in found.values()) >= 0.97 * sum(links.values())
    assert all(r.n_links <= links[i] for i, r in found.items())
    other = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None or r.vec_id >= 900}
    assert other >= {(i, 0, i, True) for i in (900, 901, 902, 903, 904, 907)} | {(905, 2, 905, True), (906, 2, 905, False)}
    assert [r.component_id for r in got if r.vec_id is None] == [0]
    assert lattice.near_duplicates(table.where("false")).count() == 0


# -- 7 ------------------------------------------------------------------------------------------------------------------


def test_bpe_against_library(spark, docs, none):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rng = random.Random(1)
    odd = ["日本語テキスト" * 40, "👩‍👩‍👧 x y", "a" * 5000, "it's WE'LL  \n\n\t z", "<|endoftext|>", "".join(rng.choice("abé 1!\n") for _ in range(4000)), "İͅß"]
    rows = corpus() + [(500 + k, t) for k, t in enumerate(odd)]
    want = Counter()
    for doc, t in rows:
        ids = np.array(encoding.encode_ordinary(t or ""), "<u4")
        want[doc, len(ids), sha(ids.tobytes()), sha((t or "").encode())] += 1
    table = frame(spark, rows)
    got = bpe.round_trip(table, path, public_tokenizers.PATTERN)
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    encoded = bpe.encode(table, path, public_tokenizers.PATTERN)
    back = bpe.decode(encoded, path, public_tokenizers.PATTERN)
    assert Counter((r.doc_id, bytes(r.text)) for r in back.collect()) == Counter((d, (t or "").encode()) for d, t in rows)
    assert bpe.round_trip(none, path, public_tokenizers.PATTERN).count() == 0


def test_cache_is_bounded_in_bytes(monkeypatch):
    encoder, encoding = bpe.Encoder(RANKS, public_tokenizers.PATTERN), tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    rng = random.Random(2)
    monkeypatch.setattr(bpe, "_CACHED_BYTES", 2000)
    for n in range(1, 30):
        texts = [" ".join("".join(rng.choice("aeioéstr") for _ in range(rng.choice([3, 9, 40 * n]))) for _ in range(12)) for _ in range(3)]
        assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(texts)] == [encoding.encode_ordinary(t) for t in texts]
        assert all(len(piece.encode()) <= bpe._WIDEST for piece in encoder.cache)
    encoder.learn({"x"})
    assert len(encoder.cache) == 1


def test_wide_rows_merge_like_narrow_ones(monkeypatch):
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(6)
    pieces = ["".join(rng.choice("aabehinorstué") for _ in range(rng.randint(2, 60))).encode() for _ in range(200)]
    assert all(a.tolist() == encoder.long_piece(p).tolist() for p, a in zip(pieces, encoder.matrix(pieces), strict=True))


# -- 8 ------------------------------------------------------------------------------------------------------------------


def brute_print(text):
    words = lower((text or "").encode()).split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, docs, none):
    rows = corpus()
    prints = [brute_print(t) for _, t in rows]
    low = [LAST_KEY if d is None else d for d, _ in rows]
    for _ in rows:
        low = [min(low[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 2) for i in range(len(rows))]
    want = Counter((d, p - 2**64 if p >> 63 else p, None if c == LAST_KEY else c) for (d, _), p, c in zip(rows, prints, low, strict=True))
    assert rows_of(simhash.near_duplicates(docs), "doc_id", "fp", "component_id") == want
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) >= Counter({c: 1 for c in low if c != LAST_KEY})
    assert simhash.near_duplicates(none).count() == 0 and simhash.representatives(none).count() == 0


def test_ball_links_miss_nothing(spark):
    rng = random.Random(9)
    seeds = [rng.getrandbits(64) for _ in range(20)]
    prints = {s for seed in seeds for s in (seed, seed ^ 1 << 63, seed ^ 3, seed ^ 7, seed ^ 0xF0, seed ^ 1 << 5)}
    signed = lambda p: p - 2**64 if p >> 63 else p
    links = {frozenset((r.a, r.b)) for r in simhash.ball_links(spark.createDataFrame([(signed(p),) for p in prints], "fp long")).collect()}
    parent = {p: p for p in map(signed, prints)}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in map(tuple, links):
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 2
        parent[find(a)] = find(b)
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2:
                assert find(signed(a)) == find(signed(b))


# -- 10 -----------------------------------------------------------------------------------------------------------------


def brute_lines(rows):
    holders = {}
    key = lambda line: lower(line.strip(b" \t\n\x0b\x0c\r"))
    for d, t in rows:
        for line in (t or "").encode().split(b"\n"):
            if len(key(line).decode()) >= 10:
                holders.setdefault(key(line), set()).add(LAST_KEY if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").encode().split(b"\n")
        kept = [x for x in lines if min(holders.get(key(x), {LAST_KEY})) >= (LAST_KEY if d is None else d)]
        out.append((d, len(lines), len(lines) - len(kept), b"\n".join(kept)))
    return out


def test_line_dedup(spark, docs, none):
    want = brute_lines(corpus())
    got = line_dedup.line_digest(docs)
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == Counter((d, n, g, sha(k)) for d, n, g, k in want)
    assert sum(g for _, _, g, _ in want) > 10
    cut = line_dedup.dedup_lines(docs)
    assert cut.columns == docs.columns
    texts = Counter((r.doc_id, r.text or "") for r in cut.collect())
    assert texts == Counter((d, k.decode()) for d, _, _, k in want)
    assert cut.where("text is not null and n_chars <> length(text)").count() == 0 and cut.where("text is null").count() == 2
    assert line_dedup.line_digest(none).count() == 0 and line_dedup.dedup_lines(none).count() == 0


def test_line_stream_carries_over_batches():
    import pyarrow as pa

    rows = [(1, 1, 5, 0, 0, False), (1, 1, 5, 0, 3, False), (1, 1, 7, 0, 1, False), (1, 1, 9, 0, 1, False), (1, 2, 9, 0, 2, False), (0, 0, 4, 0, 6, True)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("hi", "lo", "key", "digest", "pos", "sure"), r, strict=True))]) for r in rows]
    got = [(r["key"], r["pos"]) for b in line_dedup._stream(iter(batches)) for r in b.to_pylist()]
    assert got == [(7, 1), (9, 1), (4, 6)]


def test_stored_keeps_schema(spark, none):
    assert stored(none, "none").schema == none.schema
