"""Substring dedup against brute force over all windows."""

import hashlib
import random

import numpy as np
import pytest

from civicflow.llm.substring_blocks import pack_arrays, remove_repeats, unpack_arrays

SPACES = " \t\n\x0b\x0c\r"


def brute(rows, k=20):
    """rows: (doc_id, text) in any order, doc_id unique -> doc_id: (n, removed, sha, spans)."""
    docs = {d: (t or "").encode().split() for d, t in rows}
    first, gone = {}, {d: [False] * len(w) for d, w in docs.items()}
    for d in sorted(docs):
        w = docs[d]
        for s in range(len(w) - k + 1):
            key = tuple(w[s:s + k])
            if key in first:
                gone[d][s:s + k] = [True] * k
            else:
                first[key] = (d, s)
    return {d: (len(w), sum(gone[d]), hashlib.sha256(b" ".join(x for x, g in zip(w, gone[d]) if not g)).hexdigest())
            for d, w in docs.items()}


def run(df, **kw):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(df, **kw).collect()}


def test_packed_arrays_round_trip():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 1 << 62, 1000).astype(np.uint64), np.zeros(0, "<u4"), np.arange(300, dtype="<u2")]
    got = unpack_arrays(pack_arrays(arrays))
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(arrays, got))
    assert all(len(x) == 0 for x in unpack_arrays(pack_arrays([np.zeros(0, "<u1")])))


@pytest.mark.parametrize("buckets", [None, 5])
def test_shifted_passages(spark, buckets):
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(3000)]
    passage = rnd.choices(vocab, k=57)
    rows = []
    for d in range(60):
        w = rnd.choices(vocab, k=rnd.randrange(5, 80))
        if d % 3 == 0:  # a part of the passage at any place
            a = rnd.randrange(0, 30)
            at = rnd.randrange(len(w))
            w[at:at] = passage[a:a + rnd.choice([19, 20, 21, 27])]
        rows.append((d, rnd.choice([" ", "\n", " \t"]).join(w)))
    rows += [(60, rows[0][1]), (61, "la " * 100), (62, "la " * 19), (63, "la " * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    assert sum(v[1] for v in want.values()) > 300
    assert run(df, buckets=buckets) == want


def test_spans(spark):
    w = [f"x{i}" for i in range(40)]
    df = spark.createDataFrame([(1, " ".join(w)), (2, " ".join(["a", *w[3:33], "b", "c"]))], "doc_id long, text string")
    got = {r.doc_id: r.removed for r in remove_repeats(df).collect()}
    assert got == {1: "", 2: "1:31"}


def test_nulls_repeats_and_extra_columns(spark):
    t = " ".join(f"y{i}" for i in range(50))
    rows = [(0, None, 1), (1, "", 2), (2, t, 3), (2, t, 3), (3, t + " tail", 4), (None, t, 5), (4, "é" * 300_000, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in remove_repeats(df).collect()), key=repr)
    assert got == sorted([(0, 0, 0), (1, 0, 0), (2, 50, 50), (2, 50, 50), (3, 51, 50), (None, 50, 0), (4, 1, 0)], key=repr)
    assert remove_repeats(df.limit(0)).collect() == []


def test_different_texts_under_one_id(spark):
    """Under an id, under null and under the smallest long: every text is a document of its own."""
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(80)]
    rnd = random.Random(9)
    rows = [(5, " ".join(a + a)), (5, " ".join(b)), (5, " ".join(b)), (-(1 << 63), " ".join(b[:25]))]
    for d in (None, None, None, 7, 7, 8):
        at = rnd.randrange(0, 50)
        rows.append((d, " ".join(rnd.choices(a, k=15) + b[at:at + 25] + rnd.choices(a, k=15))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    order = df.selectExpr("doc_id", "text", "xxhash64(doc_id, text) AS node").distinct().collect()
    # Documents in the order of the rule, as numbers.
    order = sorted(order, key=lambda r: (-(1 << 63) if r.doc_id is None else r.doc_id, r.node))
    want = brute([(i, r.text) for i, r in enumerate(order)])
    want = {(r.doc_id, *want[i]) for i, r in enumerate(order)}
    for buckets in (None, 1, 7):
        got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(df, buckets=buckets).collect()]
        assert len(got) == len(rows) and set(got) == want
    two = spark.createDataFrame(rows[:2], "doc_id long, text string")
    assert {(r.n_words, r.n_removed) for r in remove_repeats(two).collect()} == {(80, 40), (80, 0)}


def test_many_rows_without_an_id(spark):
    """A third of all rows has no id: their anchors are not gathered under one key."""
    rnd = random.Random(11)
    shared = [f"s{i}" for i in range(30)]
    rows = [(None if i % 3 == 0 else i, " ".join(rnd.choices("abcdefghij", k=30) + (shared if i % 2 else []) + [str(i)]))
            for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = remove_repeats(df).collect()
    order = df.selectExpr("doc_id", "text", "xxhash64(doc_id, text) AS node").collect()
    order = sorted(order, key=lambda r: (-(1 << 63) if r.doc_id is None else r.doc_id, r.node))
    want = brute([(i, r.text) for i, r in enumerate(order)])
    assert sorted((str(order[i].doc_id), *v) for i, v in want.items()) == sorted(
        (str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
