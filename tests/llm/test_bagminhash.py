"""BagMinHash: unbiased signatures, and classes against all pairs."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civicflow.llm.bagminhash import _overlap, keep_one, near_classes, shingles, signatures
from civicflow.llm.common import utf8
from civicflow.llm.graph import components

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


def bag(text):
    for c in SPACES[1:]:
        text = text.replace(c, " ")
    w = text.split(" ")
    w = [x for x in w if x]
    if not w:
        return Counter({("", text): 1})
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(texts):
    """class of each id by all pairs; texts: id -> text."""
    bags = {i: bag(t or "") if (t or "").strip(SPACES) else Counter({("", t or ""): 1}) for i, t in texts.items()}
    root = {i: i for i in bags}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(bags)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = bags[i], bags[j]
            sa, sb = sum(a.values()), sum(b.values())
            if min(sa, sb) < 0.8 * max(sa, sb):
                continue
            both = sum((a & b).values())
            if both >= 0.8 * (sa + sb - both) - 1e-9:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in ids}


def classes_of(df, **kw):
    return {r.doc_id: r.class_id for r in near_classes(df, **kw).collect()}


def test_signatures_are_unbiased():
    rng = np.random.default_rng(3)
    for _ in range(5):
        a, b = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
        b[:30] = a[:30]
        keys = rng.integers(1, 1 << 62, 60).astype(np.uint64)
        rows = np.concatenate([np.zeros(60, int), np.ones(60, int)])
        w = np.concatenate([a, b])
        on = w > 0
        sig = signatures(rows[on], np.concatenate([keys, keys])[on], w[on], 2, registers=4000)
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((sig[0] == sig[1]).mean() - want) < 0.035


def test_overlap_counts_common_codes():
    rng = np.random.default_rng(4)
    bags = [np.unique(rng.integers(0, 500, n).astype(np.uint32)) for n in (0, 1, 50, 200, 300)]
    want = [[len(set(x) & set(y)) for y in map(list, bags)] for x in map(list, bags)]
    for kw in ({}, {"column_block": 16, "codes_at_once": 100}):
        got = _overlap(bags, **kw)
        off = ~np.eye(5, dtype=bool)
        assert (got[off] == np.array(want, float)[off]).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (202, 201), (300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_classes_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert classes_of(docs) == brute(texts)


@pytest.mark.parametrize("block", [1000, 7])
def test_a_cloud_of_edits(spark, block):
    """Each copy edits an earlier one; far copies are joined only through links."""
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(400)]
    texts = {0: " ".join(rnd.choices(vocab, k=120))}
    for i in range(1, 120):
        w = texts[rnd.randrange(max(0, i - 20), i)].split(" ")
        w[rnd.randrange(len(w))] = rnd.choice(vocab)
        texts[i] = " ".join(w)
    for i in range(120, 160):
        texts[i] = " ".join(rnd.choices(vocab, k=60))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert classes_of(df, block=block) == brute(texts)


def test_nulls_repeats_and_odd_texts(spark):
    word = "alpha beta gamma delta epsilon zeta eta theta"
    texts = {0: None, 1: "", 2: " ", 3: word, 4: word, 5: "alpha beta", 6: "alpha  beta", 7: "the " * 5000,
             8: "the " * 4900, 9: "the " * 100, 10: "x y z x y z " * 50}
    rows = list(texts.items()) + [(3, word), (None, word), (None, "other text without id"), (None, "other text without id")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, key int, class_id int")
    got = near_classes(df).collect()
    assert len(got) == len(rows)
    named = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert named == brute(texts)
    assert sorted(r.class_id >= 0 for r in got if r.doc_id is None) == [False, False, True]
    kept = keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(named.values())) and ids.count(None) == 1
    assert near_classes(df.limit(0)).collect() == []


def test_near_copies_without_ids(spark):
    rnd = random.Random(5)
    own = [[f"{c}{i}" for i in range(80)] for c in "ab"]
    def copies(words, n):
        return [" ".join(words[:-1] + [f"end{k}"]) for k in range(n)]
    with_id, without = copies(own[0], 4), copies(own[1], 5)
    rows = [(7, with_id[0]), (-3, with_id[1]), (None, with_id[2]), (None, with_id[3]), (9, "far from all others")]
    rows += [(None, t) for t in without]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_classes(df).collect()
    assert sorted(r.class_id for r in got)[-5:] == [-3, -3, -3, -3, 9]
    assert len({r.class_id for r in got}) == 3 and min(r.class_id for r in got) < -3
    kept = [(r.doc_id, r.text) for r in keep_one(df).collect()]
    assert len(kept) == 3 and (-3, with_id[1]) in kept and sum(d is None and t in without for d, t in kept) == 1


def test_every_text_of_a_repeated_id_counts(spark):
    """Each id of the first ten has two texts; copies of either are its class."""
    def text(c, end):
        return " ".join([f"{c}{i}" for i in range(80)] + [end])
    rows = [(i, text(f"{c}{i}x", "end")) for i in range(10) for c in "ab"]
    rows += [(100 + 10 * j + i, text(f"{c}{i}x", "other")) for i in range(10) for j, c in enumerate("ab")]
    rows += [(300 + i, text(f"b{i}x", "end")) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert {(r.doc_id, r.class_id) for r in near_classes(df).collect()} == {(d, d % 10) for d, _ in rows}
    kept = sorted(map(tuple, keep_one(df).collect()))
    assert [d for d, _ in kept] == list(range(10))
    assert kept == sorted(map(tuple, keep_one(df.orderBy("text")).collect()))


def test_low_thresholds_get_more_bands(spark):
    """Pairs at 0.51: with 20 bands about a quarter of them share none."""
    def text(i, own, end):
        return " ".join([f"c{i}x{k}" for k in range(54 + 4)] + [f"{end}{i}x{k}" for k in range(own)])
    texts = {2 * i + j: text(i, 26, end) for i in range(60) for j, end in enumerate("ab")}
    a, b = bag(texts[0]), bag(texts[1])
    assert 0.5 <= sum((a & b).values()) / sum((a | b).values()) < 0.52
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert classes_of(df, threshold=0.5) == {i: i - i % 2 for i in texts}
    with pytest.raises(ValueError):
        near_classes(df, threshold=0.0)
