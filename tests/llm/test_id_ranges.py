"""Ranges of ids: any 64-bit ids, even sizes, the same under every layout."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from civicflow.llm.id_ranges import id_ranges
from civicflow.llm.imatch import edit_likeness, with_next
from civicflow.llm.warc_shards import read_archives, write_archives

RND = random.Random(12)
CASES = {
    "two": [1, 1 << 60],
    "hashed": [RND.randrange(-(1 << 63), 1 << 63) for _ in range(3000)],
    "whole range": [-(1 << 63), (1 << 63) - 1, *range(600)],
    "one far": [*range(3000), 1 << 62],
    "clusters": [c * 10 ** 15 + i for c in range(5) for i in range(600)],
    "nested": [sum(RND.randrange(2) << 3 * k for k in range(20)) for _ in range(3000)],
    "no ids": [None] * 1000 + list(range(500)),
}


@pytest.mark.parametrize("case", CASES)
def test_ranges_follow_the_data(spark, case):
    ids = CASES[case]
    df = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "id long, t string").repartition(5)
    ranges = id_ranges(df, F.col("id"), 16)
    again = id_ranges(df.repartition(2), F.col("id"), 16)
    assert (ranges.cells, ranges.nulls) == (again.cells, again.nulls)
    rows = df.select("id", ranges.number(F.col("id"), F.col("t")).alias("n"), ranges.cell(F.col("id")).alias("c")).collect()
    known = sorted((r.id, r.n) for r in rows if r.id is not None)
    assert [n for _, n in known] == sorted(n for _, n in known)
    assert all(r.n is not None and (r.n < ranges.null_parts) == (r.id is None) for r in rows)
    cells = {}
    for r in rows:
        assert r.id is None or cells.setdefault(r.n, r.c) == r.c
        assert r.id is None or ranges.cells[r.c][0] <= r.id <= ranges.cells[r.c][1]
    # 40 tasks: none has over twice the mean rows.
    load = Counter(hash(n) % 40 for n in (r.n for r in rows))
    if len(ids) >= 1000:
        assert max(load.values()) <= 2 * len(ids) / 40 + 16
        assert max(Counter(r.n for r in rows).values()) <= 64


@pytest.mark.parametrize("case", CASES)
def test_next_document(spark, case):
    ids = [i for i in dict.fromkeys(CASES[case]) if i is not None][:700]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in with_next(df, cell_rows=5).collect()}
    order = sorted(ids)
    assert got == {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1])}


def test_next_document_without_ids(spark):
    """Null ids form one ring with the others: every row is followed once."""
    rows = [(None, f"n{i}") for i in range(300)] + [(i * 10 ** 12, f"t{i}") for i in range(50)] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = with_next(df, cell_rows=7).collect()
    assert sorted(r.text for r in got) == sorted(r.next_text for r in got) == sorted(t or "" for _, t in rows)
    follow = {r.text: r.next_text for r in got}
    at, seen = "t0", []
    for _ in rows:
        seen.append(at)
        at = follow[at]
    assert at == "t0" and len(set(seen)) == len(rows) and seen[:50] == [f"t{i}" for i in range(50)]


@pytest.mark.parametrize("case", ["two", "whole range", "hashed"])
def test_fingerprints_and_archives_of_far_ids(spark, case, tmp_path):
    ids = CASES[case][:150]
    df = spark.createDataFrame([(i, f"some text {i % 7} of page {i}", "u") for i in ids], "doc_id long, text string, u string")
    assert edit_likeness(df).count() == len(ids)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    one = write_archives(df, a, "doc_id", "u", "text", shard_rows=16).collect()
    two = write_archives(df.repartition(7), b, "doc_id", "u", "text", shard_rows=16).collect()
    assert sorted(one) == sorted(two)
    assert sorted(r.page_id for r in read_archives(spark, a).collect()) == sorted(ids)
