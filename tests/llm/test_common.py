"""Shared helpers: words, window hashes, grouped work over small batches, blocks."""

from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicflow.llm import common
from civicflow.llm.common import drop_written, span_hashes, text_chunks, utf8, window_hashes, words, write_out
from civicflow.llm.graph import block_pairs, components, join_weighted, local_roots, map_groups

TEXT = st.text(alphabet=st.sampled_from("ab é日😀 \t\n\x0b\x0c\r\x1c "), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=6))
def test_words_are_those_of_the_byte_rule(texts):
    data, offsets = utf8(pa.array(texts, pa.string()))
    starts, ends, row = words(data, offsets)
    got = [[data[a:b].tobytes() for a, b, r in zip(starts, ends, row) if r == i] for i in range(len(texts))]
    assert got == [(t or "").encode().split() for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8), st.integers(1, 30))
def test_chunks_cover_every_row_once(texts, size):
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    parts = list(text_chunks([batch.slice(0, 0), batch], "t", size))
    assert [t for p, _, _ in parts for t in p.column(0).to_pylist()] == texts
    assert b"".join(d.tobytes() for _, d, _ in parts) == "".join(texts).encode()


def test_hashes_follow_content_only():
    spans = [b"", b"a", b"b", b"ab", b"ba", b"a" * 8, b"a" * 9, b"a" * 16, b"a" * 17, b"x" * 5000, b"x" * 4999 + b"y"]
    data = np.frombuffer(b"".join(spans + spans), np.uint8)
    ends = np.cumsum([len(s) for s in spans + spans])
    h = span_hashes(data, ends - [len(s) for s in spans + spans], ends)
    assert (h[:len(spans)] == h[len(spans):]).all() and len(set(h.tolist())) == len(spans)


def test_window_hashes_tell_orders_apart():
    h = np.array([1, 2, 3, 1, 2, 3, 2, 1, 3, 1, 2, 3], np.uint64)
    for k in (1, 2, 3, 5, 10, 12):
        w = window_hashes(h, k)
        keys = [tuple(h[i:i + k].tolist()) for i in range(len(h) - k + 1)]
        assert len(w) == len(keys)
        assert len(set(w.tolist())) == len(set(keys))
    assert len(window_hashes(h, 13)) == 0


def test_groups_survive_small_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(1000).select((F.col("id") * F.col("id") % 37).alias("g"), (F.col("id") % 2).alias("h"), F.col("id").alias("v"))

        def total(cols):
            return [cols["g"][:1], cols["h"][:1], np.array([cols["v"].sum()]), np.array([len(cols["v"])])]
        got = sorted(map(tuple, map_groups(df, ["g", "h"], total, "g bigint, h bigint, s bigint, n bigint").collect()))
        want = sorted(map(tuple, df.groupBy("g", "h").agg(F.sum("v"), F.count("v")).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == want


def test_every_pair_of_a_group_meets_in_a_block(spark):
    df = spark.range(60).select(F.when(F.col("id") < 50, 1).otherwise(2).alias("g"), F.col("id").alias("m"),
                                F.when(F.col("id") < 50, 50).otherwise(10).alias("n"))
    rows = block_pairs(df, "g", "m", "n", 12).collect()
    met = {}
    for r in rows:
        met.setdefault((r.g, r.lo, r.hi), set()).add(r.m)
    for g, ids in ((1, range(50)), (2, range(50, 60))):
        for a in ids:
            for b in ids:
                assert a == b or any(a in s and b in s for (k, _, _), s in met.items() if k == g)
    assert max(Counter((r.g, r.m) for r in rows).values()) <= 4


def test_local_roots():
    a = np.zeros((6, 6), bool)
    for i, j in ((0, 5), (5, 3), (1, 2)):
        a[i, j] = a[j, i] = True
    assert local_roots(a).tolist() == [0, 1, 1, 0, 4, 0]


def test_written_table_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    out = write_out(df, "test")
    assert out.schema == df.schema and sorted(out.collect()) == sorted(df.collect())


def test_hot_keys_are_joined_where_they_are(spark):
    """A key with a third of all rows and a node with a third of all links."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 4000).alias("k"), F.col("id").alias("v"))
    small = write_out(df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("m")), "test")
    out = join_weighted(df.repartition(9), small, ["k"], "n")
    assert sorted(out.select("k", "v", "m").collect()) == sorted(df.join(small, "k").select("k", "v", "m").collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 1
    # Matched rows are dealt by a hash of the row: no task of the shuffle join gets them all.
    at = F.when(F.col("k") == -1, F.xxhash64("k", "v")).otherwise(F.col("k"))
    load = df.groupBy(F.pmod(F.hash(at), F.lit(50))).count().agg(F.max("count"), F.avg("count")).first()
    assert load[0] < 2 * load[1]
    assert join_weighted(df, small.limit(0), ["k"], "n").collect() == []


def test_components_of_a_hub(spark):
    """One node has a third of all links; the other links are chains."""
    hub = [(5000 + i, 3) for i in range(1500)]
    chains = [(20_000 + 10 * i + j, 20_000 + 10 * i + j + 1) for i in range(400) for j in range(8)]
    got = {r.node: r.root for r in components(spark.createDataFrame(hub + chains, "a long, b long").repartition(7)).collect()}
    want = {3: 3} | {5000 + i: 3 for i in range(1500)}
    want |= {20_000 + 10 * i + j: 20_000 + 10 * i for i in range(400) for j in range(9)}
    assert got == want


def test_written_tables_can_be_dropped(spark, monkeypatch):
    import os
    monkeypatch.setattr(common, "_WRITTEN", [])
    write_out(spark.range(3), "test")
    write_out(spark.range(4), "test")
    folders = drop_written(spark)
    assert len(folders) == 2 and drop_written(spark) == []
    assert not any(os.path.exists(f.removeprefix("file:")) for f in folders)
