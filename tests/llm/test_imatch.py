"""I-Match against its SQL, and its defined cases."""

import pytest

import oracle_compare
from civicflow.llm.imatch import SUBSETS, edit_likeness, fingerprints, with_next
from civicflow.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_matches_sql(spark, duck):
    res = oracle_compare.compare(QUERIES["op2_imatch"](spark, SF), duck, SQL["op2_imatch"])
    assert res["status"] == "ok", res


def test_edits_are_nearer_than_neighbours(spark):
    rows = QUERIES["op2_imatch"](spark, "/root/testdata/sf0.01").select("near_edited", "near_next").collect()
    assert sum(r.near_edited > r.near_next for r in rows) > 0.75 * len(rows)
    assert sum(r.near_edited for r in rows) > 5 * sum(r.near_next for r in rows)


@pytest.mark.parametrize("cell_rows", [1, 3, 512])
def test_next_document_with_gaps(spark, cell_rows):
    ids = [5, -3, 100, 101, 102, 4000, None, 7]
    df = spark.createDataFrame([(i, f"t{i}", 0) for i in ids], "doc_id long, text string, bucket int")
    got = {r.doc_id: r.next_text for r in with_next(df, cell_rows=cell_rows).collect()}
    order = [None, -3, 5, 7, 100, 101, 102, 4000]
    assert got == {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1])}


def test_texts_are_shuffled_once(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    plan = edit_likeness(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Python" not in plan and "Arrow" not in plan


def test_nulls_repeats_and_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "Été ÉTÉ été, 12"), (4, "été 12"), (5, "x " * 100_000), (5, "x " * 100_000), (6, "!?")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = edit_likeness(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint == by[6].fingerprint == ".".join(["-"] * len(SUBSETS))
    assert by[1].near_edited == by[1].near_next == 1.0
    assert by[3].fingerprint == by[4].fingerprint and by[3].near_next == 1.0
    assert by[2].near_next == 0.0
    assert by[4].n_chars == 6
    assert fingerprints(df).columns == ["doc_id", "fingerprint"]
    assert edit_likeness(df.limit(0)).collect() == []
    one = edit_likeness(df.filter("doc_id = 3")).collect()
    assert one[0].near_next == 1.0
