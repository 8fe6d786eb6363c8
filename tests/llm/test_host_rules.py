"""Host rules against their SQL, and their defined cases."""

import oracle_compare

from civicflow.llm.host_rules import COUNTS, host_verdicts, judge, keep_good, rule_counts
from civicflow.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
GOOD = "one two three four five six seven eight nine ten eleven"


def test_matches_sql(spark, duck):
    res = oracle_compare.compare(QUERIES["op10_host_rules"](spark, SF), duck, SQL["op10_host_rules"])
    assert res["status"] == "ok", res


def test_counts(spark):
    rows = [(1, "a b c d e x a b c d e"), (2, "l\nl\n \nl #|é"), (3, "a b c d e a b c d e a b c d e"), (4, "x\x0by\x1cz w")]
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in rule_counts(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (11, 11, 0, 0, 10), 2: (4, 6, 2, 1, 0), 3: (15, 15, 0, 0, 15), 4: (2, 6, 0, 0, 0)}


def test_bad_hosts_take_their_documents_along(spark):
    rows = [(i, GOOD, f"h{i % 6}") for i in range(120)] + [(1000 + i, "short", "bad") for i in range(40)] + [(2000, GOOD, "bad")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    verdicts = {r.host: r for r in host_verdicts(rule_counts(df)).collect()}
    assert [h for h, r in verdicts.items() if r.host_rejected] == ["bad"]
    assert verdicts["bad"].n_docs == 41 and verdicts["bad"].n_failed == 40
    assert 0.5 < verdicts["bad"].shrunk_rate < 40 / 41
    kept = {r.doc_id for r in judge(df).filter("kept").collect()}
    assert kept == set(range(120)) == {r.doc_id for r in keep_good(df).collect()}
    late = judge(df).filter("doc_id = 2000").first()
    assert late.host_rejected and not late.base_failed


def test_one_bad_document_does_not_sink_its_host(spark):
    rows = [(i, GOOD, f"h{i % 6}") for i in range(120)] + [(500, "short", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert not host_verdicts(rule_counts(df)).filter("host_rejected").collect()


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(1, None, "a", 9), (1, None, "a", 9), (None, GOOD, None, 9), (2, GOOD, "a", 9), (3, "", "a", 9), (4, "w " * 300_000, "a", 9),
            (5, GOOD, "a", 9), (6, GOOD, "a", 9), (7, GOOD, "a", 9), (8, GOOD, "a", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")
    assert judge(df).count() == len(rows)
    kept = keep_good(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.n_words) for r in kept.collect()) == [(x, 9) for x in ("2", "5", "6", "7", "8", "None")]
    assert judge(df.limit(0)).collect() == [] == keep_good(df.limit(0)).collect()
