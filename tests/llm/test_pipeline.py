"""Every stage of the pipeline against a brute-force version, on its own input."""

import re
from collections import Counter

import corpus_pipeline as cp
from llm import test_bagminhash, test_line_templates, test_packing, test_pii_anchors
from pyspark.sql import Row

from civicflow.llm.pii_anchors import spans

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rules(rows):
    """doc ids that stay."""
    failed, counted, hosts = set(), set(), {}
    for r in rows:
        w = [x for x in re.split("[ \t\n\x0b\x0c\r]+", r.text or "") if x]
        grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        times = Counter(grams)
        cover = {i + o for i, g in enumerate(grams) if times[g] > 1 for o in range(5)}
        if len(w) < 10 or 100 * len(cover) > 20 * len(w):
            failed.add(r.doc_id)
        symbols = len(re.findall(r"[#*$%&|<>]", r.text or ""))
        n, k = hosts.get(r.source, (0, 0))
        hosts[r.source] = (n + 1, k + (r.doc_id in failed or symbols > 0.5 * len(w)))
    rates = [k / n for n, k in hosts.values()]
    mean = sum(rates) / len(rates)
    var = sum((x - mean) ** 2 for x in rates) / len(rates)
    strength = max(5.0, mean * (1 - mean) / var - 1 if var else 5.0)
    bad = {h for h, (n, k) in hosts.items() if (k + strength * mean) / (n + strength) >= 0.5}
    return {r.doc_id for r in rows if r.doc_id not in failed and r.source not in bad}


def long_rows(docs):
    """Two near copies of over 40,000 characters, with an address at the end."""
    words = ["w" + "".join(chr(97 + int(c)) for c in f"{i:05d}") for i in range(6500)]
    first = docs.orderBy("doc_id").first()
    lines = [" ".join(words[i:i + 13]) for i in range(0, len(words), 13)]
    texts = ["\n".join(lines + [f"write to {who} at {who}@mail.example.org"]) for who in ("ann", "bob")]
    assert min(map(len, texts)) > 40_000
    last = docs.selectExpr("max(doc_id)").first()[0]
    return [Row(**{**first.asDict(), "doc_id": last + 1 + i, "text": t, "n_chars": len(t)}) for i, t in enumerate(texts)]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect() + long_rows(docs)
    docs = spark.createDataFrame(rows, docs.schema).repartition(3)
    for name, stage in cp.STAGES:
        out = cp.write_out(stage(spark, docs, SF), "test")
        before = {r.doc_id: r for r in docs.collect()}
        if name != "packing":
            assert out.columns == COLUMNS
            after = {r.doc_id: r for r in out.collect()}
            assert all((r.lang, r.source) == (before[d].lang, before[d].source) for d, r in after.items())
        if name == "quality_rules":
            assert set(after) == rules(list(before.values())) and len(after) > 0.8 * len(before)
            assert all(r == before[d] for d, r in after.items())
        elif name == "line_dedup":
            want = test_line_templates.brute([(d, r.text) for d, r in before.items()])
            assert {d: r.text for d, r in after.items()} == {d: w[0] for d, w in want.items()}
        elif name == "near_dedup":
            want = test_bagminhash.brute({d: r.text for d, r in before.items()})
            assert set(after) == set(want.values()) and all(r == before[d] for d, r in after.items())
            assert len(after) < len(before)
        elif name == "pii":
            assert set(after) == set(before)
            for d, r in after.items():
                assert (r.text == before[d].text) == (not spans(before[d].text))
                assert not [s for s in test_pii_anchors.brute(r.text) if s[0] in ("email", "phone", "card", "ip")]
        else:
            cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            assert out.columns == cols
            test_packing.check([tuple(r) for r in out.collect()], {d: r.text for d, r in before.items()})
        docs = out


def test_run_and_registration(spark):
    import __spark_entry__ as e
    assert "pipeline" in e.queries() and "pipeline" not in e.oracle_sql()
    assert sum(n.startswith("op") for n in e.queries()) >= 10
    out = e.queries()["pipeline"](spark, SF)
    assert out.count() > 100
    assert out.groupBy("sequence_id").sum("length").filter("`sum(length)` > 1024").count() == 0


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []
        docs = spark.createDataFrame([], docs.schema)


def test_odd_tables(spark):
    """Null ids and texts, repeated rows, ties, a long text and clashing names, through every stage."""
    prose = "the quick brown fox jumps over a lazy dog near an old river bank while two birds sing"
    rows = [(i, f"{prose} {'abcdefghij'[i % 10] * 3} number{i} {'x y z '[i % 3] * 2}") for i in range(40)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (None, f"no id {prose} one two three"), (None, f"no id {prose} one two three"), (None, None), (50, None),
             (51, ""), (52, f"mail me at a.b@c.org {prose}"), (7, "another text under the same id of seven " + prose.upper()),
             (60, " ".join(f"{w}{k}" for k in range(4000) for w in prose.split()))]
    extra = ["__gone", "__doc", "__id", "__task", "n_words", "kept", "class_id", "line", "col0", "length"]
    docs = spark.createDataFrame([(d, t, "en", "h", None if t is None else len(t), *["own"] * len(extra)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{c} string" for c in extra)).repartition(4)
    names = docs.columns
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        got = out.collect()
        assert got, name
        if name != "packing":
            assert out.columns == names, name
            assert all(r[c] == "own" for r in got for c in extra)
            docs = spark.createDataFrame(got, docs.schema).repartition(3)
        kept = {r.doc_id for r in got}
        assert {50, 51}.isdisjoint(kept) and {52, 60} <= kept, name
        if name == "near_dedup":
            assert sum(r.doc_id == 3 for r in got) <= 1 and sum(r.doc_id is None for r in got) <= 1
        if name == "pii":
            assert "<EMAIL>" in next(r.text for r in got if r.doc_id == 52)
    assert all(r.length <= 1024 for r in got)
