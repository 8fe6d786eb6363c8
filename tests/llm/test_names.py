"""Every interface that passes columns on takes tables with any other column names, null and repeated ids."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from civicflow.llm import bagminhash, bpe_prefix, host_rules, line_templates, packing, piece_bpe, pii_anchors, whitening

NAMES = ["__gone", "__doc", "__text", "__id", "__key", "__task", "__nth", "__rank", "__before", "__host", "__rejected", "__n_words",
         "__vector", "doc", "line", "leaf", "key", "node", "class_id", "id", "at", "col0", "col3", "n", "m", "a", "b", "host", "vector",
         "template", "first_doc", "n_docs", "bucket", "count", "word"]
OUTPUTS = {
    "lines": ["n_lines", "n_dropped"], "rules": [*host_rules.COUNTS, "base_failed", "host_rejected", "kept"], "pack": packing.OUT,
    "pii": pii_anchors.FOUND, "bpe": bpe_prefix.OUT, "pieces": piece_bpe.OUT, "whiten": whitening.OUT}
FUNCTIONS = {
    "lines": lambda d: line_templates.drop_recurring_lines(d, counts=True),
    "rules": host_rules.judge,
    "pack": lambda d: packing.pack(d, P.path("byte_bpe_50k.json")),
    "pii": pii_anchors.find,
    "bpe": lambda d: bpe_prefix.encode(d, P.path("byte_bpe_multi_50k.tiktoken")),
    "pieces": lambda d: piece_bpe.encode(d, P.path("piece_bpe_32k.model")),
    "whiten": lambda d: whitening.whiten(d),
    "good": host_rules.keep_good, "one": bagminhash.keep_one, "redact": pii_anchors.redact_texts,
}


@pytest.fixture(scope="module")
def docs(spark):
    line = "all rights reserved by the owner of this page"
    prose = "the quick brown fox jumps over the lazy dog near an old river bank while two birds sing"
    rows = [(1, f"{prose}\n{line}", "h1"), (1, f"{prose}\n{line}", "h1"), (2, f"a@b.co wrote {prose}\n{line}", "h1"), (None, f"{line}\nmore words here {prose}", None),
            (None, None, "h2"), (3, "", "h2"), (4, prose.upper(), "h2"), (5, f"{line}\n{prose} again and again", "h3")]
    rows = [(*r, [float(len(r[1] or "")), float(i), 1.0 / (i + 1)]) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, embedding array<double>").repartition(3)


@pytest.mark.parametrize("name", FUNCTIONS)
def test_other_columns_do_not_matter(docs, name):
    run, made = FUNCTIONS[name], OUTPUTS.get(name, [])
    plain = run(docs)
    extra = [c for c in dict.fromkeys(NAMES + [x for v in OUTPUTS.values() for x in v]) if c not in docs.columns]
    wide = docs.select(*[F.lit(f"own {c}").alias(c) for c in extra], *docs.columns)
    out = run(wide)
    passed = [c for c in extra if c not in made]
    assert [c for c in out.columns if c in passed] == passed
    assert set(out.columns) == set(plain.columns) | set(passed)
    rows, want = out.collect(), plain.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in passed)
    # Ties of equal lengths may change places, and signs of components are free.
    cols = [c for c in plain.columns if c not in ("whitened", *(["sequence_id", "offset"] if name == "pack" else []))]
    assert sorted(str([r[c] for c in cols]) for r in rows) == sorted(str([r[c] for c in cols]) for r in want)
    assert rows


def test_own_columns_may_have_any_name(docs):
    named = docs.toDF("__doc", "__gone", "text", "doc_id")
    out = line_templates.drop_recurring_lines(named, doc_id="__doc", text="__gone")
    assert out.columns == named.columns
    want = line_templates.drop_recurring_lines(docs).select("text").collect()
    assert sorted(map(str, [tuple(r) for r in out.select("__gone").collect()])) == sorted(map(str, [tuple(r) for r in want]))
    kept = host_rules.keep_good(named, text="__gone", host="text")
    assert kept.columns == named.columns and kept.count() == host_rules.keep_good(docs).count()
