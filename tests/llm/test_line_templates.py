"""Line templates against a brute-force version on real tokens."""

import random
import re
from collections import defaultdict

import pytest

from civicflow.llm.line_templates import DEPTH, MIN_SHARE, drop_recurring_lines

SPACE = re.compile("[ \t\n\x0b\x0c\r]+")


def brute(rows, min_docs=3):
    """rows: (doc_id, text) with unique ids -> doc_id: (text, n_lines, n_dropped)."""
    lines = {}
    for d, t in rows:
        for no, line in enumerate((t or "").split("\n")):
            toks = tuple("<*>" if re.search("[0-9]", x) else x for x in SPACE.split(line) if x)
            if toks:
                lines[d, no] = toks
    leaf = {k: (len(t), t[:DEPTH]) for k, t in lines.items()}
    leaf_docs, place_docs, kinds = defaultdict(set), defaultdict(set), defaultdict(set)
    for k, t in lines.items():
        leaf_docs[leaf[k]].add(k[0])
        kinds[leaf[k]].add(t)
    line_docs = defaultdict(set)
    for k, t in lines.items():
        line_docs[t].add(k[0])
    place_n = defaultdict(int)
    for t, docs in line_docs.items():
        for i in range(DEPTH, len(t)):
            place_n[(len(t), t[:DEPTH]), i, t[i]] += len(docs)
    template = {}
    for k, t in lines.items():
        if len(leaf_docs[leaf[k]]) < min_docs:
            continue
        fixed = tuple((i, t[i]) for i in range(DEPTH, len(t)) if place_n[leaf[k], i, t[i]] >= min_docs)
        if len(kinds[leaf[k]]) > 1 and fixed and len(fixed) + DEPTH >= MIN_SHARE * len(t):
            template[k] = (leaf[k], fixed)
        else:
            template[k] = (leaf[k], t)
    docs = defaultdict(set)
    for k, t in template.items():
        docs[t].add(k[0])
    out = {}
    for d, t in rows:
        if t is None:
            out[d] = (None, 0, 0)
            continue
        kept, n, lost = [], 0, 0
        for no, line in enumerate(t.split("\n")):
            n += (d, no) in lines
            tpl = template.get((d, no))
            if tpl is not None and len(docs[tpl]) >= min_docs and d != min(docs[tpl]):
                lost += 1
            else:
                kept.append(line)
        out[d] = ("\n".join(kept) if lost else t, n, lost)
    return out


def run(df):
    return {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in drop_recurring_lines(df, counts=True).collect()}


def test_variable_fields(spark):
    rows = [(i, f"Page {i} of 90\nown{chr(97 + i)} words{chr(97 + i)} of {chr(97 + i) * 3} here\nSent by user {chr(97 + i) * 4} from the web form today")
            for i in range(6)] + [(9, "Page x of 90"), (10, "nothing shared\n\n  \nat all")]
    want = brute(rows)
    assert want[3] == ("ownd wordsd of ddd here", 3, 2)
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == want
    assert want[0][2] == 0 and want[10][2] == 0


def test_random_lines(spark):
    rnd = random.Random(3)
    vocab = ["red", "blue", "sea", "sky", "7", "a1"]
    rows = [(d, "\n".join(" ".join(rnd.choices(vocab, k=rnd.randrange(0, 7))) for _ in range(rnd.randrange(0, 9))))
            for d in range(80)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == brute(rows)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(v[2] for v in want.values()) > 0
    assert run(docs) == want


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(1, "same line\nown one", "a", 5), (1, "same line\nown one", "a", 5), (2, "same line\n", "b", 5),
            (None, "same line\nx", "c", 5), (3, None, "d", 5), (4, "", "e", 5), (5, "w " * 200_000, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, line string, n_lines int")
    got = drop_recurring_lines(df)
    assert got.columns == df.columns
    texts = sorted(((r.doc_id, r.text, r.n_lines) for r in got.collect()), key=repr)
    assert texts == sorted([(1, "own one", 5), (1, "own one", 5), (2, "", 5), (None, "same line\nx", 5), (3, None, 5),
                            (4, "", 5), (5, "w " * 200_000, 5)], key=repr)
    assert drop_recurring_lines(df.limit(0)).collect() == []


@pytest.mark.parametrize("n", [100, 20_000])
def test_word_fields_at_any_size(spark, n):
    """A field's values stay fields when each occurs in many documents, beside another template of the leaf."""
    rnd = random.Random(n)
    def word(i):
        return "v" + "".join(chr(97 + int(c)) for c in str(i))
    rows = [(i, f"This article was posted by {word(rnd.randrange(300))} from {word(rnd.randrange(300))} on our web site today\n"
                f"own {word(i)}") for i in range(n)]
    rows += [(n + i, f"This article was first shown in the paper of {word(i)} and then sold on\nrare {word(i)}") for i in range(5)]
    got = run(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert {d for d, v in got.items() if v[2] == 0} == {0, n}
    assert all(v == (rows[d][1].split("\n")[1], 2, 1) for d, v in got.items() if d not in (0, n))
