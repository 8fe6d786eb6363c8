"""Rule ensemble: held-out accuracy, rules against their compiled form, defined cases."""

import math

import pytest
from pyspark.sql import functions as F

from civicflow.llm.queries import QUERIES
from civicflow.llm.rule_ensemble import STATS, Model, fit, held_out, paths, rule_column, statistics

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = QUERIES["op8_rule_ensemble"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out and quality is not null").collect()
    assert len(rows) > 300
    hit = sum(r.predicted == r.quality for r in rows) / len(rows)
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    print("accuracy", hit, "auc", auc)
    assert hit > 0.95 and auc > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_paths():
    tree = """DecisionTreeClassificationModel
  If (feature 3 <= 0.5)
   If (feature 0 <= 2.0)
    Predict: 0.0
   Else (feature 0 > 2.0)
    Predict: 1.0
  Else (feature 3 > 0.5)
   If (feature 3 <= 0.75)
    Predict: 0.0
   Else (feature 3 > 0.75)
    Predict: 0.0
"""
    a, b, inf = STATS[0], STATS[3], math.inf
    assert paths(tree) == {((b, -inf, 0.5),), ((a, -inf, 2.0), (b, -inf, 0.5)), ((a, 2.0, inf), (b, -inf, 0.5)),
                           ((b, 0.5, inf),), ((b, 0.5, 0.75),), ((b, 0.75, inf),)}


def test_compiled_score(spark):
    rules = [(((STATS[0], 0.5, 2.0),), 1.5), (((STATS[0], -math.inf, 1.0), (STATS[1], 3.0, math.inf)), -2.0)]
    df = spark.createDataFrame([(0.2, 4.0), (0.7, 4.0), (1.5, 1.0), (3.0, 9.0)], [STATS[0], STATS[1]])
    got = [r.s for r in df.select(Model(0.25, rules).score().alias("s")).collect()]
    assert got == pytest.approx([1 / (1 + math.exp(-x)) for x in (-1.75, -0.25, 1.75, 0.25)])


def test_fold_and_defined_cases(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "Word WORD word 12 !!\nword\nword", 1), (None, "x", 1), (4, "é " * 300_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, top_share int")
    stats = statistics(df)
    got = {r.doc_id: r for r in stats.collect()}
    assert [got[1][c] for c in STATS] == [got[2][c] for c in STATS] == [0.0] * len(STATS)
    assert got[3].dup_line_share == pytest.approx(1 / 3) and got[3].top_share == pytest.approx(3 / 7)
    assert statistics(df.limit(0)).collect() == []
    import zlib
    for r in df.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect():
        assert r.h == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    none = fit(stats.withColumn("label", F.lit(1)).limit(0))
    assert none.rules == [] and none.intercept == 0.0
    one = fit(stats.withColumn("label", F.lit(1)))
    assert one.rules == [] and one.intercept == pytest.approx(math.log(6 / 1))


def plain(text):
    """The 14 statistics of one text, read plainly."""
    import re
    from collections import Counter
    text = text or ""
    own = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text) if w]
    n = len(own)
    sizes = [len(w.encode()) for w in own]
    per = 1 / max(n, 1)

    def rate(signs):
        return sum(text.count(c) for c in signs) * per
    upper = sum("A" <= c <= "Z" or "À" <= c <= "Þ" for c in text)
    lower = sum("a" <= c <= "z" or "ß" <= c <= "ÿ" for c in text)
    grams = Counter(tuple(own[i:i + 5]) for i in range(n - 4))
    cover = {j for i in range(n - 4) if grams[tuple(own[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return {
        "log_words": math.log1p(n), "mean_word": sum(sizes) * per, "longest_word": math.log1p(max(sizes, default=0)),
        "symbol_rate": rate("#*$%&<>"), "bang_rate": rate("!"), "bar_rate": rate("|"), "digit_rate": rate("0123456789"),
        "upper_share": upper / max(upper + lower, 1), "stop_rate": rate("."), "distinct_share": len(set(own)) * per,
        "top_share": max(Counter(own).values(), default=0) * per, "repeat_share": len(cover) * per,
        "line_words": math.log1p(n / max(len(lines), 1)), "dup_line_share": (len(lines) - len(set(lines))) / max(len(lines), 1)}


def test_all_statistics_against_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    texts = [r.text for r in docs] + [None, "", " \n\t ", "a", "ÀÉ ßÿ × ÷ Öx", "x y z u v x y z u v", "!!! | # * 9 . é日😀", "a b\na b\n\n c\na b", "w " * 20_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r for r in statistics(rows).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        for name, value in plain(t).items():
            assert got[i][name] == pytest.approx(value, abs=1e-12), (i, name, (t or "")[:80])


def test_rules_hit_what_the_printed_trees_say(spark):
    """Each row walks down the printed trees; its path's rules are the ones that hold for it."""
    import random
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector
    rnd = random.Random(3)
    data = [(i, *[rnd.random() for _ in STATS], float(rnd.random() < 0.5)) for i in range(300)]
    df = spark.createDataFrame(data, ["i", *STATS, "label"]).withColumn("features", array_to_vector(F.array(*STATS)))
    trees = RandomForestClassifier(numTrees=4, maxDepth=3, seed=5).fit(df).trees
    rules = sorted(set().union(*[paths(t.toDebugString) for t in trees]))
    assert len(rules) > 10
    held = df.select("i", *[rule_column(r).alias(f"r{k}") for k, r in enumerate(rules)]).collect()
    values = {r[0]: dict(zip(STATS, r[1:])) for r in data}

    def walked(row, text):
        """Rules of the nodes that a row visits, from the tree's own text."""
        import re
        lines = text.splitlines()[1:]
        out, box, lo, hi = set(), {}, 0, len(lines)
        while lo < hi and (m := re.match(r"(\s*)If \(feature (\d+) <= (\S+)\)", lines[lo])):
            name, limit = STATS[int(m[2])], float(m[3])
            other = next(i for i in range(lo + 1, hi) if lines[i].startswith(m[1] + "Else"))
            low, high = box.get(name, (-math.inf, math.inf))
            if row[name] <= limit:
                box[name], lo, hi = (low, min(high, limit)), lo + 1, other
            else:
                box[name], lo = (max(low, limit), high), other + 1
            out.add(tuple(sorted((k, a, b) for k, (a, b) in box.items())))
        return out

    for r in held:
        want = set().union(*[walked(values[r.i], t.toDebugString) for t in trees])
        got = {rule for k, rule in enumerate(rules) if r[f"r{k}"]}
        assert want <= got
        assert all(all(a < values[r.i][n] <= b for n, a, b in rule) == (rule in got) for rule in rules)


def test_repeated_labels_teach_each(spark):
    """Two rows of label 1 for a document weigh as two: the prior share shows it where no rule can."""
    rows = [(i, 1.0, *[1.0] * len(STATS)) for i in range(3)]
    df = spark.createDataFrame(rows, ["doc_id", "label", *STATS])
    assert fit(df).intercept == pytest.approx(math.log(4))
    assert fit(df.unionByName(df)).intercept == pytest.approx(math.log(7))


def test_query_scores_as_the_rules_read_plainly(spark):
    """Every document's score from its plain statistics and the fitted rules, walked in Python."""
    import zlib
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op8_rule_ensemble"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("quality IN (0, 1)").collect()
    teach = {r.doc_id: r.quality for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5}
    stats = {d.doc_id: plain(d.text) for d in docs}
    rows = [(d, float(q), *[float(stats[d][c]) for c in STATS]) for d, q in teach.items() if d in stats]
    model = fit(spark.createDataFrame(rows, "doc_id long, label double, " + ", ".join(f"{c} double" for c in STATS)))
    assert model.rules and len(got) == len(docs)
    near = 0
    for d in docs:
        total = model.intercept + sum(w for rule, w in model.rules if all(a < stats[d.doc_id][n] <= b for n, a, b in rule))
        near += abs(got[d.doc_id].score - 1 / (1 + math.exp(-total))) < 1e-6
        assert got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 5 == 0)
        assert got[d.doc_id].predicted == (got[d.doc_id].score >= 0.3)
    assert near >= 0.99 * len(docs)  # a value on a rule's limit may fall to either side by its last bit
