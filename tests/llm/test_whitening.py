"""Whitening against exact integers and a plain eigen-decomposition."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicflow.llm.whitening import OUT, exact_gram, fit, independent, shifted_factor, solve_rows, whiten

SF = "/root/testdata/sf0.01"


def plain(vectors, components=32):
    """n, deviations, eigenvalues, components, trace of the rule, in Python integers and numpy."""
    x = [[int(np.floor(np.float64(c) * 64)) + 1_000_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in x) * n - s[i] * s[j], n * n)) for j in range(len(s))]
                  for i in range(len(s))])
    e, w = np.linalg.eigh(v)
    order = np.argsort(-e)[:components]
    centred = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(r, s)] for r in x])
    return n, deviation, e[order], w[:, order], np.trace(v), centred


def compare(rows, vectors, live=None):
    """rows: by vector position, the component rows in order."""
    n, deviation, e, w, trace, centred = plain(vectors)
    live = len(e) if live is None else live
    got = np.array([[r.whitened if r.whitened is not None else np.nan for r in own] for own in rows])
    assert got.shape == (n, len(e))
    want = centred @ w[:, :live] / np.sqrt(e[:live])
    sign = np.sign((got[:, :live] * want).sum(axis=0))
    assert np.abs(got[:, :live] * sign - want).max() < 1e-6
    assert np.isnan(got[:, live:]).all()
    for own, d in zip(rows, deviation):
        assert [r.component for r in own] == list(range(1, len(e) + 1))
        assert {r.n for r in own} == {n} and {r.deviation for r in own} == {d}
        assert np.allclose([r.explained for r in own][:live], e[:live] / trace, rtol=1e-9)
        assert max(r.identity_error for r in own) < 1e-9


def by_key(rows, key):
    out = {}
    for r in sorted(rows, key=lambda r: (r[key], r.component)):
        out.setdefault(r[key], []).append(r)
    return out


def test_query(spark):
    from civicflow.llm.queries import QUERIES
    rows = QUERIES["op11_whitening"](spark, SF)
    assert rows.columns == ["vec_id", *OUT]
    got = by_key(rows.collect(), "vec_id")
    data = spark.read.parquet(f"{SF}/embeddings.parquet").filter("embedding is not null").orderBy("vec_id").collect()
    data = [r for r in data if all(c is not None and np.isfinite(c) for c in r.embedding)]
    assert list(got) == [r.vec_id for r in data]
    compare([got[r.vec_id] for r in data], [r.embedding for r in data])


def test_nulls_lengths_repeats_and_clashing_names(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(40, 5)).tolist()
    good += [good[0]] * 20
    bad = [None, [None] * 5, [1.0, float("nan"), 0.0], [1.0, float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], [], [0.5] * 6]
    data = [(i % 7, i, v, "n", 9) for i, v in enumerate(good)] + [(None, 900 + i, v, "n", 9) for i, v in enumerate(bad)]
    df = spark.createDataFrame(data, "vec_id long, k int, embedding array<double>, n string, __vector int").repartition(5)
    out = whiten(df)
    assert out.columns == ["vec_id", "k", "__vector", *OUT]
    got = by_key(out.collect(), "k")
    assert list(got) == list(range(60))
    compare([got[i] for i in range(60)], good)
    assert whiten(df.filter("embedding is null")).collect() == []


@pytest.mark.parametrize("case", ["constant", "few rows", "one row", "dependent"])
def test_dependent_dimensions(spark, case):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 4))
    whole = np.floor(base * 64) / 64
    vectors, live = {
        "constant": (np.hstack([base, np.full((30, 2), 0.5)]), 4),
        "few rows": (rng.normal(size=(4, 9)), 3),
        "one row": (base[:1], 0),
        "dependent": (np.hstack([whole, whole[:, :2] * 2, whole[:, :1] - whole[:, 1:2]]), 4),
    }[case]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "k int, embedding array<double>")
    got = by_key(whiten(df).collect(), "k")
    if case == "one row":
        assert [(r.whitened, r.explained, r.deviation) for r in got[0]] == [(None, None, 0)] * 4
    else:
        compare([got[i] for i in range(len(vectors))], vectors.tolist(), live)


def test_far_eigenvalues_take_more_passes(spark):
    """Entries from 1e-1 to 1e7: the Gram matrix alone has no correct digit of the smallest."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 6)) * 10.0 ** np.arange(7, 1, -1)
    mixed = base @ np.linalg.qr(rng.normal(size=(6, 6)))[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(mixed)], "k int, embedding array<double>").repartition(4)
    w = fit(df)
    assert w.passes >= 3 and w.identity_error < 1e-9
    got = by_key(whiten(df).collect(), "k")
    n, deviation, e, _, trace, _ = plain(mixed.tolist())
    assert [got[i][0].deviation for i in range(300)] == [d if d < 1 << 63 else None for d in deviation]
    assert np.allclose(w.eigenvalues[:3], e[:3], rtol=1e-9)


def test_huge_entries_are_bounded(spark):
    df = spark.createDataFrame([(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [0.0, 5.0])], "k int, embedding array<double>")
    rows = whiten(df).collect()
    assert len(rows) == 6 and all(r.deviation is None or r.deviation > 0 for r in rows)


def test_exact_sums():
    y = np.array([[3, -(1 << 60)], [5, (1 << 60) - 1024], [-7, 12345]], np.float64)
    whole = [[1, *map(int, r)] for r in y]
    want = [[sum(r[i] * r[j] for r in whole) for j in range(3)] for i in range(3)]
    assert exact_gram(y).tolist() == want
    assert exact_gram(np.array([[1.0, 2.0]] * 5000)).tolist() == [[5000, 5000, 10000], [5000, 5000, 10000], [10000, 10000, 20000]]


def test_independent_columns_and_solves():
    a = np.array([[1, 2, 3, 0], [2, 4, 1, 0], [0, 0, 5, 0]], object)
    assert independent(a.T @ a).tolist() == [0, 2]
    rng = np.random.default_rng(6)
    m = rng.normal(size=(50, 7))
    r = shifted_factor(m.T @ m)
    assert np.allclose(solve_rows(m, r) @ r, m)
    assert np.allclose(r, np.triu(r))


def test_result_does_not_depend_on_the_layout(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    a, b = fit(df.repartition(1)), fit(df.repartition(13, F.rand(1)))
    assert a.n == b.n and a.sums == b.sums and np.allclose(a.components, b.components, atol=1e-9)
