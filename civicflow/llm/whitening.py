"""Whitening of embeddings by shifted Cholesky QR.

A vector entry c becomes the integer ``floor(64 * c)``.  One pass sums counts,
entries and products exactly, so the Gram matrix of the centred rows is exact
before it is rounded.  Its Cholesky factor, with a small shift that keeps a
nearly dependent matrix positive, orthogonalises the rows: the next pass solves
the triangular system for every row, sums the Gram matrix of the results, and
takes the factor of that.  This goes on until the rows are orthonormal.  The
product of the factors is the R of the centred table, whatever its condition;
the singular value decomposition of R gives components and eigenvalues.

Every pass sums one matrix per task; the tasks' rows of it meet by row number,
so the driver sees one matrix of dimension x dimension and never a vector.
Dimensions that depend on others exactly (constant ones, or with fewer rows
than dimensions) are told by elimination of the integer matrix modulo a prime;
they take part through their products with the orthonormal rows.

Defined cases: a null vector, or one with null or non-finite entries, has no
result rows.  Vectors of another length than the most common one (ties: the
longer) cannot be compared with the rest and have none either.  Entries beyond
2^60 / 64 in size count as that bound.  An empty table gives an empty result;
repeated rows and ids count each.  A component of eigenvalue 0 has null
whitened values; a deviation beyond a long is null, and so is explained where
all rows are equal.  Other columns are passed through, but an input column
named like an output is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, sheltered

SCALE, OFFSET = 64, 1_000_000
BOUND = 1 << 60
LIMB = 20  # bits of a part whose products are summed exactly in doubles
WIDE = 32  # bytes of a stored exact integer
EXACT_ROWS = 4096
SETTLED = 1e-8  # the last factor corrects what is left
MAX_PASSES = 12
PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
OUT = ["component", "n", "deviation", "whitened", "explained", "identity_error"]


# -- rows --------------------------------------------------------------------

def usable(vector: Column) -> Column:
    """Not null, and without null or non-finite entries."""
    v = vector.cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad, F.lit(False))


def matrices(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each vector length in a batch: row numbers, and entries as floored integers (in doubles)."""
    sizes = pc.list_value_length(col).to_numpy(zero_copy_only=False)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        at = (ends[rows] - d)[:, None] + np.arange(d)[None, :]
        yield rows, np.clip(np.floor(flat[at] * SCALE), -BOUND, BOUND)


# -- exact sums --------------------------------------------------------------

def exact_gram(y: np.ndarray) -> np.ndarray:
    """``[1 y]^T [1 y]`` in Python integers: count, sums and products of integer rows."""
    total = 0
    for lo in range(0, len(y), EXACT_ROWS):
        block = np.hstack([np.ones((min(EXACT_ROWS, len(y) - lo), 1)), y[lo:lo + EXACT_ROWS]])
        if np.abs(block).max() < 1 << LIMB:
            total = total + (block.T @ block).astype(np.int64).astype(object)
            continue
        whole = block.astype(np.int64)
        limbs = [whole & ((1 << LIMB) - 1), (whole >> LIMB) & ((1 << LIMB) - 1), whole >> 2 * LIMB]
        limbs = [x.astype(np.float64) for x in limbs]
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total = total + (a.T @ b).astype(np.int64).astype(object) * (1 << LIMB * (i + j))
    return total


def _pack_exact(row: np.ndarray) -> bytes:
    return b"".join(int(v).to_bytes(WIDE, "little", signed=True) for v in row)


def _add_exact(raw: list[bytes]) -> bytes:
    rows = [[int.from_bytes(r[i:i + WIDE], "little", signed=True) for i in range(0, len(r), WIDE)] for r in raw]
    return _pack_exact(np.array(rows, object).sum(axis=0))


def _add_doubles(raw: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(r) for r in raw], axis=0).tobytes()


def sum_matrices(df: DataFrame, vector: str, part: Callable, pack: Callable, add: Callable) -> dict[int, list[bytes]]:
    """The sum over all rows of ``part(y)``, a matrix per block of rows, by vector length.

    A task adds up its own blocks and sends one row for each row of the matrix;
    equal row numbers of all tasks meet in one task, which adds them in turn.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            rows = [(d, i, pack(r)) for d, m in held.items() for i, r in enumerate(m)]
            held.clear()
            dims, index, raw = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(dims, pa.int64()), pa.array(index, pa.int64()),
                                               pa.array(raw, pa.binary())], names=["dim", "i", "row"])
        for batch in batches:
            for _, y in matrices(batch.column(0)):
                d = y.shape[1]
                m = part(y)
                held[d] = held[d] + m if d in held else m
                if sum(k * k for k in held) > 1 << 23:  # many lengths in one task
                    yield flush()
        if held:
            yield flush()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], bytes] = {}
        for batch in batches:
            for d, i, raw in zip(*(c.to_pylist() for c in batch.columns)):
                held[d, i] = add([held[d, i], raw]) if (d, i) in held else raw
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in held], pa.int64()),
                                              pa.array([k[1] for k in held], pa.int64()),
                                              pa.array(list(held.values()), pa.binary())], names=["dim", "i", "row"])

    schema = "dim bigint, i bigint, row binary"
    parts = map_arrow(df.select(F.col(f"`{vector}`").cast("array<double>").alias("v")), partial, schema)
    out: dict[int, dict[int, bytes]] = {}
    for r in map_arrow(parts.repartition("dim", "i"), whole, schema).collect():
        out.setdefault(r.dim, {})[r.i] = bytes(r.row)
    return {d: [rows[i] for i in range(len(rows))] for d, rows in out.items()}


# -- linear algebra on matrices of dimension x dimension -----------------------

def independent(gram: np.ndarray) -> np.ndarray:
    """First columns of an integer matrix that do not depend on those before them."""
    best: list[int] = []
    for p in PRIMES:
        m = np.array([[int(v) % p for v in row] for row in gram], np.int64).reshape(gram.shape)
        found, top = [], 0
        for j in range(m.shape[1]):
            rows = np.flatnonzero(m[top:, j])
            if len(rows) == 0:
                continue
            m[[top, top + rows[0]]] = m[[top + rows[0], top]]
            m[top] = m[top] * pow(int(m[top, j]), -1, p) % p
            m[top + 1:] = (m[top + 1:] - m[top + 1:, j:j + 1] * m[top] % p) % p
            found.append(j)
            top += 1
        best = max(best, found, key=len)
    return np.array(best, np.int64)


def solve_rows(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows @ inverse(factor)`` for an upper triangular factor, column by column."""
    out = np.empty_like(rows, order="F")
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def shifted_factor(gram: np.ndarray) -> np.ndarray:
    """Upper Cholesky factor; a nearly dependent Gram matrix gets a shift of its rounding error's size."""
    d = len(gram)
    shift = 0.0 if np.abs(gram - np.eye(d)).max() < 0.5 / d else 11 * d * (d + 1) * np.finfo(float).eps * np.trace(gram)
    for _ in range(8):
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(shift * 16, np.finfo(float).eps * np.trace(gram))
    raise ValueError("the Gram matrix is not positive")


@dataclass
class Whitening:
    """Mean (of ``floor(64 * c)``), components as columns, eigenvalues and the passes that it took."""
    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float
    passes: int

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centred(self, y: np.ndarray) -> np.ndarray:
        return _centred(y, self.n, self.sums)

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened values of integer rows; not a number for eigenvalue 0."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.eigenvalues > 0, 1 / np.sqrt(self.eigenvalues), np.nan)
        return self.centred(y) @ self.components * scale

    def deviations(self, y: np.ndarray) -> list[int | None] | np.ndarray:
        """Sum over dimensions of ``(n * x - S) ** 2``, exact; None beyond a long."""
        high = max((abs(s) for s in self.sums), default=0) + self.n * int(np.abs(y).max(initial=0))
        if self.dim * high * high < 1 << 63:
            return ((self.n * y.astype(np.int64) - np.array(self.sums, np.int64)) ** 2).sum(axis=1)
        exact = ((y.astype(np.int64).astype(object) * self.n - np.array(self.sums, object)) ** 2).sum(axis=1)
        return [v if v < 1 << 63 else None for v in exact.tolist()]


def _centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Rows minus the mean; the integer part of the mean goes first, exactly."""
    whole = np.array([s // n for s in sums], np.float64)
    rest = np.array([(s % n) / n for s in sums], np.float64)
    return (y - whole) - rest


def fit(df: DataFrame, vector: str = "embedding", components: int = 32) -> Whitening | None:
    """Mean, components and eigenvalues of all usable vectors; None without any."""
    rows = df.filter(usable(F.col(f"`{vector}`")))
    sums = sum_matrices(rows, vector, exact_gram, _pack_exact, _add_exact)
    tables = {d - 1: np.array([[int.from_bytes(r[i:i + WIDE], "little", signed=True) for i in range(0, len(r), WIDE)]
                               for r in m], object) for d, m in ((len(m), m) for m in sums.values())}
    if not tables:
        return None
    dim = max(tables, key=lambda d: (tables[d][0, 0], d))
    table = tables[dim]
    n, total = table[0, 0], table[0, 1:]
    exact = n * table[1:, 1:] - np.outer(total, total)  # n times the centred Gram matrix
    total = total.tolist()
    gram = np.array([[v / n for v in row] for row in exact.tolist()], np.float64).reshape(dim, dim)
    trace = sum(exact[i, i] for i in range(dim)) / (n * n)
    main = independent(exact) if dim else np.zeros(0, np.int64)
    rest = np.setdiff1d(np.arange(dim), main)
    kept = min(components, dim)
    values, vectors, passes = np.zeros(kept), np.zeros((dim, kept)), 1
    if len(main):
        factors, cross, now = [shifted_factor(gram[np.ix_(main, main)])], None, None
        while passes < MAX_PASSES:
            now, cross = _pass(rows, vector, n, total, main, rest, factors)
            passes += 1
            factors.append(shifted_factor(now))
            if np.abs(now - np.eye(len(main))).max() < SETTLED:
                break
        else:
            raise RuntimeError(f"rows were not orthonormal after {MAX_PASSES} passes")
        r = np.eye(len(main))
        for f in factors:
            r = f @ r
        full = np.zeros((len(main), dim))
        full[:, main] = r
        full[:, rest] = np.linalg.solve(factors[-1].T, cross)
        _, sizes, right = np.linalg.svd(full, full_matrices=False)
        top = min(kept, len(main))
        values[:top] = sizes[:top] ** 2 / n
        sign = np.sign(right[np.arange(top), np.abs(right[:top]).argmax(axis=1)])
        vectors[:, :top] = (right[:top] * sign[:, None]).T
    with np.errstate(divide="ignore", invalid="ignore"):
        explained = values / trace if trace else np.full(kept, np.nan)
    out = Whitening(n, total, vectors, values, explained, 0.0, passes)
    out.identity_error = _identity_error(rows, vector, out)
    return out


def _pass(rows: DataFrame, vector: str, n: int, total: list[int], main: np.ndarray, rest: np.ndarray,
          factors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrix of the rows after all solves, and their products with the dependent dimensions."""
    dim = len(main) + len(rest)

    def part(y: np.ndarray) -> np.ndarray:
        if y.shape[1] != dim:
            return np.zeros((0, 0))
        a = _centred(y, n, total)
        q = a[:, main]
        for f in factors:
            q = solve_rows(q, f)
        return q.T @ np.hstack([q, a[:, rest]])

    got = sum_matrices(rows, vector, part, lambda r: r.tobytes(), _add_doubles)[dim]
    m = np.array([np.frombuffer(r) for r in got])
    return m[:, :len(main)], m[:, len(main):]


def _identity_error(rows: DataFrame, vector: str, w: Whitening) -> float:
    """Largest difference of the whitened rows' covariance from the identity, by one more pass."""
    live = w.eigenvalues > 0
    if not live.any():
        return 0.0

    def part(y: np.ndarray) -> np.ndarray:
        if y.shape[1] != w.dim:
            return np.zeros((0, 0))
        q = np.hstack([np.ones((len(y), 1)), w.project(y)[:, live]])
        return q.T @ q

    m = np.array([np.frombuffer(r) for r in sum_matrices(rows, vector, part, lambda r: r.tobytes(), _add_doubles)[w.dim]])
    mean = m[0, 1:] / w.n
    return float(np.abs(m[1:, 1:] / w.n - np.outer(mean, mean) - np.eye(int(live.sum()))).max())


# -- the operator ------------------------------------------------------------

@sheltered(tuple(OUT))
def apply(df: DataFrame, w: Whitening | None, vector: str = "embedding") -> DataFrame:
    """One row for each usable vector and component, with the other columns of ``df``."""
    keep = [c for c in df.columns if c != vector and c not in OUT]
    src = df.filter(usable(F.col(f"`{vector}`"))).select(
        *[F.col(f"`{c}`") for c in keep], F.col(f"`{vector}`").cast("array<double>").alias("__vector"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
                       + ["component int, n bigint, deviation bigint, whitened double, explained double, "
                          "identity_error double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if w is None:
            return
        k = len(w.eigenvalues)
        for batch in batches:
            for rows, y in matrices(batch.column(batch.num_columns - 1)):
                if y.shape[1] != w.dim or k == 0 or len(rows) == 0:
                    continue
                m = len(rows)
                own = batch.take(pa.array(np.repeat(rows, k))).columns[:-1]
                deviation = pa.array(w.deviations(y), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays(own + [
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n, np.int64)), deviation,
                    pa.array(w.project(y).ravel(), from_pandas=True),
                    pa.array(np.tile(w.explained, m), from_pandas=True),
                    pa.array(np.full(m * k, w.identity_error))], names=keep + OUT)
    return map_arrow(src, run, schema)


def whiten(df: DataFrame, vector: str = "embedding", components: int = 32) -> DataFrame:
    """Whitened components of every usable vector of ``df``, fitted on all of them."""
    return apply(df, fit(df, vector, components), vector)
