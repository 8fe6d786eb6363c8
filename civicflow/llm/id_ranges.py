"""Ranges of integer ids cut where the data is, in DataFrame functions only.

A few thousand cells cover all ids; one with too many rows is cut again between
its own smallest and largest id until every cell has few rows or one id.  Only
counts come to the driver, and their number does not grow with the data.  A
cell is cut into equal parts of about ``rows`` rows.  The same rows give the same
ranges under any partitioning, and any 64-bit ids will do.

Parts of rows without an id go by the hash of a second column and come first.
Rows with one id are never cut apart.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS, SPLIT = 1024, 64


def let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def numbers(values: list, kind: str) -> Column:
    """An array literal of any length (folded into one constant by the optimizer)."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def _cell(key: Column, bounds: list[int]) -> Column:
    """Number of the last bound at or below the key, by binary search."""
    table = numbers(bounds, "bigint")
    steps = [1 << k for k in reversed(range(max(1, len(bounds).bit_length())))]
    return F.aggregate(numbers(steps, "int"), F.lit(0),
                       lambda at, step: F.when(F.get(table, at + step) <= key, at + step).otherwise(at))


@dataclass
class IdRanges:
    """Cells (smallest and largest id, rows) in order, and the rows without an id."""
    rows: int
    nulls: int
    cells: list[tuple[int, int, int]]
    parts: list[int] = field(init=False)
    base: list[int] = field(init=False)
    null_parts: int = field(init=False)

    def __post_init__(self):
        self.null_parts = -(-self.nulls // self.rows)
        self.parts = [max(1, -(-n // self.rows)) if lo < hi else 1 for lo, hi, n in self.cells]
        self.base, at = [], self.null_parts
        for p in self.parts:
            self.base.append(at)
            at += p

    def cell(self, key: Column) -> Column:
        """Cell of a key, from 0."""
        return _cell(key, [c[0] for c in self.cells] or [0])

    def number(self, key: Column, tie: Column) -> Column:
        """Range of a row: numbers grow with the id, from 0; rows without an id have the first ones."""
        free = max(1, min(CELLS, self.null_parts))
        each = max(1, -(-self.null_parts // free))
        h = F.xxhash64(tie)
        none = F.pmod(h, F.lit(free)) * each + F.pmod(F.shiftright(h, 20), F.lit(each))
        if not self.cells:
            return F.coalesce(none, F.lit(0)).cast("bigint")
        lo = numbers([float(c[0]) for c in self.cells], "double")
        scale = numbers([p / (float(hi) - float(lo_) + 1.0) for (lo_, hi, _), p in zip(self.cells, self.parts)], "double")
        last = numbers([p - 1 for p in self.parts], "bigint")
        base = numbers(self.base, "bigint")

        def own(c: Column) -> Column:
            part = F.floor((key.cast("double") - F.get(lo, c)) * F.get(scale, c))
            return F.get(base, c) + F.greatest(F.lit(0), F.least(part, F.get(last, c)))
        return F.when(key.isNull(), none).otherwise(let(_cell(key, [c[0] for c in self.cells]), own)).cast("bigint")


def id_ranges(df: DataFrame, key: Column, rows: int, cells: int = CELLS) -> IdRanges:
    """Ranges of about ``rows`` rows over the ids of ``df``: a scan of the ids, or a few where they lie unevenly."""
    ids = df.select(key.cast("bigint").alias("id"))
    low, high, n, every = ids.agg(F.min("id"), F.max("id"), F.count("id"), F.count(F.lit(1))).first()
    if not n:
        return IdRanges(rows, every, [])
    limit = max(rows, -(-2 * n // cells))
    bounds = sorted({low + (high - low + 1) * k // cells for k in range(cells)})
    while True:
        found = ids.filter("id IS NOT NULL").groupBy(_cell(F.col("id"), bounds).alias("c")).agg(
            F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("id").alias("n")).collect()
        counted = _merged(sorted((r.lo, r.hi, r.n) for r in found), limit)
        dense = [(lo, hi) for lo, hi, m in counted if m > limit and lo < hi]
        if not dense:
            return IdRanges(rows, every - n, counted)
        bounds = [c[0] for c in counted]
        for lo, hi in dense:
            cut = sorted({lo + (hi - lo + 1) * k // SPLIT for k in range(1, SPLIT)} - {lo})
            at = bisect_left(bounds, lo)
            bounds[at + 1:at + 1] = cut


def _merged(cells: list[tuple[int, int, int]], limit: int) -> list[tuple[int, int, int]]:
    """Neighbouring cells together while they have at most ``limit`` rows."""
    out: list[tuple[int, int, int]] = []
    for lo, hi, n in cells:
        if out and out[-1][2] + n <= limit:
            out[-1] = (out[-1][0], hi, out[-1][2] + n)
        else:
            out.append((lo, hi, n))
    return out
