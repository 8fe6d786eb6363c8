"""Variance trees grown level by level on weighted cells, as a saved Spark ML node table.

The rules are Spark ML's: the split of largest variance gain, of equal ones the
first feature and threshold; thresholds are midpoints between values that the
tree's own cells have; a child keeps the leaf minimum.  Gains that differ by
less than rounding count as equal, so trees repeat.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

ROUNDING = 1e-12  # of a node's sum of squares

_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
_NODE = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT)])
NODE_TYPE = pa.field("nodeData", _NODE)
NODE_DDL = ("nodeData struct<id:int, prediction:double, impurity:double, impurityStats:array<double>, rawCount:bigint, "
            "gain:double, leftChild:int, rightChild:int, "
            "split:struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, numCategories:int>>")


@dataclass(frozen=True)
class Bins:
    """Bins of each feature: ``edges`` has their upper ends, ``low`` and ``high`` the least and largest value of each."""
    edges: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]

    @classmethod
    def of(cls, counts: list[list[tuple[float, int]]], max_bins: int) -> Bins:
        """From each feature's (value, rows): a bin a value, or ``max_bins`` at most of about equal rows as Spark ML makes them."""
        edges, low, high = [], [], []
        for pairs in counts:
            values = np.array([v for v, _ in pairs], dtype=np.float64)
            order = np.argsort(values)  # NaN is last
            values, rows = values[order], np.array([n for _, n in pairs], dtype=np.float64)[order]
            if len(values) <= max_bins:
                cut = np.arange(len(values) - 1)
            else:
                cut, target, stride, seen = [], rows.sum() / max_bins, rows.sum() / max_bins, np.cumsum(rows)
                for i in range(len(values) - 1):
                    if abs(seen[i] - target) < abs(seen[i + 1] - target):
                        cut.append(i)
                        target += stride
                cut = np.array(cut, dtype=np.int64)
            edges.append(values[cut])
            low.append(values[np.r_[0, cut + 1]])
            high.append(values[np.r_[cut, len(values) - 1]])
        return cls(edges, low, high)

    @property
    def sizes(self) -> list[int]:
        return [len(v) for v in self.low]

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The cell of each vector: its bins as digits of one number."""
        code = np.zeros(len(x), dtype=np.int64)
        for f, size in enumerate(self.sizes):
            code *= size
            if size > 1:
                code += np.searchsorted(self.edges[f], x[:, f], side="left")
        return code

    def digits(self, codes: np.ndarray) -> np.ndarray:
        """The bins of each cell, one line a feature."""
        out = np.empty((len(self.low), len(codes)), dtype=np.int64)
        for f in range(len(self.low))[::-1]:
            codes, out[f] = np.divmod(codes, self.sizes[f])
        return out

    def threshold(self, f: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Midpoints between values, or the upper border of a bin of several; a missing value is above all others."""
        single = np.array_equal(self.low[f], self.high[f], equal_nan=True)
        a, b = self.high[f][left], self.low[f][right if single else left + 1]
        return np.where(np.isnan(b), a, (a + b) / 2)

    def values(self, digits: np.ndarray) -> np.ndarray:
        """A value of each cell's bins, one line a feature; every threshold has a bin's values on one side."""
        return np.stack([low[d] for low, d in zip(self.low, digits)])


def _best_splits(level, n, s, feats, digits, counts, tol, least):
    """(feature place or -1, bin, its score) of each node of a level: score is sum of squares over count on both sides."""
    num, total, base = counts
    best, feature, at = base.copy(), np.full(len(num), -1), np.zeros(len(num), dtype=np.int64)
    for i, (_, thresholds) in enumerate(feats):
        bins = len(thresholds) + 1
        key = level * bins + digits[i]
        nl = np.cumsum(np.bincount(key, n, len(num) * bins).reshape(-1, bins)[:, :-1], axis=1)
        sl = np.cumsum(np.bincount(key, s, len(num) * bins).reshape(-1, bins)[:, :-1], axis=1)
        nr, sr = num[:, None] - nl, total[:, None] - sl
        score = np.where((nl >= least) & (nr >= least), sl * sl / np.maximum(nl, 1) + sr * sr / np.maximum(nr, 1), -np.inf)
        top = score.max(axis=1)
        better = top > best + tol
        first = (score >= (top - tol)[:, None]).argmax(axis=1)
        best, feature, at = np.where(better, top, best), np.where(better, i, feature), np.where(better, first, at)
    return feature, at, best


def grow(digits: np.ndarray, bins: Bins, n: np.ndarray, s: np.ndarray, q: np.ndarray, max_depth: int, least: float, min_split: float = 0) -> list:
    """The levels of a tree on cells with ``n`` rows, label sum ``s`` and sum of squares ``q``.

    Of each level's nodes: rows, label sum, sum of squares, sum of squares of the
    mean, feature or -1, threshold, gain.  Children of a level's splits are the next, in pairs.
    """
    own = n > 0
    digits, n, s, q = digits[:, own], n[own], s[own], q[own]
    feats, local = [], []
    for f in range(len(digits)):
        present, place = np.unique(digits[f], return_inverse=True)
        if len(present) > 1:
            feats.append((f, bins.threshold(f, present[:-1], present[1:])))
            local.append(place)
    digits = np.array(local, dtype=np.int64).reshape(len(feats), len(n))
    level, size, levels = np.zeros(len(n), dtype=np.int64), 1, []
    while size:
        num, total, square = (np.bincount(level, v, size) for v in (n, s, q))
        base = total * total / num
        feature, threshold, gain = np.full(size, -1), np.zeros(size), np.full(size, -1.0)
        tol = ROUNDING * square
        may = (num >= max(2 * least, min_split)) & (square - base > tol)
        if len(levels) < max_depth and len(feats) and may.any():
            live = may[level]
            level, n, s, q, digits = (np.cumsum(may) - 1)[level[live]], n[live], s[live], q[live], digits[:, live]
            place, at, score = _best_splits(level, n, s, feats, digits, (num[may], total[may], base[may]), tol[may], least)
            split = place >= 0
            which = np.flatnonzero(may)[split]
            feature[which] = np.array([f for f, _ in feats])[place[split]]
            threshold[which] = [feats[i][1][j] for i, j in zip(place[split], at[split])]
            gain[which] = ((score - base[may]) / num[may])[split]
            live = split[level]
            level, n, s, q, digits = level[live], n[live], s[live], q[live], digits[:, live]
            right = digits[place[level], np.arange(len(level))] > at[level]
            level, size = 2 * (np.cumsum(split) - 1)[level] + right, 2 * int(split.sum())
        else:
            size = 0
        levels.append((num, total, square, base, feature, threshold, gain))
    return levels


def predict(levels: list, values: np.ndarray) -> np.ndarray:
    """A tree's prediction for each column of ``values`` (one line a feature)."""
    out, cells, node = np.empty(values.shape[1]), np.arange(values.shape[1]), np.zeros(values.shape[1], dtype=np.int64)
    for num, total, _, _, feature, threshold, _ in levels:
        split = feature >= 0
        end = ~split[node]
        out[cells[end]] = (total / num)[node[end]]
        cells, node = cells[~end], node[~end]
        right = ~(values[feature[node], cells] <= threshold[node])  # as Spark ML: a missing value goes right
        node = 2 * (np.cumsum(split) - 1)[node] + right
    return out


def node_table(levels: list) -> pa.StructArray:
    """The nodes of a tree's levels as Spark ML saves them; numbers are places in preorder."""
    below, sizes = np.zeros(0, dtype=np.int64), []
    for lv in levels[::-1]:
        own = np.ones(len(lv[0]), dtype=np.int64)
        own[lv[4] >= 0] += below[0::2] + below[1::2]
        sizes.insert(0, below := own)
    ids, lefts, rights, number = [], [], [], np.zeros(1, dtype=np.int64)
    for lv, next_sizes in zip(levels, [*sizes[1:], np.zeros(0, dtype=np.int64)]):
        split = lv[4] >= 0
        left, right = np.full(len(number), -1), np.full(len(number), -1)
        left[split] = number[split] + 1
        right[split] = left[split] + next_sizes[0::2]
        ids.append(number)
        lefts.append(left)
        rights.append(right)
        number = np.stack([left[split], right[split]], axis=1).ravel()
    num, total, square, base, feature, threshold, gain = (np.concatenate(v) for v in zip(*levels))
    ids, lefts, rights = (np.concatenate(v) for v in (ids, lefts, rights))
    order = np.argsort(ids)
    num, total, square, base, feature, threshold, gain, ids, lefts, rights = (
        v[order] for v in (num, total, square, base, feature, threshold, gain, ids, lefts, rights))
    inner = feature >= 0
    stats = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * 3), pa.array(np.stack([num, total, square], axis=1).ravel()))
    cuts = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(inner)].astype(np.int32)), pa.array(threshold[inner]))
    minus = pa.array(np.full(len(ids), -1, dtype=np.int32))
    split = pa.StructArray.from_arrays([pa.array(feature.astype(np.int32)), cuts, minus], fields=list(_SPLIT))
    return pa.StructArray.from_arrays([
        pa.array(ids.astype(np.int32)), pa.array(total / num), pa.array(np.maximum(square - base, 0) / num), stats,
        pa.array(np.rint(num).astype(np.int64)), pa.array(gain), pa.array(lefts.astype(np.int32)), pa.array(rights.astype(np.int32)), split],
        fields=list(_NODE))
