"""Vectorised splitting of text into the pieces of a byte-level BPE, and cached encoding.

The split follows the public pattern of these vocabularies
(``public_tokenizers.PATTERN``): contractions, runs of letters, of numbers and
of other signs, each with one leading space, and runs of white space.  Here it
is worked out on arrays of code-point classes, a chunk of texts at a time.
"""

from __future__ import annotations

import base64
import unicodedata
from itertools import chain

import numpy as np

from .common import span_hashes

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# The code points of Unicode's White_Space property, as ranges.
WHITE_SPACE = [(0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
               (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
# The pattern's contractions.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")
_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of every code point, built once in each worker."""
    if not _CLASSES:
        kind = {"L": LETTER, "N": NUMBER}
        out = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
        for lo, hi in WHITE_SPACE:
            out[lo:hi + 1] = SPACE
        _CLASSES.append(out)
    return _CLASSES[0]


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the pieces of all rows; they cover every byte."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    at = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(cp)
    row_ends = np.searchsorted(at, offsets[1:])
    first = np.zeros(n, bool)
    first[np.searchsorted(at, offsets[:-1])[offsets[:-1] < offsets[1:]]] = True
    kind = classes()[cp]
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # The last character of a white-space run goes with what follows if it is a
    # plain space, and stands alone if not.
    after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1:]) + 1
    start[after - 1] = True
    start[after] = cp[after - 1] != 32
    # Contractions, where a piece starts right at the apostrophe.
    quote = np.flatnonzero((cp == 39) & start)
    if len(quote):
        end = row_ends[np.searchsorted(row_ends, quote, side="right")]
        ext = np.concatenate([cp, np.zeros(2, cp.dtype)])
        c1 = np.where(quote + 1 < end, ext[quote + 1], 0)
        c2 = np.where(quote + 2 < end, ext[np.minimum(quote + 2, n)], 0)
        size = np.zeros(len(quote), np.int64)
        for c in ONE_LETTER:
            size[c1 == ord(c)] = 1
        for a, b in TWO_LETTERS:
            size[(c1 == ord(a)) & (c2 == ord(b))] = 2
        hit = size > 0
        quote, size, end = quote[hit], size[hit], end[hit]
        start[quote + 1] = False
        stop = quote + 1 + size
        inner = stop[stop < end]
        start[inner[kind[inner] == LETTER]] = True
    starts = at[start]
    return starts, np.append(starts[1:], len(data))


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of ``flat[starts[i]:starts[i] + sizes[i]]`` for i in index, and the n + 1 bounds."""
    took = sizes[index]
    bounds = np.concatenate([[0], np.cumsum(took)])
    shift = np.repeat(starts[index] - bounds[:-1], took)
    return flat[shift + np.arange(bounds[-1])], bounds


def _append(buffer: np.ndarray, filled: int, more: np.ndarray) -> np.ndarray:
    """``buffer`` with ``more`` after its first ``filled`` items; doubled where it is full."""
    if filled + len(more) > len(buffer):
        buffer = np.concatenate([buffer[:filled], np.zeros(max(filled, len(more)), buffer.dtype)])
    buffer[filled:filled + len(more)] = more
    return buffer


class PieceCache:
    """Ids of pieces, encoded once each; at most ``limit`` pieces and ``8 * limit`` ids are kept.

    ``encode`` maps a list of piece bytes to their ids, a sequence each, or to
    all ids and the number of each piece's (two arrays).  Kept are 24 bytes a
    piece and four an id: the sorted hashes, each with its slot, and by slot
    the bounds in the ids and the last chunk that had the piece.  Of a full
    cache the half used last stays, which costs time only.
    """

    def __init__(self, encode, limit: int = 1_000_000):
        self.encode, self.limit, self.chunk = encode, limit, 0
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.bounds, self.used, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows (int64, concatenated) and the n + 1 row bounds."""
        starts, ends = split(data, offsets)
        keys, where, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if new.any():
            raw = data.tobytes()
            first = where[new]
            self._add(keys[new], at[new], [raw[lo:hi] for lo, hi in zip(starts[first].tolist(), ends[first].tolist())])
            at += np.cumsum(new) - new
        slot = self.slot[at]
        self.chunk += 1
        self.used[slot] = self.chunk
        begins = self.bounds[slot]
        ids, bounds = gather(self.flat, begins, self.bounds[slot + 1] - begins, which)
        if len(self.keys) > self.limit or self.bounds[len(self.keys)] > 8 * self.limit:
            self._halve()
        return ids.astype(np.int64), bounds[np.searchsorted(starts, offsets)]

    def _add(self, keys: np.ndarray, at: np.ndarray, pieces: list[bytes]) -> None:
        found = self.encode(pieces)
        if isinstance(found, tuple):
            flat, sizes = found
        else:
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum())
        n = len(self.keys)
        filled = self.bounds[n]
        self.flat = _append(self.flat, filled, flat)
        self.bounds = _append(self.bounds, n + 1, filled + np.cumsum(sizes))
        self.used = _append(self.used, n, np.zeros(len(keys), np.int32))
        self.keys = np.insert(self.keys, at, keys)
        self.slot = np.insert(self.slot, at, np.arange(n, n + len(keys), dtype=np.int32))

    def _halve(self) -> None:
        n = len(self.keys)
        sizes = np.diff(self.bounds[:n + 1])
        recent = np.argsort(-self.used[:n], kind="stable")
        fit = np.searchsorted(np.cumsum(sizes[recent]), 4 * self.limit, side="right")
        stay = np.sort(recent[:min(fit, self.limit // 2)])
        self.flat, self.bounds = gather(self.flat, self.bounds[:n], sizes, stay)
        self.used = self.used[stay]
        moved = np.full(n, -1, np.int32)
        moved[stay] = np.arange(len(stay))
        slot = moved[self.slot]
        self.keys, self.slot = self.keys[slot >= 0], slot[slot >= 0]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
