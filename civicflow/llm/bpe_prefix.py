"""Byte-level BPE encoding and decoding by prefix dynamic programming.

A token sequence is what the merges give exactly when each neighbouring pair
is: when merging the bytes of the two tokens gives those two tokens.  So each
byte prefix of a piece has one valid last token, the one that may follow the
last token of the prefix before it.  The table of last tokens grows byte by
byte (appends are exact), and after an edit it is filled again only until it
agrees with the old table for as many positions as the longest token.

Defined cases: a null or empty text has no ids (digests of the empty string);
repeated rows are encoded alike; other columns are passed through, and an
input column named like an output is dropped.  Special tokens are never made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, sheltered, text_chunks
from .pieces import PieceCache, gather, read_ranks

OUT = ["n_tokens", "ids_sha256", "decoded_sha256"]


class PrefixBPE:
    """Encoder and decoder for one vocabulary of byte tokens and merge ranks."""

    def __init__(self, ranks: dict[bytes, int], pair_limit: int = 400_000):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pair_limit = pair_limit
        self.whole: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        self.tree = self._tree()

    def merge(self, raw: bytes) -> list[int]:
        """Plain merging, lowest rank first and leftmost: decides short pairs."""
        parts = [raw[i:i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best, i = min(ranked)
            if best == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _tree(self) -> dict:
        """Tokens by their bytes: nested dicts, a node's own token under -1."""
        root: dict = {}
        for raw, token in self.ranks.items():
            node = root
            for b in raw:
                node = node.setdefault(b, {})
            node[-1] = token
        return root

    def _pair(self, before: int, token: int) -> bool:
        """Do the merges of both tokens' bytes give just these two?"""
        if len(self.pairs) >= self.pair_limit:
            self.pairs.clear()
        ok = self.pairs[before << 20 | token] = (
            self.merge(self.tokens[before] + self.tokens[token]) == [before, token])
        return ok

    def _first(self, token: int) -> bool:
        """Do the merges of the token's bytes give it?"""
        ok = self.whole.get(token)
        if ok is None:
            ok = self.whole[token] = self.merge(self.tokens[token]) == [token]
        return ok

    def fill(self, raw: bytes, last: list[int | None], known: int, settled=None) -> int:
        """Fills ``last[known + 1:]``, where ``last[:known + 1]`` is right; returns where it stopped.

        Walks the tokens that begin at each place; what ends at a place is
        settled before tokens that begin there are tried.  ``settled(i)`` may
        end the work after place i.
        """
        n, pairs, tree = len(raw), self.pairs, self.tree
        for j in range(max(0, known - self.longest + 1), n):
            before = last[j]
            if settled is not None and j > known and settled(j):
                return j
            node = tree
            for i in range(j, n):
                node = node.get(raw[i])
                if node is None:
                    break
                token = node.get(-1)
                if token is None or i < known or last[i + 1] is not None:
                    continue
                if before is None:
                    ok = self._first(token)
                else:
                    ok = pairs.get(before << 20 | token)
                    if ok is None:
                        ok = self._pair(before, token)
                if ok:
                    last[i + 1] = token
            if j >= known and last[j + 1] is None:
                raise ValueError("the vocabulary lacks single bytes")
        return n

    def encode_piece(self, raw: bytes) -> tuple[int, ...]:
        """Ids of one piece; a piece that is a token itself is that token."""
        token = self.ranks.get(raw)
        return (token,) if token is not None else tuple(PrefixTable(self, raw).ids())

    def encode_pieces(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        return [self.encode_piece(p) for p in pieces]

    def decode(self, ids) -> bytes:
        return b"".join(self.tokens[i] for i in ids)


class PrefixTable:
    """The growing table of one piece: ``last[i]`` ends the encoding of ``raw[:i]``."""

    def __init__(self, bpe: PrefixBPE, raw: bytes = b""):
        self.bpe, self.raw, self.last = bpe, b"", [None]
        self.append(raw)

    def append(self, more: bytes) -> None:
        """Exact: the rows of shorter prefixes do not change."""
        known = len(self.raw)
        self.raw += more
        self.last += [None] * len(more)
        self.bpe.fill(self.raw, self.last, known)

    def replace(self, lo: int, hi: int, new: bytes) -> int:
        """Replace ``raw[lo:hi]``; returns how many rows were worked out again."""
        old, shift = self.last, len(new) - (hi - lo)
        self.raw = self.raw[:lo] + new + self.raw[hi:]
        self.last = old[:lo + 1] + [None] * (len(self.raw) - lo)
        agree = 0

        def settled(i: int) -> bool:
            nonlocal agree
            if i > lo + len(new):
                agree = agree + 1 if self.last[i] == old[i - shift] else 0
            return agree >= self.bpe.longest

        stop = self.bpe.fill(self.raw, self.last, lo, settled)
        if stop < len(self.raw):
            self.last[stop + 1:] = old[stop + 1 - shift:]
        return stop - lo

    def ids(self) -> list[int]:
        out, i = [], len(self.raw)
        while i:
            out.append(self.last[i])
            i -= len(self.bpe.tokens[self.last[i]])
        return out[::-1]


_READY: dict[str, tuple[PrefixBPE, PieceCache, tuple, tuple]] = {}


def _ragged(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes


def _ready(path: str):
    """Encoder, cache and id tables of a vocabulary, built once in each worker."""
    if path not in _READY:
        bpe = PrefixBPE(read_ranks(path))
        top = max(bpe.tokens) + 1
        _READY[path] = (bpe, PieceCache(bpe.encode_pieces), _ragged([b"%d," % i for i in range(top)]),
                        _ragged([bpe.tokens.get(i, b"") for i in range(top)]))
    return _READY[path]


@sheltered(lambda a: OUT + ["ids"] * a["with_ids"])
def encode(df: DataFrame, vocabulary: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """``df`` without its texts, plus token count and digests of ids and decoded bytes.

    The decoded digest is taken from bytes rebuilt out of the ids.
    ``with_ids`` adds the ids themselves (``ids array<int>``).  No shuffle.
    """
    names = OUT + ["ids"] * with_ids
    keep = [c for c in df.columns if c != text and c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, cache, decimal, raw = _ready(vocabulary)
        for part, data, offsets in text_chunks(batches, "__text"):
            ids, bounds = cache.ids(data, offsets)
            listed, list_at = gather(*decimal, ids)
            decoded, decoded_at = gather(*raw, ids)
            sha = [[], []]
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                a, b = list_at[lo], max(list_at[lo], list_at[hi] - 1)  # without the last comma
                sha[0].append(hashlib.sha256(listed[a:b]).hexdigest())
                sha[1].append(hashlib.sha256(decoded[decoded_at[lo]:decoded_at[hi]]).hexdigest())
            out = part.columns[:-1] + [pa.array(np.diff(bounds), pa.int64()), pa.array(sha[0]), pa.array(sha[1])]
            if with_ids:
                out.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(out, names=keep + names)

    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
                       + ["n_tokens bigint, ids_sha256 string, decoded_sha256 string"]
                       + ["ids array<int>"] * with_ids)
    return map_arrow(src, run, schema)
