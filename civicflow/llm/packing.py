"""Best-fit packing by minimum bin slack.

Only the histogram of piece lengths matters for the plan, and it has at most
``capacity`` entries.  For each bin, the longest remaining length is placed and
a subset-sum over the remaining lengths (one bit per reachable fill, shifted
and or-ed, with the available counts) finds the fullest feasible combination;
it is removed as many times as the counts allow.  Pieces are then numbered
within their length, and each number falls in one slot of the plan.

Defined cases: a null or empty text has only its end token; repeated rows are
packed each; an empty table gives no pieces; nothing is dropped or padded.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator, Mapping
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, sheltered, text_chunks, write_out
from .pieces import PieceCache, gather

CAPACITY = 1024
END_ID = 2
OUT = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


# -- plan --------------------------------------------------------------------

def fullest(counts: Mapping[int, int], room: int) -> dict[int, int]:
    """Lengths and how often, with the largest sum not above ``room``.

    Longer lengths come first, and a shorter one is used only where the sum
    cannot be reached without it.
    """
    limit = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room and counts[x] > 0), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left > 0 and not reach >> room:
            take = min(part, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & limit
            left -= take
            part *= 2
        if reach >> room:
            break
    target, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> target & 1:
            used[length] = used.get(length, 0) + take
            target -= length * take
    return used


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Bins as (how many, lengths and how often in each); uses every piece."""
    left = {k: v for k, v in counts.items() if v > 0}
    out = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        combo = fullest(rest, capacity - longest)
        combo[longest] = combo.get(longest, 0) + 1
        times = min(left[x] // k for x, k in combo.items())
        out.append((times, combo))
        for x, k in combo.items():
            left[x] -= k * times
            if not left[x]:
                del left[x]
    return out


_KEY = 1 << 44  # above any number of pieces of one length


def slots(bins: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """Slot table: pieces ``first .. first + times * k`` of a length fill its k places in ``times`` bins."""
    seen: dict[int, int] = {}
    rows, sequence = [], 0
    for times, combo in bins:
        offset = 0
        for length in sorted(combo, reverse=True):
            k = combo[length]
            first = seen.get(length, 0)
            rows.append((length * _KEY + first, times, sequence, offset, length))
            seen[length] = first + k * times
            offset += k * length
        sequence += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("key", "times", "sequence", "offset", "length"), cols))


# -- pieces ------------------------------------------------------------------

_TOKENIZERS: dict[str, tuple] = {}
_LINE = 128  # pieces encoded as one text


class LineEncoder:
    """Ids of many pieces by few calls of the tokenizer.

    Pieces are joined to lines that the pattern cuts into the same pieces: one
    that begins with a space as it is, another after a line feed, white space
    alone.  The bytes of the tokens tell where a piece ends; where they do not
    meet the pieces' ends, each piece is encoded by itself.
    """

    def __init__(self, tok):
        self.tok = tok
        self.size = np.zeros(max(tok.get_vocab(with_added_tokens=True).values()) + 1, np.int64)
        for token, i in tok.get_vocab(with_added_tokens=False).items():
            self.size[i] = len(token)
        self.size[list(tok.get_added_tokens_decoder())] = 0
        self.feed = (tok.encode("\n", add_special_tokens=False).ids or [-1])[0]

    def __call__(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the number of each piece's."""
        texts = [p.decode("utf-8") for p in pieces]
        blank = np.fromiter(map(str.isspace, texts), bool, len(texts))
        flat, begins, sizes = self._lines([t for t, b in zip(texts, blank) if not b])
        alone, own_begins, own_sizes = self._each([t for t, b in zip(texts, blank) if b])
        order = np.empty(len(texts), np.int64)
        order[np.concatenate([np.flatnonzero(~blank), np.flatnonzero(blank)])] = np.arange(len(texts))
        sizes = np.concatenate([sizes, own_sizes])
        return gather(np.concatenate([flat, alone]), np.concatenate([begins, len(flat) + own_begins]),
                      sizes, order)[0], sizes[order]

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids; where each text's begin, and how many they are."""
        found = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum()), np.cumsum(sizes) - sizes, sizes

    def _lines(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not texts:
            return self._each(texts)
        parts = [t if t[0] == " " else "\n" + t for t in texts]
        flat = self._each(["".join(parts[i:i + _LINE]) for i in range(0, len(parts), _LINE)])[0]
        led = np.fromiter((p[0] == "\n" for p in parts), np.int64, len(parts))
        stop = np.cumsum(np.fromiter((len(p.encode()) for p in parts), np.int64, len(parts)))
        done = np.cumsum(self.size[flat])
        if done[-1] != stop[-1]:
            return self._each(texts)
        ends = np.searchsorted(done, stop)
        begins = np.append(0, ends[:-1] + 1) + led
        if (done[ends] != stop).any() or (flat[begins[led > 0] - 1] != self.feed).any():
            return self._each(texts)
        return flat, begins, ends + 1 - begins


def _tokenizer(path: str):
    """The tokenizer and a cache of pieces, built once in each worker."""
    if path not in _TOKENIZERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        special = [t.content.encode() for t in tok.get_added_tokens_decoder().values()]
        _TOKENIZERS[path] = (tok, PieceCache(LineEncoder(tok)), special)
    return _TOKENIZERS[path]


def _row_ids(path: str, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Ids of each row; rows that hold an added token's string go through the tokenizer whole."""
    tok, cache, special = _tokenizer(path)
    ids, bounds = cache.ids(data, offsets)
    out = [ids[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:])]
    raw = data.tobytes()
    if any(s in raw for s in special):
        for i, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:])):
            if any(s in raw[lo:hi] for s in special):
                out[i] = np.array(tok.encode(raw[lo:hi].decode("utf-8"), add_special_tokens=False).ids, np.int64)
    return out


def token_pieces(df: DataFrame, vocabulary: str, text: str = "text", capacity: int = CAPACITY,
                 end_id: int = END_ID) -> DataFrame:
    """Pieces of every row: its other columns, then piece, start, length, ids_crc32.

    ``__task`` and ``__nth`` number the pieces of each length within the task
    that made them.  No shuffle.
    """
    made = OUT[:4] + ["__task", "__nth"]
    keep = [c for c in df.columns if c != text and c not in OUT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for part, data, offsets in text_chunks(batches, "__text"):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(_row_ids(vocabulary, data, offsets)):
                raw = np.append(ids, end_id).astype("<u4")
                first = len(raw) % capacity or capacity
                cuts = [0, *range(first, len(raw) + 1, capacity)]
                for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
                    row.append(i)
                    piece.append(k)
                    start.append(lo)
                    length.append(hi - lo)
                    crc.append(zlib.crc32(raw[lo:hi]))
            size = np.array(length, np.int64)
            order = np.argsort(size, kind="stable")
            nth = np.empty(len(size), np.int64)
            kinds, begin, many = np.unique(size[order], return_index=True, return_counts=True)
            nth[order] = np.arange(len(size)) - np.repeat(begin, many) + seen[size[order]]
            seen[kinds] += many
            took = part.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                took.columns[:-1] + [pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                                     pa.array(np.full(len(size), task), pa.int32()), pa.array(nth)],
                names=keep + made)

    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
                       + ["piece int, start bigint, length bigint, ids_crc32 bigint, __task int, __nth bigint"])
    return map_arrow(src, run, schema)


@sheltered(tuple(OUT))
def pack(df: DataFrame, vocabulary: str, text: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, planner: Callable = plan) -> DataFrame:
    """Every piece with its sequence and its offset there.

    Pieces (numbers only) are written once, which fixes their numbering.  The
    driver sees the histogram of lengths alone (at most ``capacity`` rows).
    A length that a third of all pieces share is numbered by task, never in
    one group.
    """
    pieces = write_out(token_pieces(df, vocabulary, text, capacity, end_id), "pieces")
    by_task = pieces.groupBy("__task", "length").count()
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    table = slots(planner(histogram, capacity))
    w = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("__task", "length", F.coalesce(F.sum("count").over(w), F.lit(0)).alias("__before"))
    numbered = pieces.join(before, ["__task", "length"]).withColumn("__rank", F.col("__before") + F.col("__nth"))
    keep = [c for c in pieces.columns if c not in OUT and not c.startswith("__")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                            for c in ("length", "__rank"))
            at = np.searchsorted(table["key"], length * _KEY + rank, side="right") - 1
            nth = length * _KEY + rank - table["key"][at]
            times = table["times"][at]
            yield pa.RecordBatch.from_arrays(
                b.columns[:-1] + [pa.array(table["sequence"][at] + nth % times),
                                  pa.array(table["offset"][at] + nth // times * length)],
                names=keep + OUT)

    src = numbered.select(*[F.col(f"`{c}`") for c in keep], *OUT[:4], "__rank")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
                       + ["sequence_id bigint, offset bigint"])
    return map_arrow(src, place, schema)
