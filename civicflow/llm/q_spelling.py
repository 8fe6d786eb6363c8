"""Query op12: spelling variants among the words of ``documents``.

The query's input rule deletes a letter of some runs, chosen by a checksum of
document and run, so that variants exist.  DuckDB has no crc32, so there is no
oracle statement; tests compare with a brute-force version.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import table, utf8
from .registry import register
from .spelling import OUT, count_words, group_variants

EVERY = 199


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1).astype(np.uint32)
    return out


CRC = _crc_table()


def crc32_runs(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Checksum states after the bytes of each span, one byte of all spans at a time."""
    state, live, at = state.copy(), np.flatnonzero(ends > starts), 0
    while len(live):
        s = state[live]
        state[live] = CRC[(s ^ data[starts[live] + at]) & 0xFF] ^ (s >> np.uint32(8))
        at += 1
        live = live[starts[live] + at < ends[live]]
    return state


def drop_letters(keys: pa.Array, row: np.ndarray, data: np.ndarray, starts: np.ndarray,
                 ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Runs whose checksum 199 divides, without one code point (a null doc_id is the empty text)."""
    head, offsets = utf8(keys)
    first = crc32_runs(np.full(len(keys), 0xFFFFFFFF, np.uint32), head, offsets[:-1], offsets[1:])
    first = CRC[(first ^ ord(":")) & 0xFF] ^ (first >> np.uint32(8))
    h = ~crc32_runs(first[row], data, starts, ends)
    at = np.flatnonzero(h % EVERY == 0)
    out = []
    for a, b, v in zip(starts[at].tolist(), ends[at].tolist(), h[at].tolist()):
        word = data[a:b].tobytes().decode()
        gone = v % len(word)
        out.append((word[:gone] + word[gone + 1:]).encode())
    return at, out


@register("op12_spelling")
def op12_spelling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return group_variants(count_words(docs, key="doc_id", edit=drop_letters)).select("word", *OUT)
