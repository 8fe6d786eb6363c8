"""Exact substring dedup by fixed-block anchors.

A repeated run of ``2 * block`` words or more holds a whole non-overlapping
block of each document it stands in, wherever the blocks fall.  So:

1. Every document's aligned blocks are the index, and every rolling window of
   ``block`` words probes it.  A block is an anchor if its words also stand
   elsewhere, at any alignment.
2. Around its anchors each document's windows of ``2 * block`` words are
   looked up: a window whose words start earlier in the corpus (smaller
   doc_id, or same document, earlier start) is a repeat.  Neighbouring repeats
   join to maximal exact repeats, whose words are removed.

Both look-ups meet in buckets of a hash.  A task sends one entry for each
different hash it holds (sorted, as differences, compressed), so a passage
that a third of all documents share costs one entry a task.  Step 1 compares
shortened hashes; a chance agreement only makes a window that step 2 compares
by 64 bits.

A document is a doc_id with a text, known by both and a 64-bit hash of them.

Defined cases: a null text has no words; a null doc_id sorts first; rows with
equal doc_id and text count as one document and get equal results; different
texts under one doc_id (or under null) are different documents, ordered by
their hashes; an empty table gives an empty result; other columns than doc_id
and text are not read.  Ids are integers.  Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, map_arrow, mix, span_hashes, text_chunks, window_hashes, words
from .graph import map_groups

BLOCK = 10
FIRST_ID = -(1 << 63)  # stands for a null doc_id in the order of documents
TASK_WORDS = 4_000_000
BUCKET_WORDS = 2_000_000


# -- packed arrays -----------------------------------------------------------

def pack_arrays(arrays: list[np.ndarray]) -> bytes:
    """Arrays of equal or different lengths as one compressed value (bytes of equal weight together)."""
    head = np.array([len(arrays)] + [x for a in arrays for x in (len(a), a.dtype.itemsize)], "<i8").tobytes()
    body = b"".join(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes() for a in arrays)
    return np.int64(len(body)).tobytes() + head + pa.compress(body, codec="zstd", asbytes=True)


def unpack_arrays(raw: bytes) -> list[np.ndarray]:
    size, count = np.frombuffer(raw, "<i8", 2)
    head = np.frombuffer(raw, "<i8", 2 * count, offset=16).reshape(-1, 2)
    body = pa.decompress(raw[16 + 16 * count:], decompressed_size=int(size), codec="zstd", asbytes=True)
    out, at = [], 0
    for n, width in head.tolist():
        part = np.frombuffer(body, np.uint8, n * width, offset=at).reshape(width, n)
        out.append(np.ascontiguousarray(part.T).view(f"<u{width}").reshape(n))
        at += n * width
    return out


def _differences(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=U64(0))


def _smallest(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in as few bytes as their maximum needs."""
    top = int(values.max()) if len(values) else 0
    return values.astype(next(t for t, lim in (("<u1", 1 << 8), ("<u2", 1 << 16), ("<u4", 1 << 32), ("<u8", 1 << 64)) if top < lim))


# -- words of a chunk --------------------------------------------------------

class Words:
    """Word hashes of a chunk of documents and where each document's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends, self.row = words(data, offsets)
        self.hash = span_hashes(data, self.starts, self.ends)
        self.bounds = np.searchsorted(self.row, np.arange(len(offsets)))
        self.place = np.arange(len(self.row)) - self.bounds[:-1][self.row]  # of a word in its document
        self.count = np.diff(self.bounds)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of each window of k words."""
        h = window_hashes(self.hash, k)
        at = np.flatnonzero(self.place[:len(h)] + k <= self.count[self.row[:len(h)]])
        return h[at], at


# -- step 1: anchors ---------------------------------------------------------

def _probe(block: int, buckets: int, bits: int):
    """Sends each bucket the task's different window values and the blocks that ask about theirs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            value = np.concatenate([h[0] for h in held])
            kinds, many = np.unique(value, return_counts=True)
            asks, node, number = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
            alone = many[np.searchsorted(kinds, asks)] == 1
            rows: list[tuple[int, bytes]] = []
            if not alone.all():  # known to stand twice already: passed on
                rows.append((int(kinds[0] % U64(buckets)), pack_arrays([
                    np.zeros(0, U64), np.zeros(0, "<u1"), np.zeros(0, U64), node[~alone].view(U64), number[~alone]])))
            asks, node, number = asks[alone], node[alone], number[alone]
            cut = np.searchsorted(kinds * U64(buckets) >> U64(bits), np.arange(buckets + 1, dtype=U64))
            order = np.argsort(asks)
            asks, node, number = asks[order], node[order], number[order]
            ask_cut = np.searchsorted(asks * U64(buckets) >> U64(bits), np.arange(buckets + 1, dtype=U64))
            for b in range(buckets):
                lo, hi = cut[b], cut[b + 1]
                if lo == hi:
                    continue
                x, y = ask_cut[b], ask_cut[b + 1]
                rows.append((b, pack_arrays([
                    _smallest(_differences(kinds[lo:hi])), np.packbits(many[lo:hi] > 1),
                    _smallest(np.searchsorted(kinds[lo:hi], asks[x:y])), node[x:y].view(U64), _smallest(number[x:y])])))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                               pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "blob"])

        for part, data, offsets in text_chunks(batches, "__text"):
            w = Words(data, offsets)
            h, at = w.windows(block)
            value = h >> U64(64 - bits)
            own = w.place[at] % block == 0
            nodes = part.column(0).to_numpy(zero_copy_only=False)
            held.append((value, value[own], nodes[w.row[at[own]]], (w.place[at[own]] // block).astype("<u4")))
            size += len(value)
            if size >= TASK_WORDS:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()
    return run


def _anchors(cols) -> list[np.ndarray] | None:
    """Answers one bucket: the asking blocks whose value stands at least twice."""
    values, weights, asked, nodes, numbers, known = [], [], [], [], [], []
    for raw in cols["blob"]:
        diff, twice, ask, node, number = unpack_arrays(raw)
        if len(diff) == 0:
            known.append((node.view(np.int64), number.astype(np.int64)))
            continue
        value = np.cumsum(diff, dtype=U64)
        values.append(value)
        weights.append(1 + np.unpackbits(twice, count=len(value)))
        asked.append(value[ask])
        nodes.append(node.view(np.int64))
        numbers.append(number.astype(np.int64))
    if values:
        value, weight, ask = np.concatenate(values), np.concatenate(weights), np.concatenate(asked)
        del values
        order = np.argsort(value, kind="stable")
        value, total = value[order], np.concatenate([[0], np.cumsum(weight[order], dtype=np.int64)])
        many = total[np.searchsorted(value, ask, side="right")] - total[np.searchsorted(value, ask, side="left")]
        hot = many > 1
        known.append((np.concatenate(nodes)[hot], np.concatenate(numbers)[hot]))
    return [np.concatenate(x) for x in zip(*known)]


# -- step 2: repeats ---------------------------------------------------------

_DOC, _BUCKET, _LOCAL, _ANSWER = 0, 1, 2, 3  # kinds of rows
_ROW = "bucket int, home int, kind int, doc bigint, node bigint, blob binary"
_DOCUMENT = np.dtype([("doc", "<i8"), ("node", "<i8")])  # compares by doc_id, then hash


def _home(node: np.ndarray, homes: int) -> np.ndarray:
    """The group of documents that a document belongs to."""
    return (mix(node.view(U64)) % U64(homes)).astype(np.int64)


def _documents(doc: np.ndarray, node: np.ndarray) -> np.ndarray:
    out = np.empty(len(doc), _DOCUMENT)
    out["doc"], out["node"] = doc, node
    return out


def _late(h: np.ndarray, who: np.ndarray, start: np.ndarray):
    """Sorted copies, marks of the first of each hash, and marks of those that start later than it."""
    order = np.lexsort((start, who["node"], who["doc"], h))
    h, who, start = h[order], who[order], start[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    return h, who, start, new, (who != who[lead]) | (start != start[lead])


def _look_up(block: int, buckets: int):
    """A row for each document, and to each bucket the task's windows around anchors."""
    k = 2 * block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            h, who, start, new, late = _late(*(np.concatenate([x[i] for x in held]) for i in range(3)))
            # Later ones within the task are repeats already.
            rows = [(-1, *x) for x in _sent_home(who[late], start[late], buckets, _LOCAL)]
            h, who, start = h[new], who[new], start[new]
            names, which = np.unique(who, return_inverse=True)
            cut = np.searchsorted((h >> U64(32)) * U64(buckets) >> U64(32), np.arange(buckets + 1, dtype=U64))
            for b in range(buckets):
                lo, hi = cut[b], cut[b + 1]
                if lo < hi:
                    used, short = np.unique(which[lo:hi], return_inverse=True)
                    rows.append((b, -1, _BUCKET, 0, 0, pack_arrays([
                        _differences(h[lo:hi]), *_columns(names[used]), _smallest(short.astype(U64)),
                        _smallest(start[lo:hi].astype(U64))])))
            return _rows(rows)

        for part, data, offsets in text_chunks(batches, "__text"):
            w = Words(data, offsets)
            known = part.column(0).is_valid().to_numpy(zero_copy_only=False).tolist()
            ids = part.column(0).fill_null(FIRST_ID).to_numpy(zero_copy_only=False)
            nodes = part.column(1).to_numpy(zero_copy_only=False)
            who = _documents(ids, nodes)
            homes = _home(nodes, buckets).tolist()
            anchors = part.column(2).to_pylist()
            raw, rows = data.tobytes(), []
            near = np.zeros(len(w.row) + 1, np.int64)
            for i, (doc, node, own) in enumerate(zip(ids.tolist(), nodes.tolist(), anchors)):
                lo, hi = w.bounds[i], w.bounds[i + 1]
                text = b""
                if own and hi - lo >= k:
                    text = raw[offsets[i]:offsets[i + 1]]
                    at = np.array(own, np.int64) * block
                    np.add.at(near, lo + np.maximum(at - block, 0), 1)
                    np.add.at(near, np.minimum(lo + at + 1, hi), -1)
                blob = (b"+" if known[i] else b"-") + _doc_blob(w, raw, i, text)
                rows.append((-1, homes[i], _DOC, doc, node, blob))
            yield _rows(rows)
            h, at = w.windows(k)
            use = np.cumsum(near)[at] > 0
            at = at[use]
            held.append((h[use], who[w.row[at]], w.place[at]))
            size += len(at)
            if size >= TASK_WORDS // 4:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()
    return run


def _doc_blob(w: Words, raw: bytes, i: int, text: bytes) -> bytes:
    """Kept whole: the word count and digest.  With anchors: the text, for later."""
    if text:
        return b"T" + pa.compress(text, codec="zstd", asbytes=True) + len(text).to_bytes(8, "little")
    lo, hi = w.bounds[i], w.bounds[i + 1]
    a, b = w.starts[lo:hi].tolist(), w.ends[lo:hi].tolist()
    digest = hashlib.sha256(b" ".join([raw[x:y] for x, y in zip(a, b)])).digest()
    return b"K" + int(hi - lo).to_bytes(8, "little") + digest


def _columns(who: np.ndarray) -> list[np.ndarray]:
    return [np.ascontiguousarray(who[c]).view(U64) for c in ("doc", "node")]


def _sent_home(who: np.ndarray, start: np.ndarray, homes: int, kind: int) -> list[tuple]:
    """(home, kind, 0, 0, blob): one row for each home of documents, with the starts of their repeats."""
    home = _home(np.ascontiguousarray(who["node"]), homes)
    order = np.lexsort((start, who["node"], who["doc"], home))
    home, who, start = home[order], who[order], start[order]
    cuts = np.flatnonzero(np.append(True, home[1:] != home[:-1])) if len(home) else np.zeros(0, np.int64)
    out = []
    for lo, hi in zip(cuts, np.append(cuts[1:], len(home))):
        names, many = np.unique(who[lo:hi], return_counts=True)
        out.append((int(home[lo]), kind, 0, 0, pack_arrays([
            *_columns(names), _smallest(many.astype(U64)), _smallest(start[lo:hi].astype(U64))])))
    return out


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 6
    types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                      names=["bucket", "home", "kind", "doc", "node", "blob"])


def _answer(homes: int):
    """One bucket: the windows that are not the earliest of their words.  Other rows pass."""
    def fn(cols):
        if cols["deal"][0] < 0:
            return [cols["home"], cols["kind"], cols["doc"], cols["node"], np.array(cols["blob"], object)]
        held = [unpack_arrays(x) for x in cols["blob"]]
        h = np.concatenate([np.cumsum(x[0], dtype=U64) for x in held])
        who = np.concatenate([_documents(x[1].view(np.int64), x[2].view(np.int64))[x[3]] for x in held])
        start = np.concatenate([x[4].astype(np.int64) for x in held])
        h, who, start, _, late = _late(h, who, start)
        rows = _sent_home(who[late], start[late], homes, _ANSWER)
        if not rows:
            return None
        home, kind, doc, node, blob = zip(*rows)
        return [np.array(home, np.int32), np.array(kind, np.int32), np.array(doc, np.int64), np.array(node, np.int64),
                np.array(blob, object)]
    return fn


def _finish(block: int):
    k = 2 * block

    def fn(cols):
        """The documents of one home: joins their repeats and takes the words out."""
        starts: dict[tuple[int, int], list[np.ndarray]] = {}
        for blob, kind in zip(cols["blob"], cols["kind"]):
            if kind != _DOC:
                docs, nodes, many, start = unpack_arrays(blob)
                parts = np.split(start.astype(np.int64), np.cumsum(many.astype(np.int64))[:-1])
                for who, s in zip(zip(docs.view(np.int64).tolist(), nodes.view(np.int64).tolist()), parts):
                    starts.setdefault(who, []).append(s)
        out = []
        for who, blob, kind in zip(zip(cols["doc"].tolist(), cols["node"].tolist()), cols["blob"], cols["kind"]):
            if kind != _DOC:
                continue
            (doc, _), known, blob = who, blob[:1] == b"+", blob[1:]
            if blob[:1] == b"K":
                out.append((doc, known, int.from_bytes(blob[1:9], "little"), 0, blob[9:].hex(), ""))
                continue
            text = pa.decompress(blob[1:-8], decompressed_size=int.from_bytes(blob[-8:], "little"), codec="zstd", asbytes=True)
            found = text.split()
            cover = np.zeros(len(found) + 1, np.int64)
            for s in starts.get(who, ()):
                s = s[s + k <= len(found)]
                np.add.at(cover, s, 1)
                np.add.at(cover, s + k, -1)
            gone = np.cumsum(cover[:-1]) > 0
            edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
            kept = b" ".join([w for w, g in zip(found, gone.tolist()) if not g])
            out.append((doc, known, len(found), int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                        ",".join(f"{a}:{b}" for a, b in edge.reshape(-1, 2).tolist())))
        if not out:
            return None
        doc, known, n, gone, sha, removed = zip(*out)
        return [np.array(doc, np.int64), np.array(known, bool), np.array(n, np.int64), np.array(gone, np.int64),
                np.array(sha, object), np.array(removed, object)]
    return fn


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK,
                   buckets: int | None = None) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and ``removed``.

    ``removed`` lists the maximal exact repeats as ``first:end`` word numbers.
    """
    src = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc"),
                    F.xxhash64(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")).alias("node"),
                    F.col(f"`{text}`").alias("__text"))
    size = (src.agg(F.sum(F.octet_length("__text"))).first()[0] or 0) // 6 + 1
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or max(tasks, -(-size // BUCKET_WORDS))
    bits = max(32, size.bit_length() + 5)

    sent = map_arrow(src.select("node", "__text"), _probe(block, buckets, bits), "bucket int, blob binary")
    hot = map_groups(sent, ["bucket"], _anchors, "node bigint, number bigint", ("blob",))
    hot = hot.groupBy("node").agg(F.collect_set("number").alias("anchors"))

    both = src.join(hot, "node", "left").select("doc", "node", "anchors", "__text")
    rows = map_arrow(both, _look_up(block, buckets), _ROW)
    dealt = rows.withColumn("deal", F.when(F.col("kind") == _BUCKET, F.col("bucket")).otherwise(-1 - F.col("home")))
    dealt = dealt.select("deal", "home", "kind", "doc", "node", "blob")
    answered = map_groups(dealt, ["deal"], _answer(buckets), "home int, kind int, doc bigint, node bigint, blob binary",
                          ("blob",))
    done = map_groups(answered, ["home"], _finish(block),
                      "doc bigint, known boolean, n_words bigint, n_removed bigint, kept_sha256 string, removed string", ("blob",))
    return done.select(F.when(F.col("known"), F.col("doc")).alias(doc_id), "n_words", "n_removed", "kept_sha256", "removed")
