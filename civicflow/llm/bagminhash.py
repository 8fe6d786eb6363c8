"""Near-duplicate classes by BagMinHash.

A document is the multiset of its five-word shingles.  Each shingle carries
Poisson processes over its weight: one for weight [0, 1) and one for each
[2^(i-1), 2^i), whose rate is the interval's length.  A point has a time, a
register and a place within the interval; it counts where the place lies below
the shingle's weight.  Each register keeps its earliest time, so two documents
agree in a register with probability equal to their weighted Jaccard
similarity.  Points are made in order of time and only while they can still
change a register.

Classes are the connected components of all pairs with weighted Jaccard of at
least ``threshold``:

1. Equal texts are one document.  Each text of a repeated doc_id counts, and
   all of them are one class.
2. Bands of registers give buckets.  In every bucket all members' signatures
   are compared (blocks of members, on separate tasks), and pairs at
   ``threshold - margin`` or more join candidate groups.
3. In every candidate group the exact multiset overlap of all members is
   computed (again by blocks), and pairs at ``threshold`` or more are links.

Both steps pass on a spanning forest of each block's links instead of the
links, so a group of k near copies gives about k rows; no link between
different texts is lost that the bands found.  Bands have 4 registers; there
are 20, and more for thresholds below 0.8, so that a pair at the threshold
shares no band with probability ``MISS`` at most.  At 0.8 it falls below the
margin with about the same, at lower thresholds less often.

Defined cases: a null text is empty; texts without words are near only to
equal texts; a text of one to four words is one shingle; rows without an id
are linked like all others, and a class without any id has a negative class
id.  Texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, join_hash, map_arrow, mix, sheltered, span_hashes, text_chunks, windows, words, write_out
from .graph import block_pairs, components, local_roots, map_groups

SHINGLE = 5
THRESHOLD = 0.8
MARGIN = 0.18
BANDS, ROWS = 20, 4
MISS = 3.2e-5
BLOCK = 1000


def bands_for(threshold: float) -> int:
    """Bands that a pair at ``threshold`` misses with probability ``MISS`` at most (``BANDS`` at least)."""
    if not 0 < threshold <= 1:
        raise ValueError(f"threshold {threshold} is not above 0 and at most 1")
    if threshold == 1:
        return BANDS
    return max(BANDS, math.ceil(math.log(MISS) / math.log1p(-threshold ** ROWS)))


# -- shingles and signatures -------------------------------------------------

def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, weight) of every distinct shingle, by row."""
    starts, ends, row = words(data, offsets)
    h = span_hashes(data, starts, ends)
    w, at = windows(h, row, k)
    r = row[at]
    n_words = np.bincount(row, minlength=len(offsets) - 1)
    few = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(few):  # all words of a short text together
        first = np.searchsorted(row, few)
        whole = mix(n_words[few].astype(U64))
        for i in range(k - 1):
            on = n_words[few] > i
            whole[on] = join_hash(whole[on], h[first[on] + i])
        w, r = np.concatenate([w, whole]), np.concatenate([r, few])
    order = np.lexsort((w, r))
    w, r = w[order], r[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (r[1:] != r[:-1])
    begin = np.flatnonzero(new)
    return r[begin], w[begin], np.diff(np.append(begin, len(w)))


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_rows: int,
               registers: int = BANDS * ROWS) -> np.ndarray:
    """Earliest point times, ``n_rows x registers`` (inf for a row without shingles)."""
    h = np.full(n_rows * registers, np.inf)
    levels = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)  # [0,1) [1,2) [2,4) ... below the weight
    unit = np.repeat(np.arange(len(row)), levels)
    level = np.arange(len(unit)) - np.repeat(np.cumsum(levels) - levels, levels)
    r, w = row[unit], weight[unit].astype(np.float64)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    wide = np.where(level == 0, 1.0, low)
    seed = join_hash(shingle[unit], level.astype(U64))
    time = np.zeros(len(unit))
    turn = 0
    while len(r):
        turn += 1
        s = mix(seed + U64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
        time = time - np.log1p(-(s >> U64(11)).astype(np.float64) * 2.0 ** -53) / (wide * registers)
        t = mix(s ^ U64(0xA0761D6478BD642F))
        register = (t >> U64(32)) % U64(registers)
        place = low + wide * ((t & U64(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32)
        ok = place < w
        np.minimum.at(h, r[ok] * registers + register[ok].astype(np.int64), time[ok])
        live = time < h.reshape(n_rows, registers).max(axis=1)[r]
        r, w, low, wide, seed, time = (x[live] for x in (r, w, low, wide, seed, time))
    return h.reshape(n_rows, registers)


def _occurrences(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_rows: int) -> list[bytes]:
    """Per row, 32-bit hashes of (shingle, 1st, 2nd, ... occurrence): a set whose
    Jaccard similarity is the multiset's.  Two texts of 20,000 words have a
    chance agreement of 0.1 of their shingles.
    """
    unit = np.repeat(np.arange(len(row)), weight)
    nth = np.arange(len(unit)) - np.repeat(np.cumsum(weight) - weight, weight)
    code = (join_hash(shingle[unit], nth.astype(U64)) >> U64(32)).astype("<u4")
    bounds = np.searchsorted(row[unit], np.arange(n_rows + 1))
    return [code[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


def _signed(bands: int):
    """(id, key) with the signature as 32-bit floats; no bytes for a text without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_chunks(batches, "__text"):
            n = part.num_rows
            row, shingle, weight = shingles(data, offsets)
            sig = signatures(row, shingle, weight, n, bands * ROWS).astype("<f4")
            empty = np.isinf(sig[:, 0])
            raw = [b"" if e else x.tobytes() for x, e in zip(sig, empty)]
            yield pa.RecordBatch.from_arrays(part.columns[:-1] + [pa.array(raw, pa.binary())], names=["id", "key", "sig"])
    return run


def _banded(bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node = b.column(0).to_numpy(zero_copy_only=False)
            raw = b.column(1).to_pylist()
            if not raw:
                continue
            sig = np.frombuffer(b"".join(raw), "<u4").reshape(len(raw), bands * ROWS).astype(U64)
            keys = []
            for k in range(bands):
                key = np.full(len(raw), U64(k))
                for j in range(k * ROWS, (k + 1) * ROWS):
                    key = join_hash(key, sig[:, j])
                keys.append(key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(node, bands))], names=["bucket", "node"])
    return run


# -- work within a bucket or a group -----------------------------------------

def _forest(node: np.ndarray, root: np.ndarray) -> list[np.ndarray] | None:
    other = root != np.arange(len(root))
    return [node[other], node[root[other]]] if other.any() else None


def _alike(least: float):
    """Forest of the pairs of one block whose signatures agree in ``least`` of the registers."""
    def fn(cols):
        node = cols["node"]
        if len(node) < 2:
            return None
        sig = np.frombuffer(b"".join(cols["sig"]), "<u4").reshape(len(node), -1)
        need = int(np.ceil(least * sig.shape[1] - 1e-9))
        if len(node) == 2:
            return [node[1:], node[:1]] if np.count_nonzero(sig[0] == sig[1]) >= need else None
        agree = np.zeros((len(node), len(node)), np.uint8 if sig.shape[1] < 256 else np.int32)
        for c in sig.T:
            agree += c[:, None] == c[None, :]
        return _forest(node, local_roots(agree >= need))
    return fn


def _overlap(bags: list[np.ndarray], column_block: int = 4096, codes_at_once: int = 2_000_000) -> np.ndarray:
    """Sizes of all pairwise intersections of sets of codes, by slices of the codes."""
    n = len(bags)
    every = np.concatenate(bags)
    owners = np.repeat(np.arange(n, dtype=np.int32), [len(b) for b in bags])
    out = np.zeros((n, n), np.float32)
    parts = len(every) // codes_at_once + 1
    for part in range(parts):  # memory stays bounded for long texts
        mine = every % parts == part
        _, which, many = np.unique(every[mine], return_inverse=True, return_counts=True)
        common = many > 1  # a code of one set is in no intersection of two
        use = common[which]
        owner, col = owners[mine][use], (np.cumsum(common) - 1)[which[use]]
        order = np.argsort(col, kind="stable")
        owner, col = owner[order], col[order]
        for lo in range(0, int(col[-1]) + 1 if len(col) else 0, column_block):
            a, b = np.searchsorted(col, [lo, lo + column_block])
            hold = np.zeros((n, column_block), np.float32)
            hold[owner[a:b], col[a:b] - lo] = 1
            out += hold @ hold.T
    return out


def _near(least: float):
    """Forest of the pairs of one block with multiset Jaccard of at least ``least``."""
    def fn(cols):
        node = cols["node"]
        if len(node) < 2:
            return None
        bags = [np.unique(np.frombuffer(x, "<u4")) for x in cols["bag"]]
        size = np.array([len(x) for x in bags], np.float64)
        if len(node) == 2:
            both = len(np.intersect1d(bags[0], bags[1], assume_unique=True))
            return [node[1:], node[:1]] if both >= least * (size.sum() - both) - 1e-9 else None
        both = _overlap(bags).astype(np.float64)
        return _forest(node, local_roots(both >= least * (size[:, None] + size[None, :] - both) - 1e-9))
    return fn


# -- whole tables ------------------------------------------------------------

def near_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                 margin: float = MARGIN, block: int = BLOCK) -> DataFrame:
    """(doc_id, key, class_id) for every row; class_id is the smallest doc_id of the class.

    ``key`` is the text's digest.  Shuffled: signatures of documents that share
    a bucket, and texts once; buckets and groups are split into blocks, so a
    hot one is spread over tasks.
    """
    bands = bands_for(threshold)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # Two hashes of 64 bits each identify a text.
    key = F.concat_ws("-", F.xxhash64(body), F.xxhash64(F.lit(1), body))
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("id"), key.alias("key"), body.alias("__text"))
    signed = write_out(map_arrow(docs, _signed(bands), "id bigint, key string, sig binary"), "signed")
    # One node per different text: its smallest id, or a negative one where another text has that id too.
    first = write_out(signed.groupBy("key").agg(F.min("id").alias("first")), "first-ids")
    owners = first.filter("first is not null").groupBy("first").agg(F.min("key").alias("key"))
    nodes = first.join(owners.select("key", F.col("first").alias("node")), "key", "left").select(
        "key", "first", F.coalesce("node", _unnamed("key")).alias("node"))
    nodes = write_out(nodes, "texts")
    at = nodes.select(F.coalesce("first", _unnamed("key")).alias("at"), "key", "node")  # the row that stands for the text
    own = signed.select(F.coalesce("id", _unnamed("key")).alias("at"), "key", "sig").join(at, ["at", "key"])
    own = write_out(own.filter(F.octet_length("sig") > 0).select("node", "sig").dropDuplicates(["node"]), "nodes")

    member = map_arrow(own.select("node", "sig"), _banded(bands), "bucket bigint, node bigint")
    member = write_out(member, "buckets")
    full = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    member = block_pairs(member.join(full, "bucket"), "bucket", "node", "n", block)
    member = member.join(own, "node").select("bucket", "lo", "hi", "node", "sig")
    alike = map_groups(member, ["bucket", "lo", "hi"], _alike(threshold - margin), "a bigint, b bigint", ("sig",))
    group = components(alike)

    group = write_out(group, "groups")
    size = group.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    member = block_pairs(group.join(size, "root"), "root", "node", "n", block)
    texts = docs.select(F.coalesce("id", _unnamed("key")).alias("at"), "key", "__text").join(
        at.join(group.select("node"), "node", "left_semi"), ["at", "key"])
    texts = texts.select("node", "__text").dropDuplicates(["node"])
    bags = write_out(map_arrow(texts, _bagged, "node bigint, bag binary"), "bags")
    member = member.join(bags, "node").select("root", "lo", "hi", "node", "bag")
    near = map_groups(member, ["root", "lo", "hi"], _near(threshold), "a bigint, b bigint", ("bag",))
    linked = components(near.unionByName(_same_id(signed, nodes)))

    # A negative root may stand for texts with ids: their smallest id is the class then.
    rooted = write_out(nodes.join(linked, "node", "left").select(
        "key", "first", F.coalesce("root", "node").alias("root")), "roots")
    below = rooted.filter("root < 0")
    named = below.groupBy("root").agg(F.min("first").alias("least"))
    classes = rooted.filter("root >= 0").select("key", F.col("root").alias("class_id")).unionByName(
        below.join(named, "root").select("key", F.coalesce("least", "root").alias("class_id")))
    return signed.select("id", "key").join(classes, "key").select(
        F.col("id").alias(doc_id), "key", "class_id")


def _same_id(signed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the texts of each doc_id that has several."""
    several = signed.filter("id is not null").groupBy("id").agg(
        F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high").select("id")
    texts = signed.select("id", "key").join(several, "id").distinct().join(nodes, "key").select("id", "node")
    texts = write_out(texts, "same-id")
    return texts.join(texts.groupBy("id").agg(F.min("node").alias("b")), "id").select(F.col("node").alias("a"), "b")


def _unnamed(key: str) -> Column:
    """The negative node of a text whose rows have no id."""
    return -F.abs(F.xxhash64(key) % (1 << 62)) - 1


def _bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in text_chunks(batches, "__text"):
        row, shingle, weight = shingles(data, offsets)
        raw = _occurrences(row, shingle, weight, part.num_rows)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(raw, pa.binary())], names=["node", "bag"])


@sheltered()
def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that stand for their class: the one with the smallest id.

    Repeated rows leave one; of an id with several texts, the one with the
    smallest digest stays.  A row without an id stays if no row of its class
    has an id (one of them).
    """
    classes = near_classes(df, doc_id, text, threshold)
    first = classes.filter(F.col(doc_id) == F.col("class_id")).groupBy(F.col(doc_id).alias("__id")).agg(
        F.min("key").alias("__key"))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = F.concat_ws("-", F.xxhash64(body), F.xxhash64(F.lit(1), body))
    named = df.join(first, (F.col(f"`{doc_id}`") == F.col("__id")) & (key == F.col("__key")), "left_semi")
    named = named.dropDuplicates([doc_id])
    alone = classes.filter("class_id < 0").groupBy("class_id").agg(
        F.count(doc_id).alias("n"), F.min("key").alias("__key")).filter("n = 0")
    unnamed = df.filter(F.col(f"`{doc_id}`").isNull()).withColumn("__key", key)
    unnamed = unnamed.join(alone.select("__key"), "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
    return named.unionByName(unnamed)
