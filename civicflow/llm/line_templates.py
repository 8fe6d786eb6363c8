"""Line dedup by a log-template tree of fixed depth.

A line's tokens are its words; a token with a digit is a variable field.  The
tree's leaf is the number of tokens and the first ``DEPTH`` tokens.  A template
keeps at least ``MIN_SHARE`` of its line's tokens, and one after the leading
ones; that many of the line's later tokens, the most frequent ones of the leaf
at their places, name its cluster, and the rarest of them bounds the cluster's
documents.  A later token is fixed where it has at least ``FIELD_SHARE`` of
that number; other places are variable fields, so a field's values stay fields
however often each occurs in a large corpus.  A line whose cluster has under
``min_docs`` documents stands for itself.  A template that recurs in at least
``min_docs`` documents is boilerplate: its lines stay in the document with the
smallest doc_id and are dropped from all others.  Counts are the leaf's: a
field's value that is common at its place in other lines of the leaf is fixed.

Leaves, places and templates are counted by partial sums, and the counts are
written.  The rows of a leaf, line, token or template that is very frequent get
them where they are (``join_weighted``): none is gathered in one task.

Defined cases: a null text stays null and has no lines; lines without tokens
are kept; a null doc_id is a document that comes first; rows with equal doc_id
are one document; an empty table gives an empty result; columns other than the
text are passed through, whatever their names (n_lines and n_dropped give way
to the counts where these are wanted).  Ids are integers.  Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, join_hash, map_arrow, mix, sheltered, span_hashes, text_chunks, words, write_out
from .graph import join_weighted

DEPTH = 3
MIN_DOCS = 3
MIN_SHARE = 0.7
FIELD_SHARE = 0.5
FIRST_ID = -(1 << 63)  # stands for a null doc_id
FIELD = U64(0x5851F42D4C957F2D)  # hash of a variable field
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


class Lines:
    """Lines with tokens of a chunk: token hashes, leaf and key of each line."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        breaks = np.flatnonzero(data == 10) + 1
        self.bounds = np.union1d(offsets, breaks)  # byte bounds of all lines
        if len(self.bounds) == 1:
            self.bounds = np.append(self.bounds, len(data))
        starts, ends, row = words(data, self.bounds)
        token = span_hashes(data, starts, ends)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data], dtype=np.int64)])
        token[digits[ends] > digits[starts]] = FIELD
        self.line, self.first, self.size = np.unique(row, return_index=True, return_counts=True)
        self.token = token
        self.doc = np.searchsorted(offsets[1:], self.bounds[self.line], side="right")
        place = (np.arange(len(row)) - np.repeat(self.first, self.size)).astype(U64)
        mixed = mix(token + mix(place + U64(1)))
        total = np.add.reduceat(mixed, self.first) if len(row) else mixed
        self.key = join_hash(total, self.size.astype(U64))
        leaf = mix(self.size.astype(U64))
        for i in range(DEPTH):
            on = np.flatnonzero(self.size > i)
            leaf[on] = join_hash(leaf[on], token[self.first[on] + i])
        self.leaf = leaf

    def rest(self, i: int) -> bytes:
        """32-bit hashes of the tokens after the leading ones."""
        a = self.first[i]
        return (self.token[a + DEPTH:a + self.size[i]] >> U64(32)).astype("<u4").tobytes()


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _first_of(*cols: np.ndarray) -> np.ndarray:
    """Positions of the first row of each different combination."""
    order = np.lexsort(cols)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in cols], axis=0)
    return order[new]


def _leaf_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different leaves of each document, and each one's different lines."""
    for part, data, offsets in text_chunks(batches, "__text"):
        x = Lines(data, offsets)
        at = _first_of(x.key, x.doc)
        leaf, doc = x.leaf[at], x.doc[at]
        order = np.lexsort((leaf, doc))
        leaf, doc = leaf[order], doc[order]
        new = np.ones(len(leaf), bool)
        new[1:] = (leaf[1:] != leaf[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        yield pa.RecordBatch.from_arrays(
            [_signed(leaf[first]), pa.array(np.diff(np.append(first, len(leaf))))], names=["leaf", "n"])


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different lines of each document, with their tokens."""
    for part, data, offsets in text_chunks(batches, "__text"):
        x = Lines(data, offsets)
        at = _first_of(x.key, x.doc)
        ids = part.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [_signed(x.leaf[at]), _signed(x.key[at]), pa.array(ids[x.doc[at]]), pa.array(x.size[at].astype(np.int32)),
             pa.array([x.rest(i) for i in at.tolist()], pa.binary())], names=["leaf", "line", "doc", "size", "rest"])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each token after the leading ones."""
    for b in batches:
        if b.num_rows == 0:
            continue
        leaf, line, n = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        rest = b.column(3).to_pylist()
        size = np.array([len(x) // 4 for x in rest], np.int64)
        token = np.frombuffer(b"".join(rest), "<u4").astype(np.int64)
        place = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(leaf, size)), pa.array(np.repeat(line, size)), pa.array(np.repeat(n, size)),
             pa.array(place.astype(np.int32)), pa.array(token)], names=["leaf", "line", "n", "place", "token"])


def line_templates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, line, template, n_docs, first_doc) of every different line whose leaf recurs.

    ``doc`` is the doc_id (null: the smallest long), ``line`` and ``template``
    are 64-bit hashes, ``n_docs`` counts the template's documents.
    """
    src = df.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(FIRST_ID)).alias("doc"),
                    F.col(f"`{text}`").alias("__text"))
    leaves = map_arrow(src, _leaf_rows, "leaf bigint, n bigint").groupBy("leaf").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n"))
    leaves = write_out(leaves.filter(F.col("docs") >= min_docs).select("leaf", "n"), "leaves")
    rows = map_arrow(src, _line_rows, "leaf bigint, line bigint, doc bigint, size int, rest binary")
    lines = write_out(join_weighted(rows, leaves, ["leaf"], "n"), "lines")

    kinds = lines.groupBy("leaf", "line").agg(
        F.count(F.lit(1)).alias("n"), F.min("rest").alias("rest"), F.first("size").alias("size"))
    kinds = write_out(kinds, "line-kinds")
    several = kinds.groupBy("leaf").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("leaf")
    mixed = kinds.join(several, "leaf", "left_semi").filter(F.octet_length("rest") > 0)
    places = map_arrow(mixed.select("leaf", "line", "n", "rest"), _places,
                       "leaf bigint, line bigint, n bigint, place int, token bigint")
    shared = places.groupBy("leaf", "place", "token").agg(F.sum("n").alias("m"), F.count(F.lit(1)).alias("k"))
    shared = write_out(shared.filter(F.col("m") >= min_docs), "line-tokens")
    # Each line's shared tokens, most frequent first; the last that the template needs bounds the cluster.
    own = join_weighted(places, shared, ["leaf", "place", "token"], "k").groupBy("leaf", "line").agg(F.sort_array(
        F.collect_list(F.struct("m", F.xxhash64("place", "token").alias("h"))), asc=False).alias("own"))
    need = F.greatest(F.lit(1), F.ceil(MIN_SHARE * F.col("size")).cast("int") - DEPTH)
    bound = FIELD_SHARE * F.get("own", need - 1)["m"]
    fixed = F.array_sort(F.transform(F.filter("own", lambda t: t["m"] >= F.col("bound")), lambda t: t["h"]))
    template = F.when(F.col("bound").isNotNull(), F.xxhash64("leaf", fixed)).otherwise(F.xxhash64("leaf", "line"))
    named = kinds.select("leaf", "line", "size", "n").join(own, ["leaf", "line"], "left").withColumn(
        "bound", bound).select("leaf", "line", "n", template.alias("template"))
    named = write_out(named, "line-names")
    told = join_weighted(lines.select("leaf", "line", "doc"), named, ["leaf", "line"], "n").select("doc", "line", "template")
    told = write_out(told, "line-templates")
    counts = told.groupBy("template", "doc").agg(F.count(F.lit(1)).alias("n")).groupBy("template").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("doc").alias("first_doc"), F.sum("n").alias("n"))
    counts = write_out(counts, "template-counts")
    return join_weighted(told, counts, ["template"], "n").select("doc", "line", "template", "n_docs", "first_doc")


@sheltered(lambda a: ["n_lines", "n_dropped"] if a["counts"] else [])
def drop_recurring_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                         counts: bool = False) -> DataFrame:
    """``df`` with recurring template lines dropped from its texts.

    ``counts`` adds n_lines and n_dropped (lines with tokens).  Texts are
    shuffled once, to meet the lines to drop.
    """
    told = line_templates(df, doc_id, text, min_docs)
    gone = told.filter((F.col("n_docs") >= min_docs) & (F.col("doc") != F.col("first_doc")))
    gone = gone.groupBy("doc").agg(F.collect_list("line").alias("__gone")).withColumnRenamed("doc", "__doc")
    extra = ["n_lines", "n_dropped"] if counts else []
    keep = [c for c in df.columns if c != text and c not in extra]
    src = df.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(FIRST_ID)).alias("__doc"),
                    *[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    both = src.join(gone, "__doc", "left").select(*[F.col(f"`{c}`") for c in keep], "__gone", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_chunks(batches, "__text"):
            x = Lines(data, offsets)
            n = part.num_rows
            drop = np.zeros(len(x.line), bool)
            lists = part.column(part.num_columns - 2).to_pylist()
            spans = np.searchsorted(x.doc, np.arange(n + 1))
            raw, texts = data.tobytes(), []
            null = part.column(part.num_columns - 1).is_null().to_pylist()
            for i, lost in enumerate(lists):
                lo, hi = spans[i], spans[i + 1]
                if lost:
                    drop[lo:hi] = np.isin(x.key[lo:hi].view(np.int64), np.array(lost, np.int64))
                if not drop[lo:hi].any():
                    texts.append(None if null[i] else raw[offsets[i]:offsets[i + 1]])
                    continue
                bad = set(x.line[lo:hi][drop[lo:hi]].tolist())
                a, b = np.searchsorted(x.bounds, [offsets[i], offsets[i + 1]]).tolist()
                good = [raw[x.bounds[j]:x.bounds[j + 1]].rstrip(b"\n") for j in range(a, b) if j not in bad]
                if raw[offsets[i + 1] - 1:offsets[i + 1]] == b"\n":
                    good.append(b"")
                texts.append(b"\n".join(good))
            out = part.columns[:-2] + [pa.array(texts, pa.binary()).cast(pa.string())]
            if counts:
                out += [pa.array(np.bincount(x.doc, minlength=n)), pa.array(np.bincount(x.doc[drop], minlength=n))]
            yield pa.RecordBatch.from_arrays(out, names=keep + [text] + extra)

    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"`{text}` string"] + [f"{c} bigint" for c in extra])
    out = map_arrow(both, run, schema)
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in extra], *extra)
