"""Spelling variants of a corpus's words, by an index of variable-length grams.

Two words are near if one inserted, deleted or replaced code point turns one
into the other.  Near words are found class by class: class c compares words of
length c with words of length c and c + 1.

1. Gram dictionary of a class: all grams of 2 code points, and each longer gram
   (up to half of c, at most ``MAX_GRAM``) whose prefix is still frequent, i.e.
   stands in the class more than ``PRUNE`` times.
2. A word is cut into variable grams: the longest gram of the dictionary at each
   place, without those that lie inside an earlier one.
3. An edit at a place can only affect grams near it: with grams of at most q
   signs, gram [p, e) is affected by edits from ``e - q`` to ``p + q - 1``.  So of
   two grams with ``e2 - p1 >= 2 q`` every edit leaves one as it is, at the same
   distance from the start (the first) or from the end (the second).  For each
   word the pair with the shortest lists is taken; its two lists, by gram, side
   and distance, are merged.  By the same bounds the words also agree up to sign
   ``p1 + q``, or from sign ``e2 - q`` on.
4. What the lists bring together is verified by that and by edit distance,
   inside the join.

Words longer than ``LONG`` have their two halves as grams: one edit leaves one
of them.  Long lists are cut into blocks of probing and of listed words, and
each two blocks meet in a group of their own, so a common gram does not end in
one task; no pair is lost and none is written before it is verified.

A word's form is its near word of largest count (ties: the smallest in
code-point order) if that count is ``RATIO`` times its own or more.  Forms have
growing counts, so following them ends; the root is found by doubling.

Defined cases: a null or empty text has no words; repeated rows count each;
words shorter than ``min_length`` are left out (at least 4, so that two grams of
two signs fit); empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, runs, span_hashes, text_chunks, write_out

MIN_GRAM, MAX_GRAM, PRUNE, LONG = 2, 8, 50, 64
PROBE_BLOCK, LIST_BLOCK = 500, 5000
RATIO = 5
OUT = ["form", "root", "n", "n_near", "form_n"]

# A-Z, a-z, and the two bytes of U+00C0 to U+00FF.
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC3] = True


# -- words -------------------------------------------------------------------

def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased; byte starts, ends and row of the runs of Latin letters."""
    inside = _LETTER[data]
    inside[1:] |= data[:-1] == 0xC3
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends = runs(inside, offsets)
    return low, starts, ends, np.searchsorted(offsets[1:], starts, side="right")


def count_words(docs: DataFrame, text: str = "text", key: str | None = None,
                edit: Callable | None = None) -> DataFrame:
    """(word, n) of all lower-cased letter runs of whole texts.

    ``edit(keys, row, data, starts, ends)`` may replace runs: it returns the
    indexes of the runs and their new bytes.  A chunk of texts sends one row
    for each different word.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_chunks(batches, "__text", 8 << 20):
            data, starts, ends, row = letter_runs(data, offsets)
            if len(starts) == 0:
                continue
            extra: list[bytes] = []
            if edit is not None:
                at, extra = edit(part.column(0), row, data, starts, ends)
                keep = np.ones(len(starts), bool)
                keep[at] = False
                starts, ends = starts[keep], ends[keep]
            _, first, n = np.unique(span_hashes(data, starts, ends), return_index=True, return_counts=True)
            raw = data.tobytes()
            words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())] + extra
            counts = np.concatenate([n, np.ones(len(extra), n.dtype)])
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()),
                                              pa.array(counts, pa.int64())], names=["word", "n"])

    src = docs.select((F.col(f"`{key}`") if key else F.lit(None)).cast("string").alias("__key"),
                      F.col(f"`{text}`").alias("__text"))
    return map_arrow(src, run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# -- gram index --------------------------------------------------------------

def _grams(words: DataFrame) -> DataFrame:
    """Every gram of every word in its class and the class below: (c, word, n, size, p, gram)."""
    least = F.lit(MIN_GRAM)
    classes = words.withColumn("c", F.explode(F.array(F.col("size"), F.col("size") - 1)))
    longest = F.least(F.expr("c div 2"), F.lit(MAX_GRAM))
    lengths = classes.withColumn("q", F.explode(F.sequence(least, longest)))
    places = lengths.withColumn("p", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("q"))))
    return places.withColumn("gram", F.substr("word", F.col("p") + 1, F.col("q"))).drop("q")


def dictionary(grams: DataFrame, prune: int = PRUNE) -> DataFrame:
    """(c, gram, f): grams of two signs, and longer ones whose prefix stands more than ``prune`` times."""
    counts = write_out(grams.groupBy("c", "gram").agg(F.count(F.lit(1)).alias("f")), "gram-counts")
    short = F.length("gram") == MIN_GRAM
    often = counts.filter(F.col("f") > prune).select("c", F.col("gram").alias("stem"))
    longer = counts.filter(~short).withColumn("stem", F.expr("substr(gram, 1, length(gram) - 1)"))
    return counts.filter(short).unionByName(longer.join(often, ["c", "stem"], "left_semi").drop("stem"))


def decompose(row: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Indexes of the words' variable grams, in order: the longest at each place, none inside an earlier one.

    ``row`` numbers the words, ``p`` and ``q`` are places and lengths of the
    dictionary's grams in them.
    """
    order = np.lexsort((q, p, row))
    row, p, q = row[order], p[order], q[order]
    longest = np.ones(len(row), bool)
    longest[:-1] = (row[1:] != row[:-1]) | (p[1:] != p[:-1])
    order, end = order[longest], (row * 4 * LONG + p + q)[longest]
    reach = np.maximum.accumulate(end)
    fresh = np.ones(len(end), bool)
    fresh[1:] = end[1:] > reach[:-1]
    return order[fresh]


def probes(row: np.ndarray, p: np.ndarray, e: np.ndarray, f: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word, the pair of its grams that no edit affects together, with the shortest lists.

    ``row`` (ascending), starts, ends (ascending in a row), list lengths and
    the longest gram's length.  Gram [p, e) is affected by edits at ``e - q`` to
    ``p + q - 1`` only, so the second must end 2 q after the first begins.
    """
    at = np.arange(len(row))
    # The shortest list so far in each row: later rows have smaller values.
    rank = f + (row[-1] - row) * (1 << 41) if len(row) else f
    low = np.minimum.accumulate(rank)
    first = np.ones(len(row), bool)
    first[1:] = low[1:] < low[:-1]
    where = np.maximum.accumulate(np.where(first, at, 0))
    # The last gram that begins early enough for each one to be the second.
    limit = np.searchsorted(row * 4 * LONG + p, row * 4 * LONG + e - 2 * q, side="right") - 1
    fits = (limit >= 0) & (row[limit] == row) & (limit < at)
    left, right = where[limit[fits]], at[fits]
    cost = f[left] + f[right]
    order = np.lexsort((right, cost, row[right]))
    left, right = left[order], right[order]
    best = np.ones(len(right), bool)
    best[1:] = row[right[1:]] != row[right[:-1]]
    return left[best], right[best]


_PLACE, _SIZE = 44, 40  # bits of a packed gram: place, length (4 bits), list length


def _entries(words: DataFrame, prune: int) -> DataFrame:
    """(key, side, probe, keep, word, n): every variable gram of every word, from both ends.

    ``key`` hashes class, gram, side and distance (a chance agreement only
    brings words together that are then told apart).  ``probe`` marks the
    word's own two grams, in the class of its length; ``keep`` is how many
    signs on that side no edit can have changed that leaves the gram.
    """
    grams = _grams(words.filter(F.col("size") <= LONG))
    known = write_out(dictionary(grams, prune), "grams")
    packed = (F.shiftleft(F.col("p").cast("long"), _PLACE) + F.shiftleft(F.length("gram").cast("long"), _SIZE)
              + F.least(F.col("f"), F.lit((1 << _SIZE) - 1)))
    found = grams.join(known, ["c", "gram"]).groupBy("c", "word", "n").agg(F.collect_list(packed).alias("grams"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            words, listed = batch.column(1).to_pylist(), batch.column(3)
            flat = listed.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), np.diff(listed.offsets.to_numpy()))
            p, q, f = flat >> _PLACE, (flat >> _SIZE) & 15, flat & ((1 << _SIZE) - 1)
            use = decompose(row, p, q)
            row, p, e, f = row[use], p[use], (p + q)[use], f[use]
            c = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            size = np.array([len(w) for w in words], np.int64)
            own = np.flatnonzero((c == size)[row])
            left, right = probes(row[own], p[own], e[own], f[own], np.minimum(c // 2, MAX_GRAM)[row[own]])
            marks = np.zeros((2, len(row)), bool)
            marks[0, own[left]] = marks[1, own[right]] = True
            take = pa.array(row)
            text = [words[r][a:b] for r, a, b in zip(row.tolist(), p.tolist(), e.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), pa.array(text, pa.string()), pa.array(p.astype(np.int32)),
                 pa.array((size[row] - e).astype(np.int32)), pa.array(marks[0]), pa.array(marks[1]),
                 batch.column(1).take(take), batch.column(2).take(take)],
                names=["c", "gram", "l", "r", "left", "right", "word", "n"])

    out = map_arrow(found, run, "c int, gram string, l int, r int, left boolean, right boolean, word string, n bigint")
    longest = F.least(F.expr("c div 2"), F.lit(MAX_GRAM)).cast("int")
    out = out.filter(F.col("c") < LONG).withColumn("e", F.explode(F.array(
        F.struct(F.lit("L").alias("side"), F.col("l").alias("d"), F.col("left").alias("probe"), (F.col("l") + longest).alias("keep")),
        F.struct(F.lit("R").alias("side"), F.col("r").alias("d"), F.col("right").alias("probe"), (F.col("r") + longest).alias("keep")))))
    out = out.select("c", "gram", "e.side", "e.d", "e.probe", "e.keep", "word", "n")
    # Halves of long words; a word of LONG + 1 signs is looked for among those of LONG as well.
    halves = words.filter(F.col("size") > LONG).withColumn("c", F.explode(F.array(F.col("size"), F.col("size") - 1)))
    edge = words.filter(F.col("size") == LONG).withColumn("c", F.col("size"))
    halves = halves.unionByName(edge).filter(F.col("c") >= LONG).withColumn("h", F.expr("int(c div 2)"))
    halves = halves.withColumn("e", F.explode(F.array(
        F.struct(F.lit("L").alias("side"), F.expr("substr(word, 1, h)").alias("gram")),
        F.struct(F.lit("R").alias("side"), F.expr("substr(word, -h, h)").alias("gram")))))
    halves = halves.select("c", "e.gram", "e.side", F.lit(-1).alias("d"), (F.col("c") == F.col("size")).alias("probe"),
                           F.col("h").alias("keep"), "word", "n")
    return out.unionByName(halves).select(
        F.xxhash64("c", "gram", "side", "d").alias("key"), "side", "probe", "keep", "word", "n")


def near_pairs(words: DataFrame, prune: int = PRUNE, probe_block: int = PROBE_BLOCK,
               list_block: int = LIST_BLOCK) -> DataFrame:
    """(a, a_n, b, b_n): each two near words of ``words`` (word, n, size) once."""
    entries = write_out(_entries(words, prune), "gram-entries")
    sizes = entries.groupBy("key").agg(F.count_if("probe").alias("asking"), F.count(F.lit(1)).alias("listed"))
    sizes = write_out(sizes.filter("asking > 0 AND listed > 1").select(
        "key", F.ceil(F.col("asking") / probe_block).cast("int").alias("rows"),
        F.ceil(F.col("listed") / list_block).cast("int").alias("cols")), "gram-lists")
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in its own block, for every block of the other kind."""
        side = side.join(sizes, "key")
        mine = F.pmod(F.xxhash64("word"), F.col(own).cast("long")).cast("int")
        side = side.withColumn("mine", mine).withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        side = side.drop("rows", "cols").withColumnsRenamed({"mine": own, "theirs": other})
        return side.repartition(parts, "key", "rows", "cols")

    block = ["key", "rows", "cols"]
    a = dealt(entries.filter("probe").select("key", "side", "keep", F.col("word"), F.col("n").alias("a_n")), "rows", "cols")
    b = dealt(entries.select("key", "word", F.col("n").alias("b_n")), "cols", "rows")
    a, b = a.withColumnRenamed("word", "a"), b.withColumnRenamed("word", "b")
    once = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    agree = F.when(F.col("side") == "L", F.expr("substr(a, 1, keep) = substr(b, 1, keep)")).otherwise(
        F.expr("substr(a, -keep, keep) = substr(b, -keep, keep)"))
    met = a.join(b.hint("merge"), block).filter(once & agree & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


# -- forms -------------------------------------------------------------------

def follow(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last form that each word leads to, by doubling."""
    state = write_out(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        both = state.join(ahead, "root", "left")
        state = write_out(both.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = state.filter("moved").limit(1).count()
        state = state.drop("moved")
        if not moved:
            return state


def group_variants(counts: DataFrame, min_length: int = 6, min_count: int = 5, ratio: int = RATIO,
                   prune: int = PRUNE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the words of (word, n) that are long and frequent enough."""
    if min_length < 2 * MIN_GRAM:
        raise ValueError(f"words need at least {2 * MIN_GRAM} code points")
    words = counts.select("word", "n").withColumn("size", F.length("word"))
    words = write_out(words.filter((F.col("size") >= min_length) & (F.col("n") >= min_count)), "words")
    pairs = near_pairs(words, prune)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("e")).select("e.*")
    best = sides.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("top"))
    known = words.join(best, "word", "left").withColumn(
        "form_n", F.when(-F.col("top.minus") >= ratio * F.col("n"), -F.col("top.minus")))
    known = write_out(known.select("word", F.when(F.col("form_n").isNotNull(), F.col("top.near")).alias("form"), "n",
                                   F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"), "forms")
    roots = follow(known.filter("form is not null"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
