"""I-Match fingerprints, in DataFrame functions only.

Terms are lower-cased runs of letters and digits.  The lexicon holds the terms
whose inverse document frequency lies in a band: of n documents at least
``n / MAX_RATIO`` and at most ``n / MIN_RATIO`` have the term.  A document has
few terms on average (d, say), so at most ``d * MAX_RATIO`` terms can be in the
band, however large the corpus: the lexicon is a bounded set, collected and
written into the plan as an IN list.

A document's distinct lexicon terms, sorted, are hashed once for each of 36
randomised subsets of the lexicon: 4 families of 9 rates (1/2 to 1/512), so
that for short and long texts alike some subsets hold one to three terms and
survive small edits.  A text without lexicon terms uses all its terms.  The
likeness of two fingerprints is the share of equal hashes among the subsets
that are not empty in both.

Defined cases: a null text is empty; an empty fingerprint has likeness 1 to an
empty one and 0 to others; null ids come first in the order of documents;
repeated rows count each (one follows the other); a single document follows
itself; other columns are not read.  Ids are integers of up to 64 bits, however
they lie; rows with one id stay in one range.  Texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .id_ranges import id_ranges, let, numbers

MIN_RATIO, MAX_RATIO = 10, 100
FAMILIES, RATES = 4, 9
CELL_ROWS, MOST_CELL_ROWS, CELLS = 32, 100_000, 8192
SUBSETS = [(f, f"{65536 >> r:04x}") for f in range(FAMILIES) for r in range(1, RATES + 1)]
NO_TERMS = "-"


def terms(text: Column) -> Column:
    """Distinct terms of a text."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != ""))


def lexicon(df: DataFrame, text: str = "text") -> list[str]:
    """Terms in the band, from the counts of all documents (at least two must have a term)."""
    n = df.count()
    counts = df.select(F.explode(terms(F.col(f"`{text}`"))).alias("term")).groupBy("term").count()
    band = counts.filter((F.col("count") >= 2) & (F.col("count") * MAX_RATIO >= n) & (F.col("count") * MIN_RATIO <= n))
    return sorted(r["term"] for r in band.collect())


def signature(text: Column, words: list[str]) -> Column:
    """The 36 subset hashes of a text (``-``: no term in the subset)."""
    specs = F.array(*[F.struct(F.lit(a).alias("family"), F.lit(b).alias("below")) for a, b in SUBSETS])

    def chosen(every: Column) -> Column:
        if not words:
            return F.array_sort(every)
        return let(F.filter(every, lambda t: t.isin(words)),
                   lambda found: F.array_sort(F.when(F.size(found) > 0, found).otherwise(every)))

    def hashed(marked: Column) -> Column:
        def one(spec: Column) -> Column:
            inside = F.filter(marked, lambda m: F.get(m["d"], spec["family"]) < spec["below"])
            return let(F.array_join(F.transform(inside, lambda m: m["t"]), " "), lambda joined: F.when(
                joined == "", F.lit(NO_TERMS)).otherwise(F.substring(F.md5(joined), 1, 8)))
        return F.transform(specs, one)

    # Four digits of the term's digest for each family decide its subsets.
    marked = F.transform(let(terms(text), chosen), lambda t: let(F.md5(t), lambda d: F.struct(
        t.alias("t"), F.array(*[F.substring(d, 4 * f + 1, 4) for f in range(FAMILIES)]).alias("d"))))
    return let(marked, hashed)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets with terms in either."""
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x != NO_TERMS) | (y != NO_TERMS)), lambda z: z))
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x == y) & (x != NO_TERMS)), lambda z: z))
    return F.when(either == 0, F.lit(1.0)).otherwise(equal / either)


def with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text", cell_rows: int = CELL_ROWS,
              also: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, text, next_text): each document beside the next by id, the last beside the first.

    Ids are cut into cells of about ``cell_rows`` rows or 1/``CELLS`` of all;
    a window in the cell gives the next text.  The rows with a cell's smallest
    id, which the cut tells, also stand at the end of the cell before, so no
    join is needed and texts are shuffled once.  Rows without an id come first,
    in cells by the hash of their text.  ``also`` names further values of a row
    that are wanted of the next row as well (``next_<name>``); they are worked
    out before the shuffle, once a row.
    """
    id_, body = F.col(f"`{doc_id}`").cast("long"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    n = df.count()
    cells = max(CELLS, n // MOST_CELL_ROWS)
    no_id = id_ranges(df.filter(id_.isNull()), F.xxhash64(body), cell_rows, cells)
    ids = id_ranges(df, id_, cell_rows, cells)
    lows = [c[0] for c in no_id.cells + ids.cells]
    names = ["text", *(also or {})]
    base = df.select(id_.alias("id"), body.alias("text"), *[v.alias(k) for k, v in (also or {}).items()],
                     F.coalesce(id_, F.xxhash64(body)).alias("key"))
    own = F.when(F.col("id").isNull(), no_id.cell(F.col("key"))).otherwise(ids.cell(F.col("key")) + len(no_id.cells))
    placed = base.withColumn("cell", own)
    first = F.col("key") == F.get(numbers(lows or [0], "bigint"), F.col("cell"))
    here = F.struct("cell", F.lit(False).alias("again"))
    before = F.struct(F.pmod(F.col("cell") - 1, F.lit(max(1, len(lows)))).alias("cell"), F.lit(True).alias("again"))
    dealt = placed.withColumn("at", F.explode(F.when(first, F.array(here, before)).otherwise(F.array(here))))
    w = Window.partitionBy("at.cell").orderBy("at.again", "key", "text")
    lined = dealt.withColumn("next", F.lead(F.struct(*names)).over(w)).filter(~F.col("at.again"))
    return lined.select(F.col("id").alias(doc_id), *names, *[F.col(f"next.{c}").alias(f"next_{c}") for c in names])


def edited(text: Column, next_text: Column) -> Column:
    """The last quarter of the code points replaced by as many of the next text's first."""
    n = F.length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(next_text, F.lit(1), quarter))


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint): the subset hashes of every text, joined by points."""
    words = lexicon(df, text)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(F.col(f"`{doc_id}`").alias(doc_id), F.array_join(signature(body, words), ".").alias("fingerprint"))


def edit_likeness(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and two likenesses."""
    words = lexicon(df, text)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = with_next(df, doc_id, text, also={"fingerprint": F.array_join(signature(body, words), ".")})
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    signed = rows.select(doc_id, F.length("text").cast("long").alias("n_chars"),
                         F.sha2(F.col("edited"), 256).alias("edited_sha256"), "fingerprint",
                         F.array_join(signature(F.col("edited"), words), ".").alias("edited_fingerprint"), "next_fingerprint")

    def near(other: str) -> Column:
        return likeness(F.split("fingerprint", r"\."), F.split(other, r"\."))
    return signed.select(doc_id, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                         near("edited_fingerprint").alias("near_edited"), near("next_fingerprint").alias("near_next"))
