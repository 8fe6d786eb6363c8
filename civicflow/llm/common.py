"""Shared helpers: written intermediate tables, Arrow batches and vectorised word hashes.

Words are the maximal runs of bytes other than space and tab..carriage return
of the UTF-8 text; those six bytes never occur inside a longer UTF-8 sequence,
so the byte rule equals the code-point rule ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

import functools
import inspect
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

U64 = np.uint64
REPO_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


# -- session -----------------------------------------------------------------

def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the session was started.

    Where the session still has Spark's default of 10,000 rows for an Arrow
    batch, 2,000 are set: whole texts make such batches large.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if REPO_ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (REPO_ROOT, have) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under ``spark.checkpoint.dir`` (shared by driver and executors)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    if base is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def write_out(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage: a lost executor costs a re-read, never a recomputation, and
    values that depend on task layout (partition ids) are fixed by the write.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []


def drop_written(spark: SparkSession) -> list[str]:
    """Removes the intermediate tables that this driver has written so far; returns their folders.

    For a job's end: results that were not written or collected yet still read them.
    """
    gone = []
    while _WRITTEN:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_WRITTEN[-1])
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        gone.append(_WRITTEN.pop())
    return gone


# -- Arrow batches -----------------------------------------------------------

def text_chunks(batches: Iterator[pa.RecordBatch], text: str,
                max_bytes: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of about ``max_bytes`` of text: (slice, UTF-8 bytes, offsets).

    A longer text forms a slice of its own, so memory is bounded by the chunk
    size or the longest single text.  Null texts have no bytes.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            part = batch.slice(lo, hi - lo)
            data, offsets = utf8(part.column(part.schema.get_field_index(text)))
            yield part, data, offsets
            lo = hi


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Contiguous UTF-8 bytes and n + 1 offsets of a string column (null: empty)."""
    col = pc.fill_null(col, "") if col.null_count else col
    col = col.cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


# -- words -------------------------------------------------------------------

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``, cut at the offsets."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cuts = offsets[(offsets > 0) & (offsets < n)]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and row number of every word."""
    starts, ends = runs(~IS_SPACE[data], offsets)
    return starts, ends, np.searchsorted(offsets[1:], starts, side="right")


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and odd multipliers)."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


def join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ordered combination of two hashes."""
    return mix(a * U64(0x9E3779B97F4A7C15) + b + U64(0x2545F4914F6CDD1D))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes at a time."""
    size = (ends - starts).astype(np.int64)
    h = mix(size.astype(U64) + U64(0x1F83D9ABFB41BD6B))
    if len(starts) == 0:
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    live = np.flatnonzero(size > 0)
    at = 0
    while len(live):
        left = size[live] - at
        block = eight[starts[live] + at]
        short = np.maximum(8 - left, 0).astype(U64) * U64(8)
        block = (block << short) >> short
        h[live] = join_hash(h[live], block)
        at += 8
        live = live[left > 8]
    return h


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive items (length ``len(h) - k + 1``)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out, width, power, span = None, 0, h, 1
    while True:
        if k & span:
            if out is None:
                out, width = power, span
            else:
                m = min(len(out), len(power) - width)
                out, width = join_hash(out[:m], power[width:width + m]), width + span
        if width == k:
            return out[:n]
        power = join_hash(power[:len(power) - span], power[span:])
        span *= 2


def windows(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first positions of the ``k``-windows that stay in one row."""
    w = window_hashes(h, k)
    if len(w) == 0:
        return w, np.zeros(0, np.int64)
    at = np.flatnonzero(row[:len(w)] == row[k - 1:k - 1 + len(w)])
    return w[at], at


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers give Arrow's free memory back after a task."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


# -- column names ------------------------------------------------------------

_OWN = ("doc_id", "text", "host", "vector")  # parameters that name a column


def sheltered(outputs: Callable[[dict], list[str]] | tuple[str, ...] = ()):
    """For functions of a table that pass its other columns on: no input name can clash.

    Inside, the columns that the parameters name have the parameters' own
    names and all others are called ``col0``, ``col1``, ...; the result has the
    callers' names again.  An input column named like one of ``outputs`` (a
    function of the arguments, or a tuple) is dropped.
    """
    def deco(fn: Callable) -> Callable:
        signature = inspect.signature(fn)

        @functools.wraps(fn)
        def run(*args, **kw) -> DataFrame:
            bound = signature.bind(*args, **kw)
            bound.apply_defaults()
            given = bound.arguments
            df = given["df"]
            made = set(outputs(given) if callable(outputs) else outputs)
            own = {given[p]: p for p in _OWN if p in given}
            inside = [own.get(c, f"col{i}") for i, c in enumerate(df.columns)]
            back = dict(zip(inside, df.columns))
            given["df"] = df.toDF(*inside).drop(*[n for n, c in back.items() if c in made and c not in own])
            for p in own.values():
                given[p] = p
            out = fn(*bound.args, **bound.kwargs)
            return out.toDF(*[back.get(c, c) for c in out.columns])
        return run
    return deco
