"""Readers and writers for ticket tables (IO1-IO8).

Parquet is the default format (column pruning and filter push-down reach the
scan); CSV with a header is kept for interchange.  Columns are matched by name
and cast to the declared types; types are never inferred from values.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..session import shared_path


def _ensure_exists(spark: SparkSession, path: str) -> None:
    """``path`` may be a file, a folder or a glob."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.globStatus(jpath):
        raise FileNotFoundError(f"file not found: {path}")


def _by_name(df: DataFrame, schema: T.StructType, path: str) -> DataFrame:
    """Columns found in the file, by name, in their declared types.

    Unknown names and missing required (not nullable) ones raise.
    """
    kinds = {f.name: f.dataType for f in schema.fields}
    if unknown := [c for c in df.columns if c not in kinds]:
        raise ValueError(f"{path}: unknown columns {unknown}")
    if missing := [f.name for f in schema.fields if not f.nullable and f.name not in df.columns]:
        raise ValueError(f"{path}: missing columns {missing}")
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) for c in df.columns])


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """A CSV's columns come as text under the names of its header."""
    _ensure_exists(spark, path)
    return spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet",
             strict_dates: bool = True) -> DataFrame:
    """IO1 + P1: raw tickets; dates parsed to NTZ timestamps.

    Columns are matched by name; optional ones may be absent.  Dates that
    arrive as text: ``strict_dates`` raises on bad text (as the reference's
    parser does), otherwise bad text becomes NULL.
    """
    from ..operators.cleaning import parse_dates
    df = parse_dates(_read(spark, path, fmt), strict=strict_dates)
    return _by_name(df, S.RAW, path)


def read_clean(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """IO2: clean tickets by column name, every column in its declared type."""
    return _by_name(_read(spark, path, fmt), S.CLEAN, path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] | None = None, rebalance: bool = True,
                cluster_by: Sequence[str] | None = None, block_bytes: int | None = None) -> str:
    """IO3 / IO4: overwrite a ticket table.

    A clean table partitioned by ``created_year, created_month`` lets later
    date filters prune whole folders.  Its rows are first dealt out by those
    columns, hot ones to several tasks (a rebalance), so the number of files
    follows the data's size instead of tasks times folders; ``rebalance=False``
    leaves rows that were dealt out before as they are.

    ``cluster_by`` orders the rows inside each file, so that a filter on those
    columns skips the row groups (of ``block_bytes``) and pages whose ranges
    do not hold its value (P17: borough and category).
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    if cluster_by:
        df = df.sortWithinPartitions(*(partition_by or []), *cluster_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if block_bytes:
        w = w.option("parquet.block.size", block_bytes)
    if fmt == "csv":
        w.option("header", True) \
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path)
    else:
        w.parquet(path)
    return path


def write_with_count(df: DataFrame, path: str, fmt: str = "parquet",
                     partition_by: Sequence[str] | None = None) -> int:
    """IO3/IO4 + IO6: write and return the row count from the same job.

    Rows are counted in the stage that writes, after they are dealt out: a
    task before that shuffle may run twice where an executor is lost.
    """
    from pyspark.sql import Observation
    obs = Observation("rows")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, fmt, partition_by, rebalance=False)
    return int(obs.get["rows"])


def load_table(spark: SparkSession, df: DataFrame, name: str = "tickets",
               durable: bool = False, location: str | None = None) -> DataFrame:
    """IO5: register a table under ``name``, replacing any previous one.

    A durable table's files go below ``location`` (default: the shared
    folder).  Every load writes a folder of its own, and the catalog's table is
    pointed at it once the write has succeeded: readers that started before
    keep the old files, and a failed write leaves the table as it was.
    ``drop_old_loads`` removes what no reader needs any more.
    """
    if not durable:
        df.createOrReplaceTempView(name)
        return spark.table(name)
    where = f"{(location or shared_path(spark, f'tables/{name}')).rstrip('/')}/load-{uuid.uuid4().hex}"
    df.write.parquet(where)
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=where, source="parquet")
    elif spark.table(name).schema.jsonValue() == spark.read.parquet(where).schema.jsonValue():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{where}'")
        spark.catalog.refreshTable(name)
    else:  # other columns: the catalog entry itself is made anew, the old files stay
        spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path=where, source="parquet")
    return spark.table(name)


def table_location(spark: SparkSession, name: str) -> str:
    """Folder of the current load of a durable table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def drop_old_loads(spark: SparkSession, name: str) -> list[str]:
    """Removes the folders of earlier loads beside the current one; returns them."""
    jvm = spark.sparkContext._jvm
    current = jvm.org.apache.hadoop.fs.Path(table_location(spark, name))
    fs = current.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(current.getParent()):
        found = status.getPath()
        if found.getName().startswith("load-") and found.getName() != current.getName():
            fs.delete(found, True)
            gone.append(found.toString())
    return gone


def row_count(df: DataFrame) -> DataFrame:
    """IO6: post-load row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def run_sql(spark: SparkSession, text: str, args: Mapping | None = None) -> DataFrame:
    """IO7: parameterised SQL text to a DataFrame."""
    return spark.sql(text, args=dict(args) if args else None)


class ExportError(RuntimeError):
    """Some results could not be written; ``written`` and ``failed`` name them all."""

    def __init__(self, written: dict[str, str], failed: dict[str, str]):
        super().__init__(f"not exported: {failed}")
        self.written, self.failed = written, failed


def export_results(results: Mapping[str, DataFrame | None], out_dir: str,
                   prefix: str = "sql_results", fmt: str = "csv") -> dict[str, str]:
    """IO8: write each named result as ``{prefix}_{name}``.

    Results are per-group aggregates, each written as it is (no collect).  A
    failing one does not stop the others; at the end ``ExportError`` names
    every result that failed or was None.
    """
    written, failed = {}, {}
    for name, df in results.items():
        path = f"{out_dir.rstrip('/')}/{prefix}_{name}"
        if df is None:
            failed[name] = "no result"
            continue
        try:
            written[name] = write_table(df, path, fmt)
        except Exception as exc:  # the rest is written first
            failed[name] = f"{type(exc).__name__}: {exc}"
    if failed:
        raise ExportError(written, failed)
    return written
