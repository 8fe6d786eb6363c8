"""Deterministic sharded WARC writer and its reader.

Pages are range-sorted: ranges of consecutive page ids are shards, and a shard
is written in order of page id.  Files roll by compressed size.  Headers and
digests are made from the rows alone, every record is a gzip member of its own
without a time stamp, and file names follow from shard and position, so the
same pages give the same bytes, whatever was retried.

A task writes under temporary names that no other attempt uses and reports its
files as rows.  Spark commits exactly one attempt's rows; a second job renames
those files (a repeated rename does nothing) and writes the manifest.

Of pages with equal payloads of at least ``min_bytes``, the one with the
smallest page_id is a response and the others revisit it.

Defined cases: a null html is an empty payload; a null url becomes a URN; a
null page_id has no id header, sorts first and is never referred to; ids are
integers of up to 64 bits; other columns are not read; rows with
the smallest page_id of their payload are all responses; an empty table gives
no files.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, shared_folder, write_out
from .id_ranges import id_ranges

MIN_BYTES = 100
SHARD_ROWS = 2048
ROLL_BYTES = 8 << 20
DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "name string, temporary string, records bigint, bytes bigint, sha256 string"


# -- records -------------------------------------------------------------------

def _headers(pairs: list[tuple[str, str | None]]) -> bytes:
    lines = [f"{k}: {v}" for k, v in pairs if v is not None]
    return ("\r\n".join(["WARC/1.1", *lines]) + "\r\n\r\n").encode("utf-8")


def _one_line(value: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else "%%%02X" % ord(c) for c in value)


def record_id(page_id: int | None, digest: str, again: int = 0) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}{f':{again}' if again else ''}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           again: int = 0, date: str = DATE) -> bytes:
    """One record, not compressed.  A revisit has the HTTP headers without the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    name = record_id(page_id, digest, again)
    return _headers([
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", name),
        ("WARC-Target-URI", name[1:-1] if url is None else _one_line(url)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Profile", REVISIT_PROFILE if refers_to is not None else None),
        ("WARC-Refers-To", record_id(refers_to, digest) if refers_to is not None else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block)))]) + block + b"\r\n\r\n"


def info_record(name: str, date: str = DATE) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return _headers([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-file:{name}>"), ("WARC-Filename", name),
                     ("WARC-Date", date), ("Content-Type", "application/warc-fields"),
                     ("Content-Length", str(len(block)))]) + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    """A gzip member without a time stamp."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


# -- writing -------------------------------------------------------------------

class _Shard:
    """Open file of a shard; rolls by compressed size."""

    def __init__(self, where: pafs.FileSystem, folder: str, shard: int, roll_bytes: int):
        self.where, self.folder, self.shard, self.roll_bytes = where, folder, shard, roll_bytes
        self.part, self.out, self.done = 0, None, []

    def add(self, raw: bytes) -> None:
        if self.out is None:
            self.name = f"shard-{self.shard:012d}-{self.part:05d}.warc.gz"
            self.temporary = f"_temporary/{uuid.uuid4().hex}-{self.name}"
            self.out = self.where.open_output_stream(f"{self.folder}/{self.temporary}", compression=None)
            self.sha, self.size, self.records = hashlib.sha256(), 0, 0
            self._put(info_record(self.name))
        self._put(raw)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _put(self, raw: bytes) -> None:
        packed = member(raw)
        self.out.write(packed)
        self.sha.update(packed)
        self.size += len(packed)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.temporary, self.records, self.size, self.sha.hexdigest()))
            self.part, self.out = self.part + 1, None


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    cols = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                      names=["name", "temporary", "records", "bytes", "sha256"])


def _writer(folder_uri: str, roll_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, folder = pafs.FileSystem.from_uri(folder_uri)
        shard = told = last = None
        again = 0
        for batch in batches:
            for row in batch.to_pylist():
                if shard is None or shard.shard != row["shard"]:
                    if shard is not None:
                        shard.close()
                        yield _manifest_batch(shard.done)
                    shard = _Shard(where, folder, row["shard"], roll_bytes)
                key = (row["page_id"], row["digest"])
                if row["kind"] == 0:  # a revisit's target, right before the page itself
                    told = (key, row["refers_to"])
                    continue
                again = again + 1 if key == last else 0
                last = key
                shard.add(record(row["page_id"], row["url"], (row["html"] or "").encode("utf-8"), row["digest"],
                                 told[1] if told is not None and told[0] == key else None, again))
        if shard is not None:
            shard.close()
            yield _manifest_batch(shard.done)
    return run


def revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that revisit an earlier equal payload."""
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    own = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.sha2(body, 256).alias("digest"),
                       F.octet_length(body).alias("size")).filter(F.col("size") >= min_bytes)
    first = own.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    first = first.filter((F.col("n") > 1) & F.col("refers_to").isNotNull()).drop("n")
    joined = own.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return joined.select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = MIN_BYTES, shard_rows: int = SHARD_ROWS, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes ``folder``/shard-*.warc.gz and returns the committed manifest.

    Bodies are shuffled once.  Shards are ranges of ids cut where the pages
    are, of about ``shard_rows`` pages each; those without an id are dealt to
    shards of their own by digest.
    """
    spark = pages.sparkSession
    where, path = pafs.FileSystem.from_uri(folder)
    where.create_dir(f"{path}/_temporary", recursive=True)
    key = F.col(f"`{page_id}`").cast("long")
    ranges = id_ranges(pages, key, shard_rows)
    shard = ranges.number(F.col("page_id"), F.col("digest"))
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    rows = pages.select(key.alias("page_id"), F.sha2(body, 256).alias("digest"), F.lit(1).alias("kind"),
                        F.lit(None).cast("long").alias("refers_to"), F.col(f"`{url}`").alias("url"),
                        F.col(f"`{html}`").alias("html"))
    told = revisits(pages, page_id, html, min_bytes).select(
        "page_id", "digest", F.lit(0).alias("kind"), "refers_to",
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
    dealt = rows.unionByName(told).withColumn("shard", shard)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "shard").sortWithinPartitions(
        "shard", F.col("page_id").asc_nulls_first(), "digest", "kind", "url")
    return _commit(write_out(map_arrow(dealt, _writer(folder, roll_bytes), MANIFEST), "warc-files"), folder)


def _commit(files: DataFrame, folder: str) -> DataFrame:
    """Renames the files of the committed attempts, writes the manifest, drops what is left."""
    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                target = f"{path}/{row['name']}"
                if where.get_file_info(target).type == pafs.FileType.NotFound:
                    where.move(f"{path}/{row['temporary']}", target)
            yield batch

    target = f"{folder.rstrip('/')}/_manifest"
    map_arrow(files, rename, MANIFEST).drop("temporary").write.json(target)
    where, path = pafs.FileSystem.from_uri(folder)
    where.delete_dir(f"{path}/_temporary")
    return files.sparkSession.read.schema("name string, records bigint, bytes bigint, sha256 string").json(target)


# -- reading -------------------------------------------------------------------

def parse(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive."""
    f = gzip.GzipFile(fileobj=io.BytesIO(raw))
    while True:
        line = f.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        head = {}
        while (line := f.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode("utf-8").partition(":")
            head[k.strip().lower()] = v.strip()
        block = f.read(int(head["content-length"]))
        if f.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield head, block


def _page_of(name: str) -> int | None:
    text = name.removeprefix("<urn:x-page:").split(":")[0]
    return int(text) if text else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    for batch in batches:
        for i in range(batch.num_rows):
            rows = []
            for head, block in parse(batch.column(0)[i].as_py()):
                kind = head["warc-type"]
                if kind == "warcinfo":
                    continue
                if head["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                    raise ValueError(f"block digest of {head['warc-record-id']} differs")
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.lower().rpartition(b"content-length:")[2].split(b"\r\n")[0])
                digest = head["warc-payload-digest"].removeprefix("sha256:")
                if kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
                    raise ValueError(f"payload of {head['warc-record-id']} differs")
                own = _page_of(head["warc-record-id"])
                uri = head["warc-target-uri"]
                rows.append((own, None if uri.startswith("urn:x-page:") else uri, size, digest, kind,
                             _page_of(head["warc-refers-to"]) if kind == "revisit" else None,
                             payload.decode("utf-8") if kind == "response" else None))
            cols = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every page record of a folder's archives, digests checked.

    A revisit's payload is null; its size and digest are the full payload's.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("content")
    return map_arrow(files, _read, "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
                                   "record_type string, refers_to bigint, payload string")


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives under the shared folder."""
    return shared_folder(spark, "warc")
