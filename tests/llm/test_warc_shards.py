"""WARC round trip, revisits, determinism and commit."""

import glob
import gzip
import hashlib
import os

import oracle_compare
import pytest

from civicflow.llm.queries import QUERIES, SQL
from civicflow.llm.warc_shards import parse, read_archives, write_archives

SF = "/root/testdata/sf0.001"


def files(folder):
    return {os.path.basename(p): hashlib.sha256(open(p, "rb").read()).hexdigest() for p in glob.glob(f"{folder}/*.warc.gz")}


def test_matches_sql(spark, duck):
    res = oracle_compare.compare(QUERIES["op5_warc_shards"](spark, SF), duck, SQL["op5_warc_shards"])
    assert res["status"] == "ok", res


def test_round_trip_roll_and_determinism(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    manifest = write_archives(pages, a, shard_rows=64, roll_bytes=20_000).collect()
    write_archives(pages.repartition(11), f"file://{b}", shard_rows=64, roll_bytes=20_000)
    assert files(a) == files(b) and len(files(a)) > 4
    assert {r.name: r.sha256 for r in manifest} == files(a)
    assert {r.name: r.bytes for r in manifest} == {n: os.path.getsize(f"{a}/{n}") for n in files(a)}
    assert not os.path.exists(f"{a}/_temporary")
    got = {r.page_id: r for r in read_archives(spark, a).collect()}
    for p in pages.collect():
        r = got[p.page_id]
        assert r.url == p.url
        assert r.payload == p.html if r.record_type == "response" else got[r.refers_to].payload == p.html
    heads = [h for n in files(a) for h, _ in parse(open(f"{a}/{n}", "rb").read())]
    assert len({h["warc-record-id"] for h in heads}) == len(heads)


def test_revisits_nulls_and_repeats(spark, tmp_path):
    big, small = "é" * 50, "x" * 99
    rows = [(5, "u5", big), (3, "u3", big), (9, None, big), (9, None, big), (1, "u1", small), (2, "u2", small), (4, "u\r\n4", None),
            (6, "u6", ""), (None, "n", big), (7, "u7", "only\r\n\r\nonce." * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    folder = str(tmp_path / "w")
    write_archives(df, folder)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in read_archives(spark, folder).collect()), key=repr)
    assert got == sorted([(5, "revisit", 3, 100), (3, "response", None, 100), (9, "revisit", 3, 100), (9, "revisit", 3, 100),
                          (1, "response", None, 99), (2, "response", None, 99), (4, "response", None, 0), (6, "response", None, 0),
                          (None, "revisit", 3, 100), (7, "response", None, 1_300_000)], key=repr)
    empty = str(tmp_path / "e")
    assert write_archives(df.limit(0), empty).collect() == []
    assert read_archives(spark, empty).collect() == []


def test_damage_is_noticed(spark, tmp_path):
    folder = str(tmp_path / "d")
    write_archives(spark.createDataFrame([(1, "u", "some text of a page")], "page_id long, url string, html string"), folder)
    (path,) = glob.glob(f"{folder}/*.warc.gz")
    raw = gzip.open(path).read().replace(b"some text", b"some tixt")
    with gzip.open(path, "wb") as f:
        f.write(raw)
    for crc in glob.glob(f"{folder}/.*.crc"):
        os.unlink(crc)
    with pytest.raises(Exception, match="differs"):
        read_archives(spark, folder).collect()
