"""Prefix encoding against the tiktoken and tokenizers libraries."""

import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from civicflow.llm.bpe_prefix import PrefixBPE, PrefixTable, encode
from civicflow.llm.common import utf8
from civicflow.llm.packing import _row_ids
from civicflow.llm.pieces import PieceCache, read_ranks, split

MULTI = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = read_ranks(MULTI)
BPE = PrefixBPE(RANKS)
LIB = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = ["", " ", "\n", "a", "'s", "it's we'll they've I'd'm 're''s \n's", "  two  spaces\n\n  x \t", "x  ", " x  y　",
       "naïve déjà vu ÀÉ", "日本語 テスト 123 ٣٤", "😀 emoji👩‍👩‍👧 ok", "a\x1cb\x1fc\x85d", "<|endoftext|> z", "aaaa" * 500, "!!!??!'s'tx",
       " 's", "x's", "\t'll go", "¼½ Ⅷ x²", "'", "''", "'r", "é x", "​​", "0" * 3000]


def ids_of(texts):
    data, offsets = utf8(pa.array(texts))
    ids, bounds = PieceCache(BPE.encode_pieces).ids(data, offsets)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_ids_equal_the_library():
    assert ids_of(ODD) == [LIB.encode_ordinary(t) for t in ODD]
    for t in ODD:
        assert BPE.decode(LIB.encode_ordinary(t)) == t.encode()


def test_split_classes_equal_the_library():
    """Every code point between letters, digits and spaces."""
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000][::37] + list(range(1, 0x3100))
    texts = [f"a{chr(c)}b1{chr(c)}2 {chr(c)}" for c in points]
    data, offsets = utf8(pa.array(texts))
    got = ids_of(texts)
    want = LIB.encode_ordinary_batch(texts, num_threads=4)
    assert [chr(c) for c, a, b in zip(points, got, want) if a != b] == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'stlé \n\t1,! 日😀"), max_size=30), min_size=1, max_size=5))
def test_random_texts(texts):
    assert ids_of(texts) == [LIB.encode_ordinary(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=40), st.integers(0, 40), st.integers(0, 40), st.binary(max_size=10), st.binary(max_size=10))
def test_table_appends_and_edits(raw, lo, hi, new, tail):
    lo, hi = sorted((min(lo, len(raw)), min(hi, len(raw))))
    table = PrefixTable(BPE, raw)
    assert table.ids() == BPE.merge(raw)
    table.append(tail)
    assert table.ids() == BPE.merge(raw + tail)
    table.replace(lo, hi, new)
    assert table.raw == raw[:lo] + new + raw[hi:] + tail
    assert table.ids() == BPE.merge(table.raw)


def test_edit_refills_only_near_it():
    raw = bytes(random.Random(1).choices(b"etaoin shr", k=3000))
    table = PrefixTable(BPE, raw)
    assert table.replace(100, 103, b"zz") < 1000
    assert table.ids() == PrefixTable(BPE, table.raw).ids()


def test_small_piece_cache_gives_the_same():
    texts = ["one two three four", "five six one two"] * 5
    data, offsets = utf8(pa.array(texts))
    a = PieceCache(BPE.encode_pieces, limit=2).ids(data, offsets)[0]
    assert a.tolist() == [i for t in texts for i in LIB.encode_ordinary(t)]


def counted(limit=None):
    seen = []

    def encode(pieces):
        seen.extend(pieces)
        return BPE.encode_pieces(pieces)
    return PieceCache(encode, *[limit] * (limit is not None)), seen


def test_full_cache_keeps_the_pieces_in_use():
    cache, seen = counted(64)
    for i in range(200):
        text = " the of and" + "".join(f" {c}{'xyz'[i % 3]}{'q' * (i % 11)}{'j' * (i // 11)}" for c in "abcdefg")
        data, offsets = utf8(pa.array([text]))
        assert cache.ids(data, offsets)[0].tolist() == LIB.encode_ordinary(text)
    assert len(cache.keys) <= 64
    assert [seen.count(p) for p in (b" the", b" of", b" and")] == [1, 1, 1]


def test_long_pieces_fill_the_cache_by_their_ids():
    cache, _ = counted(8)
    for i in range(1, 60):
        text = "ab" * (7 * i) + " x"
        data, offsets = utf8(pa.array([text]))
        assert cache.ids(data, offsets)[0].tolist() == LIB.encode_ordinary(text)
        assert cache.bounds[len(cache.keys)] <= 8 * 8


def test_cache_holds_the_words_of_a_large_table():
    """300,000 different pieces, twice: none is encoded again."""
    made = []

    def encode(pieces):
        made.append(len(pieces))
        return [(len(p),) for p in pieces]
    cache = PieceCache(encode)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for _ in range(2):
        for a in letters[:18]:
            text = "".join(f" {a}{b}{c}{d}" for b in letters for c in letters for d in letters[:25])
            data, offsets = utf8(pa.array([text]))
            ids, bounds = cache.ids(data, offsets)
            assert len(ids) == 26 * 26 * 25 and set(ids.tolist()) == {5}
    assert sum(made) == 18 * 26 * 26 * 25


def test_tokenizers_rows_with_added_tokens():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    data, offsets = utf8(pa.array(ODD))
    got = _row_ids(P.path("byte_bpe_50k.json"), data, offsets)
    assert [g.tolist() for g in got] == [tok.encode(t, add_special_tokens=False).ids for t in ODD]


def test_query_columns_nulls_and_extra_columns(spark):
    rows = [(i, t, 7) for i, t in enumerate(ODD)] + [(100, None, 1), (None, "x y", 2), (1, ODD[1], 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = encode(df, MULTI, with_ids=True).collect()
    assert len(out) == len(rows)
    want = sorted((str(d), hashlib.sha256(",".join(map(str, LIB.encode_ordinary(t or ""))).encode()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for d, t, _ in rows)
    assert sorted((str(r.doc_id), r.ids_sha256, r.decoded_sha256) for r in out) == want
    assert encode(df.limit(0), MULTI).collect() == []


def test_query_on_the_table(spark):
    from civicflow.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op4_bpe_prefix"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = LIB.encode_ordinary(r.text or "")
        g = got[r.doc_id]
        assert g.n_tokens == len(ids)
        assert g.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
