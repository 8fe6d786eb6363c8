"""Piece BPE against the sentencepiece library."""

import hashlib
import random

import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from civicflow.llm.common import utf8
from civicflow.llm.piece_bpe import OUT, PieceBPE, WordTable, encode, mark, marked_words

MODEL = P.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=MODEL)
BPE = PieceBPE(MODEL)
SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "   ", "a", " x ", "hello  world", "  a\nb\tc\r\n", "ab▁c", "▁", "▁▁ ▁x", "日本 語é", "a\x00b", "é é ﬁ Ａ",
       "<s> </s> <unk> <0x0A>", "​﻿x", "😀👩‍👩‍👧 ok", " " * 999, "a" * 3000, "ab" * 40 + " " + "the" * 30, "x y z　w", "\U0010ffff"]


def ids_of(texts, **limits):
    data, offsets = utf8(mark(pa.array(texts, pa.string())))
    ids, bounds = WordTable(BPE, **limits).ids(data, offsets)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_ids_equal_the_library():
    assert not BPE.crossing
    assert ids_of(ODD) == [LIB.encode(t or "") for t in ODD]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abethinrs'1 ▁\n\t,!é日😀́\x00"), max_size=40), min_size=1, max_size=5))
def test_random_texts(texts):
    assert ids_of(texts) == [LIB.encode(t) for t in texts]
    assert ids_of(texts, max_words=3) == ids_of(texts, max_bytes=0) == [LIB.encode(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("abethinrsou"), min_size=25, max_size=200))
def test_both_merge_forms_agree(word):
    assert BPE._long(word) == BPE._plain(word)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 300)), max_size=12))
def test_decode_equals_the_library(ids):
    assert BPE.decode(ids) == LIB.decode(ids)


def test_a_word_is_its_marks_and_signs():
    data, offsets = utf8(mark(pa.array(["a  b ", None, "c"])))
    starts, ends = marked_words(data, offsets)
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [b" a", b"  b", b" ", b" c"]
    assert len(marked_words(data, offsets, crossing=True)[0]) == 2


def test_query(spark):
    from civicflow.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op13_piece_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = LIB.encode(d.text or "")
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha(LIB.decode(ids).encode())


@pytest.mark.parametrize("with_ids", [False, True])
def test_nulls_repeats_long_texts_and_clashing_names(spark, with_ids):
    rnd = random.Random(4)
    long = "".join(rnd.choice(["the ", "ab", "é", "  ", "日", "\n"]) for _ in range(200_000))
    texts = ODD + [long, "x" * 100_000, "same", "same"]
    df = spark.createDataFrame([(None if i == 3 else 7, t, i, "u", "v") for i, t in enumerate(texts)],
                               "doc_id long, text string, __text int, ids string, n_tokens string").repartition(3)
    out = encode(df, MODEL, with_ids=with_ids)
    assert out.columns == ["doc_id", "__text"] + ([] if with_ids else ["ids"]) + OUT + ["ids"] * with_ids
    rows = {r["__text"]: r for r in out.collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        ids = LIB.encode(t or "")
        assert rows[i].n_tokens == len(ids) and rows[i].ids_sha256 == sha(",".join(map(str, ids)).encode())
        assert rows[i].decoded_sha256 == sha(LIB.decode(ids).encode())
        assert not with_ids or list(rows[i].ids) == ids
    assert encode(df.limit(0), MODEL).collect() == []
