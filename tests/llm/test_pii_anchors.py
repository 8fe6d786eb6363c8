"""Anchor expansion against the base patterns applied by brute force."""

import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from civicflow.llm.pii_anchors import BASE, find, redact, redact_texts, spans
from civicflow.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def ok(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        total = 0
        for i, c in enumerate(reversed(digits)):
            d = int(c) * (1 + i % 2)
            total += d - 9 * (d > 9)
        return 16 <= len(digits) <= 19 and total % 10 == 0
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return True


def brute(text):
    return [(k, m.start(), m.end()) for k in BASE for m in re.finditer(PATTERNS[k], text) if ok(k, m.group())]


def base(text):
    return [s for s in spans(text) if s[0] in BASE]


ODD = ["a@b.c", "a@b@c.d", "a@b.c@d.e", "x.@-.-", "@a.b", "a@b..c", "1.2.3.4.5", "1.2.3.4.5.6.7.8", "01.002.003.255 256.1.1.1",
       "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111 1111 1111 1111", "+1 (017) 555-7713.", "+1", "+12", "+1 2", "+1()", "+1 2 3 4 5 6 7 8)",
       "++12345678", "+1+12345678", "é@é.é ñ.a@b.co", "tel +49 30 1234567 and 10.0.0.1:80", "0" * 40, "1.1.1.1.", "1.1.1", "9-9 9", "a@b.c.d.",
       "1.2.3.99999999999999999999", "a+b@c-d.e-f", "+0000000000000000000", "٣@a.b ４１１１"]


def test_odd_texts():
    for t in ODD:
        assert base(t) == brute(t), t


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet=st.sampled_from("a@.+-_ %()0123456789é\n"), max_size=40))
def test_random_texts(t):
    assert base(t) == brute(t)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("4015-2 "), min_size=16, max_size=40))
def test_random_digits(t):
    assert base(t) == brute(t)


def test_added_kinds():
    text = ('see https://joe:pw123@host.example/x, or http://10.1.2.3/a. Ask @joe_doe (not me@x.org). IBAN: DE89 3704 0044 0532 0130 00! '
            'IBAN DE88370400440532013000. account no: 12345678; token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" token of love password: hunter')
    got = {(k, text[a:b]) for k, a, b in spans(text) if k not in BASE}
    assert got == {("url", "https://joe:pw123@host.example/x"), ("url", "http://10.1.2.3/a"), ("handle", "@joe_doe"),
                   ("iban", "DE89 3704 0044 0532 0130 00"), ("account", "12345678"),
                   ("secret", "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda")}
    clean = redact(text, spans(text))
    assert "DE89" not in clean and "joe" not in clean and "<SECRET>" in clean and "token of love" in clean
    assert spans("plain prose without any of it") == [] == spans(None)


def plain_url(text, start, after):
    """The rule for one scheme, read on its own."""
    end = after
    while end < len(text) and not text[end].isspace() and text[end] not in "\"'<>()[]{}|":
        end += 1
    while end > after and text[end - 1] in ".,;:!?":
        end -= 1
    user, sign, name = re.split("[/?#]", text[after:end])[0].rpartition("@")
    parts = name.split(":")[0].split(".")
    numeric = len(parts) == 4 and all(re.fullmatch("[0-9]+", x) and int(x) <= 255 for x in parts)
    return (start, end) if (sign and user and name) or numeric else None


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.sampled_from(["http://", "ftp://", "a", "@", ".", "1.2.3.4", ":", "/", "?", " ", ",", "\u2003", "'", "1"]), max_size=14).map("".join))
def test_random_urls(t):
    want, done = [], 0
    for m in re.finditer("http://|ftp://", t):
        span = plain_url(t, m.start(), m.end())
        if span and span[0] >= done:
            want.append(("url", *span))
            done = span[1]
    assert [s for s in spans(t) if s[0] == "url"] == want


@pytest.mark.parametrize("unit", ["http://", "https://a.", "http://a@", "http://1.2.3.4/", "http://...", "a@", "@", "@ab ", "x@y.", "+1", "+1 (", "1 ", "1.", "1-",
                                  "IBAN ", "IBAN DE89 ", "IBANDE", "account: 1 ", "account ", "account no ", "token=", "token = a1", "token:a.b/",
                                  "secret is ", "a.@", "..", "9" * 7, "(+1)", "api_key==="])
def test_time_grows_with_the_text(unit):
    """Four times the text takes about four times as long, whatever anchor it repeats."""
    times = []
    for n in (10_000, 40_000):
        t = unit * n
        start = time.process_time()
        spans(t)
        times.append(time.process_time() - start)
    assert times[1] < 8 * max(times[0], 0.05)


def test_many_schemes_in_one_run():
    start = time.process_time()
    assert spans("http://" * 200_000) == []
    assert time.process_time() - start < 4


def test_table(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op3_pii_anchors"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    total = 0
    for d in docs:
        want = brute(d.text or "")
        total += len(want)
        r = got[d.doc_id]
        assert [getattr(r, f"n_{k}") for k in BASE] == [sum(s[0] == k for s in want) for k in BASE]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
    assert total > 50


def test_nulls_and_extra_columns(spark):
    rows = [(1, None, 9), (1, None, 9), (2, "", 9), (None, "x a@b.co y", 9), (3, "z" * 300_000 + " 1.2.3.4", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    out = find(df).collect()
    assert sorted((str(r.doc_id), r.spans) for r in out) == [("1", ""), ("1", ""), ("2", ""), ("3", "ip:300001:300008"), ("None", "email:2:8")]
    red = redact_texts(df)
    assert red.columns == df.columns
    assert {r.doc_id: r.text for r in red.collect()}[None] == "x <EMAIL> y"
    assert find(df.limit(0)).collect() == [] == redact_texts(df.limit(0)).collect()
