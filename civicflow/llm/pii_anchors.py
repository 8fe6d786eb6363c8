"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass: at-signs,
plus signs, digits, URL schemes and identifier cues.  Deterministic local
parsers then expand each anchor to its boundaries and validate the span:

* email: local part and dotted domain around an at-sign;
* ip: four numbers of at most 255 in a chain of digits and points;
* card: 16 to 19 digits with single spaces or hyphens, passing Luhn;
* phone: a plus sign and 8 to 15 digits with the usual punctuation;
* url: ``scheme://`` with user data (``user:secret@host``) or a numeric host;
* handle: ``@name`` account, at least three characters, after no word sign;
* iban: two letters, two check digits and 11 to 30 letters or digits after
  the cue IBAN, passing mod 97;
* account: a number of at least 6 digits after an account cue;
* secret: a quoted or bare value of at least 16 letters and digits (with some
  of both) after a cue such as ``token =`` or ``password:``.

The first four kinds are the base kinds: leftmost, not overlapping within
their kind.  The others add spans.  Positions count code points.

Defined cases: a null text has no spans and stays null; repeated rows are
treated alike; columns other than the text are passed through; texts are read
whole.  No shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, sheltered, text_chunks

BASE = ("email", "ip", "card", "phone")
EXTRA = ("url", "handle", "iban", "account", "secret")
KINDS = BASE + EXTRA

# The anchors' cues.
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "ssh://", "postgres://", "postgresql://", "mysql://", "mongodb://", "redis://")
IBAN_CUES = ("IBAN", "Iban", "iban")
ACCOUNT_CUES = ("account", "Account", "ACCOUNT", "acct", "Acct", "ACCT", "konto", "Konto", "compte", "Compte", "cuenta", "Cuenta")
SECRET_CUES = ("token", "Token", "TOKEN", "secret", "Secret", "SECRET", "password", "Password", "PASSWORD", "api_key", "API_KEY",
               "apikey", "api-key", "access_key", "ACCESS_KEY")
DIGITS = frozenset("0123456789")
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LOCAL = frozenset(_LETTERS + "0123456789._%+-")
LABEL = frozenset(_LETTERS + "0123456789-")
ALNUM = frozenset(_LETTERS + "0123456789")
NAME = ALNUM | {"_"}
PHONE_FILL = DIGITS | frozenset(" ().-")
URL_STOP = re.compile(r"[\s\"'<>()\[\]{}|]")
HOST_STOP = re.compile("[/?#]")

_MACHINE: list = []


def _machine():
    """The automaton, built once in each worker."""
    if not _MACHINE:
        a = ahocorasick.Automaton()
        for cues, what in ((("@",), "at"), (("+",), "plus"), (DIGITS, "digit"), (SCHEMES, "url"),
                           (IBAN_CUES, "iban"), (ACCOUNT_CUES, "account"), (SECRET_CUES, "secret")):
            for cue in cues:
                a.add_word(cue, (what, len(cue)))
        a.make_automaton()
        _MACHINE.append(a)
    return _MACHINE[0]


# -- parsers: (text, anchor, lower bound) -> end or span ----------------------

def _run(text: str, i: int, allowed: frozenset) -> int:
    n = len(text)
    while i < n and text[i] in allowed:
        i += 1
    return i


def _back(text: str, i: int, allowed: frozenset, floor: int) -> int:
    while i > floor and text[i - 1] in allowed:
        i -= 1
    return i


def domain_end(text: str, i: int) -> int | None:
    """End of a host name with at least two labels that begins at ``i``."""
    end = _run(text, i, LABEL)
    if end == i:
        return None
    labels = 1
    while end < len(text) and text[end] == "." and (nxt := _run(text, end + 1, LABEL)) > end + 1:
        end, labels = nxt, labels + 1
    return end if labels > 1 else None


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = _back(text, at, LOCAL, floor)
    end = domain_end(text, at + 1) if start < at else None
    return None if end is None else (start, end)


def card_chain(text: str, i: int) -> int:
    """End of digits joined by single spaces or hyphens."""
    n = len(text)
    end = i + 1
    while end < n:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in DIGITS:
            end += 2
        else:
            break
    return end


def luhn(digits: list[int]) -> bool:
    twice = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(twice)) % 10 == 0


def is_card(span: str) -> bool:
    digits = [ord(c) - 48 for c in span if c in DIGITS]
    return 16 <= len(digits) <= 19 and luhn(digits)


def ip_chain(text: str, i: int) -> list[tuple[int, int]]:
    """Numbers of a chain joined by single points."""
    parts = [(i, _run(text, i, DIGITS))]
    while (end := parts[-1][1]) + 1 < len(text) and text[end] == "." and text[end + 1] in DIGITS:
        parts.append((end + 1, _run(text, end + 1, DIGITS)))
    return parts


def small(digits: str) -> bool:
    return len(digits.lstrip("0")) <= 3 and int(digits[-3:]) <= 255


def phone_end(text: str, plus: int) -> int | None:
    """End of the number that begins with a plus sign, a digit, one more sign and a digit."""
    if plus + 1 >= len(text) or text[plus + 1] not in DIGITS:
        return None
    end = _run(text, plus + 2, PHONE_FILL)
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return end if end > plus + 3 and text[end - 1] in DIGITS else None


def is_phone(span: str) -> bool:
    return 8 <= sum(c in DIGITS for c in span) <= 15


class UrlRun:
    """Where the run of URL signs around the current anchor ends; found once for all anchors in it."""

    def __init__(self, text: str):
        self.text, self.stop, self.end = text, -1, 0

    def span(self, start: int, after: int) -> tuple[int, int] | None:
        """A URL with user data or a numeric host: up to white space, quotes or brackets."""
        text = self.text
        if after > self.stop:
            found = URL_STOP.search(text, after)
            self.stop = self.end = found.start() if found else len(text)
            while self.end > after and text[self.end - 1] in ".,;:!?":
                self.end -= 1
        end = max(self.end, after)
        cut = HOST_STOP.search(text, after, end)
        user, sign, name = text[after:cut.start() if cut else end].rpartition("@")
        numeric = len(p := name.split(":")[0].split(".", 4)) == 4 and all(x and set(x) <= DIGITS and small(x) for x in p)
        return (start, end) if (sign and user and name) or numeric else None


def handle_span(text: str, at: int) -> tuple[int, int] | None:
    if at and (text[at - 1] in LOCAL or text[at - 1] in "@/:" or text[at - 1].isalnum()):
        return None
    end = _run(text, at + 1, NAME)
    ok = end - at - 1 >= 3 and text[at + 1] not in DIGITS and not (end < len(text) and (text[end] in "@" or text[end].isalnum()))
    return (at, end) if ok else None


def iban_span(text: str, after: int) -> tuple[int, int] | None:
    start = after
    while start < len(text) and start < after + 12 and text[start] in " :#.-=":
        start += 1
    signs, end, i = [], start, start
    while i < len(text) and len(signs) < 34 and (text[i] in ALNUM or (text[i] == " " and i + 1 < len(text) and text[i + 1] in ALNUM)):
        if text[i] != " ":
            signs.append(text[i].upper())
            if len(signs) >= 15 and signs[0].isalpha() and signs[1].isalpha() and signs[2] in DIGITS and signs[3] in DIGITS:
                number = "".join(str(int(c, 36)) for c in signs[4:] + signs[:4])
                if int(number) % 97 == 1 and not (i + 1 < len(text) and text[i + 1] in ALNUM):
                    end = i + 1
        i += 1
    return (start, end) if end > start else None


def _value_start(text: str, after: int, words: tuple[str, ...], most: int) -> int:
    """Skips filler between a cue and its value."""
    i, stop = after, min(len(text), after + most)
    while i < stop:
        if text[i] in " :=#.\"'":
            i += 1
            continue
        word = next((w for w in words if text.startswith(w, i)), None)
        if word is None:
            break
        i += len(word)
    return i


def account_span(text: str, after: int) -> tuple[int, int] | None:
    start = _value_start(text, after, ("number", "Number", "no", "No", "nr", "Nr", "id", "ID", "is"), 24)
    if start == after or start >= len(text) or text[start] not in DIGITS:
        return None
    end = card_chain(text, start)
    return (start, end) if 6 <= sum(c in DIGITS for c in text[start:end]) <= 20 else None


def secret_span(text: str, after: int) -> tuple[int, int] | None:
    start = _value_start(text, after, ("is",), 12)
    if start == after or not set(text[after:start]) & set(":="):
        return None
    end = _run(text, start, NAME | {"-", ".", "/", "+"})
    value = text[start:end]
    ok = len(value) >= 16 and any(c in DIGITS for c in value) and any(c not in DIGITS and c in ALNUM for c in value)
    return (start, end) if ok else None


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans, by kind as in ``KINDS`` and then by start; not overlapping within a kind."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return []
    urls = UrlRun(text)
    done = dict.fromkeys(KINDS, 0)  # where the last match of a kind ended, kept or not

    def add(kind: str, span: tuple[int, int] | None, ok: bool = True) -> None:
        if span is not None and span[0] >= done[kind]:
            done[kind] = span[1]
            if ok:
                found[kind].append(span)

    for last, (what, size) in _machine().iter(text):
        start = last - size + 1
        if what == "digit":
            if start >= done["card"]:
                end = card_chain(text, start)
                if end == start + 1:
                    done["card"] = end
                else:
                    add("card", (start, end), is_card(text[start:end]))
            if start >= done["ip"]:
                parts = ip_chain(text, start)
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i:i + 4]
                    add("ip", (four[0][0], four[3][1]), all(small(text[a:b]) for a, b in four))
                done["ip"] = parts[-1][1]
        elif what == "at":
            add("email", email_at(text, start, done["email"]))
            add("handle", handle_span(text, start))
        elif what == "plus":
            end = phone_end(text, start)
            if end is not None:
                add("phone", (start, end), is_phone(text[start:end]))
        elif what == "url":
            if start >= done["url"]:
                add("url", urls.span(start, last + 1))
        elif what == "iban":
            add("iban", iban_span(text, last + 1))
        elif what == "account":
            add("account", account_span(text, last + 1))
        else:
            add("secret", secret_span(text, last + 1))
    return [(k, a, b) for k in KINDS for a, b in found[k]]


def listed(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def redact(text: str, found: list[tuple[str, int, int]]) -> str:
    """Spans replaced by ``<KIND>``; overlapping spans become the first one's."""
    out, at = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in found):
        if a >= at:
            out.append(text[at:a] + f"<{k.upper()}>")
        at = max(at, b)
    return "".join(out) + text[at:]


# -- tables --------------------------------------------------------------------

FOUND = [f"n_{k}" for k in BASE] + ["base_sha256", "spans"]


@sheltered(tuple(FOUND))
def find(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its texts, plus counts of the base kinds, their digest and all spans.

    An input column named like an output is dropped.
    """
    keep = [c for c in df.columns if c != text and c not in FOUND]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _ in text_chunks(batches, "__text"):
            cols: list[list] = [[] for _ in FOUND]
            for t in part.column(part.num_columns - 1).to_pylist():
                got = spans(t)
                base = [s for s in got if s[0] in BASE]
                for c, k in zip(cols, BASE):
                    c.append(sum(s[0] == k for s in base))
                cols[-2].append(hashlib.sha256(listed(base).encode()).hexdigest())
                cols[-1].append(listed(got))
            yield pa.RecordBatch.from_arrays(
                part.columns[:-1] + [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(c, pa.string()) for c in cols[4:]],
                names=keep + FOUND)

    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
                       + [f"n_{k} bigint" for k in BASE] + ["base_sha256 string, spans string"])
    return map_arrow(src, run, schema)


@sheltered()
def redact_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with personal data in its texts replaced by ``<KIND>``."""
    names = df.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _ in text_chunks(batches, text):
            texts = [t if t is None else redact(t, spans(t)) for t in part.column(at).to_pylist()]
            cols = list(part.columns)
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return map_arrow(df, run, schema)
