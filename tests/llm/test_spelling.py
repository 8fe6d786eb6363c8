"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from civicflow.llm.q_spelling import crc32_runs, drop_letters
from civicflow.llm.spelling import OUT, count_words, decompose, follow, group_variants, near_pairs, probes

SF = "/root/testdata/sf0.01"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_counts(rows, every=199):
    out = Counter()
    for doc, text in rows:
        for word in RUN.findall(text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if every and h % every == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1:]
            out[word] += 1
    return out


def brute(counts, least=6, often=5, ratio=5):
    """Near words by deletions: equal after none or one on each side at the same place."""
    n = {w: k for w, k in counts.items() if len(w) >= least and k >= often}
    near = defaultdict(set)
    holes = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            less = w[:i] + w[i + 1:]
            if less in n:
                near[w].add(less)
                near[less].add(w)
            holes[i, less].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, found in near.items():
        if found:
            best = min(found, key=lambda v: (-n[v], v))
            if n[best] >= ratio * n[w]:
                form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def rows_of(df):
    got = {r["word"]: tuple(r[c] for c in OUT) for r in df.collect()}
    return got


def counts_frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    from civicflow.llm.queries import QUERIES
    df = QUERIES["op12_spelling"](spark, f"/root/testdata/{sf}")
    assert df.columns == ["word", *OUT]
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute(brute_counts([tuple(r) for r in docs]))
    assert rows_of(df) == want


def edits(word, rnd, letters):
    k, c = rnd.randrange(len(word) + 1), rnd.choice(letters)
    return rnd.choice([word[:k] + c + word[k:], word[:k] + word[k + 1:], word[:k] + c + word[k + 1:]])


@pytest.mark.parametrize("prune", [0, 3, 10 ** 9])
def test_dense_words_against_all_pairs(spark, prune):
    """Few letters, so that grams are shared by nearly all words; every class and both kinds of grams."""
    rnd = random.Random(prune)
    counts = Counter()
    for size in [6] * 150 + [7] * 150 + [8, 9, 10, 13, 17, 18, 30] * 12 + [63, 64, 65, 66, 67, 200, 201] * 4:
        word = "".join(rnd.choice("abcé") for _ in range(size))
        for _ in range(4):
            counts[word] += rnd.choice([5, 30, 200])
            word = edits(word, rnd, "abcé")
    got = rows_of(group_variants(counts_frame(spark, counts), prune=prune))
    assert got == brute(counts)
    assert sum(v[3] > 0 for v in got.values()) > 300


def test_hot_lists_are_split(spark):
    """A third of all words share their first and last signs; blocks of 7 words lose no pair."""
    rnd = random.Random(8)
    words = {"pre" + "".join(rnd.choice("ab") for _ in range(7)) + "ing" for _ in range(90)}
    words |= {"".join(rnd.choice("abcdefgh") for _ in range(9)) for _ in range(150)}
    df = spark.createDataFrame([(w, 9, len(w)) for w in words], "word string, n long, size int")
    got = [(r.a, r.b) for r in near_pairs(df, probe_block=7, list_block=11).collect()]
    assert len(got) == len(set(map(frozenset, got)))
    near = brute(dict.fromkeys(words, 9))
    assert Counter(w for p in got for w in p) == Counter({w: v[3] for w, v in near.items() if v[3]})


def test_following_a_long_chain(spark):
    chain = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(25)] + [(f"x{i}", "w03") for i in range(40)]
    got = dict(map(tuple, follow(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert got == {w: "w25" for w, _ in chain}
    assert follow(spark.createDataFrame([], "word string, form string")).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab", min_size=6, max_size=20), st.data())
def test_one_of_the_two_grams_survives_every_edit(word, data):
    """Over a random dictionary: the probing grams of a word stand in every word one edit away."""
    q = data.draw(st.integers(3, min(len(word) // 2, 8)))
    longer = data.draw(st.sets(st.text(alphabet="ab", min_size=3, max_size=q), max_size=30))
    known = {w[:k] for w in longer for k in range(3, len(w) + 1) if k <= q}

    def grams(w):
        """Read plainly: the longest gram at each place, unless an earlier one covers it."""
        out, reach = [], -1
        for p in range(len(w) - 1):
            k = max(k for k in range(2, q + 1) if p + k <= len(w) and (k == 2 or w[p:p + k] in known))
            if p + k > reach:
                out.append((p, k))
                reach = p + k
        return out

    own = grams(word)
    spots = np.array([(p, k) for p in range(len(word)) for k in range(2, q + 1)
                      if p + k <= len(word) and (k == 2 or word[p:p + k] in known)])
    both = np.vstack([spots, spots])[np.random.default_rng(1).permutation(2 * len(spots))]
    two = np.repeat([0, 1], len(spots))[np.random.default_rng(1).permutation(2 * len(spots))]
    chosen = decompose(two, both[:, 0], both[:, 1])
    assert [tuple(x) for x in both[chosen].tolist()] == own + own
    p, e = both[chosen][:, 0], both[chosen].sum(axis=1)
    f = np.array([data.draw(st.integers(1, 9)) for _ in chosen])
    lefts, rights = probes(two[chosen], p, e, f, np.full(len(p), q))
    assert two[chosen][lefts].tolist() == two[chosen][rights].tolist() == [0, 1]
    for x, y in zip(lefts, rights):
        cheapest = min(f[i] + f[j] for i in range(len(p)) for j in range(len(p))
                       if two[chosen][i] == two[chosen][j] == two[chosen][x] and e[j] - p[i] >= 2 * q)
        assert f[x] + f[y] == cheapest and e[y] - p[x] >= 2 * q
    a, b = int(lefts[0]), int(rights[0])
    left = (word[own[a][0]:][:own[a][1]], own[a][0])
    right = (word[own[b][0]:][:own[b][1]], len(word) - own[b][0] - own[b][1])
    for i in range(len(word) + 1):
        for new in {word[:i] + c + word[j:] for c in ("", "a", "b", "z") for j in (i, i + 1) if j <= len(word)} - {word}:
            if len(new) < len(word):  # probed from the shorter word only
                continue
            found = [(new[p:p + k], p, len(new) - p - k) for p, k in grams(new)]
            assert any((g, p) == left for g, p, _ in found) or any((g, e) == right for g, _, e in found)


def test_words_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (None, "Straße ÉCLAIR naïveté × ÷ x×y 日本 a1b"), (3, "abcdef" * 30_000 + " Ω Ābc ÿÿÿ"), (3, "same same"), (3, "same same")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(map(tuple, count_words(df, key="doc_id", edit=drop_letters).collect()))
    assert got == {w: n for w, n in brute_counts(rows).items() if w or n}
    assert dict(map(tuple, count_words(df).collect())) == brute_counts(rows, every=0)
    assert group_variants(count_words(df.limit(0))).collect() == []


def test_checksums():
    spans = [b"", b"a", b"12:stra\xc3\x9fe", b"x" * 300]
    data = np.frombuffer(b"".join(spans), np.uint8)
    ends = np.cumsum([len(s) for s in spans])
    got = ~crc32_runs(np.full(len(spans), 0xFFFFFFFF, np.uint32), data, ends - [len(s) for s in spans], ends)
    assert got.tolist() == [zlib.crc32(s) for s in spans]


def test_short_words_are_refused(spark):
    with pytest.raises(ValueError):
        group_variants(counts_frame(spark, {"abc": 9}), min_length=3)
