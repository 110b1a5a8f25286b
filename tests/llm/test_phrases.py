"""Phrases against counting every n-gram of every piece."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from demandspark.llm import phrases

FORM = "doc_id long, text string, lang string, phrase string"


def counted(rows):
    f = Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            for i in range(len(w)):
                for k in range(1, 5):
                    if i + k <= len(w):
                        f[lang, tuple(w[i : i + k])] += 1
    return f


def brute(rows, least=30, top=2000, inside=80):
    f, n = counted(rows), Counter()
    for (lang, w), a in f.items():
        n[lang] += a * (len(w) == 1)
    found = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    longer = defaultdict(int)
    for (lang, w), a in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longer[lang, w[i : i + k]] = max(longer[lang, w[i : i + k]], a)
    best = defaultdict(list)
    for (lang, w), a in found.items():
        if 100 * longer[lang, w] >= inside * a:
            continue
        score, _, left, right = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        best[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, x in best.items() for i, (s, a, p, left, right) in enumerate(sorted(x)[:top], 1))


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    words = [f"w{i}" for i in range(12)] + ["Über", "ÀB", "the", "THE", " x", "naïve", "z　z", "漢"]
    joints = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; ", "\x0b", "\r\n", "!?"]
    fixed = ["once upon a time", "New York city hall", "a a a a a a", "b a b a b"]
    say = lambda n: "".join(x for _ in range(n) for x in ((r.choice(fixed) if r.random() < 0.2 else r.choice(words)), r.choice(joints)))
    out = [(i, say(r.randrange(1, 90)), r.choice(["en", "en", "de", None, "und", "t\tab"]), "x") for i in range(220)]
    return out + [(None, None, "en", "x"), (1, "", None, "x"), (1, "same text here " * 40, "fr", "x"), (1, "same text here " * 40, "fr", "x"), (2, "w1" * 50_000, "de", "x"), (3, " ".join(["very long text of one piece"] * 4000), "es", "x"), (4, ".,;", "it", "x")]


def test_equals_counting_all_ngrams(spark, rows):
    docs = spark.createDataFrame(rows, FORM).repartition(3)
    want = brute(rows)
    assert {x[0] for x in want} == {"en", "de", "und", "fr", "es", "t\tab"} and any(len(x[2].split()) == 4 for x in want)
    assert got(phrases.collocations(docs)) == want
    assert got(phrases.collocations(docs, least=5, top=7, inside_percent=60)) == brute(rows, 5, 7, 60)
    assert got(phrases.collocations(docs, least=300)) == brute(rows, 300)
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_counts_hold_whatever_is_cut_or_dealt_out(spark, rows, monkeypatch):
    """All words colliding with frequent ones; all words common, so that each pair is dealt out; small slices."""
    docs = spark.createDataFrame(rows[:80], FORM)
    want = brute(rows[:80], 10)
    hashes = np.unique(np.concatenate([s.hashes for s in phrases.joined_slices(docs.select("text", "lang").toArrow().to_batches())]))
    bits, hot, total = phrases.frequent(docs.select("text", "lang"), 40)
    assert 0 < np.unpackbits(bits).sum() < len(hashes) and 0 < len(hot) < 1000 and total == sum(n for (_, w), n in counted(rows[:80]).items() if len(w) == 1)
    monkeypatch.setattr(phrases, "frequent", lambda docs, least: (np.full(phrases.BITS // 8, 255, dtype=np.uint8), hashes, 10**7))
    assert got(phrases.collocations(docs, least=10)) == want


def test_packed_windows_come_back_as_they_were():
    r = np.random.default_rng(1)
    for m, k in ((0, 4), (1, 4), (500, 4), (500, 1 << 17)):
        codes = r.integers(0, k + 1, (4, m))
        codes[0].sort()
        w = phrases.Windows(pa.array([f"漢字{i}\ten" for i in range(k)], pa.large_string()), codes, r.integers(1, 10**9, m), r.integers(0, 2, m))
        got = phrases.Windows.unpack(w.pack())
        assert got.keys.equals(w.keys) and (got.codes == w.codes).all() and (got.n == w.n).all() and (got.dealt == w.dealt).all()


def test_scores_of_counts_beyond_64_bits(spark):
    """The products of the score need over 64 bits for counts from 5e12 on."""
    from pyspark.sql import functions as F

    a, l, r = 6 * 10**12 + 1, 7 * 10**12, 8 * 10**12 + 3
    row = spark.range(1).select(F.lit(a).alias("a"), F.lit(l).alias("l"), F.lit(r).alias("r")).select(phrases.score_of()).first()
    assert row[0] == 2_000_000 * a // (l + r)
