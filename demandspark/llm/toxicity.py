"""Toxicity by a linear-chain conditional random field over words.

Only documents carry labels, so words are labelled first: parts of words (the word, its first and last letters) that
are found in significantly more toxic than clean documents of the learning folds are markers, and a word of a toxic
document that has a marker is labelled toxic. On lines of such labelled words a two-state chain is trained: weights
of hashed word parts plus transition scores, by gradients from forward-backward. Every line of every document is
then tagged with forward-backward marginals; a logistic curve over the document's largest marginals and their sum
gives the score, and words over one half give the offending offsets.

Learning uses a bounded sample of labelled rows, by parameters: at most ``max_docs`` toxic and twice as many clean
documents, one text of each, the ``max_parts`` parts of words that most toxic ones have as possible markers, and ``max_lines`` lines, chosen
by hash, up to ``max_words`` words; lines of over ``SPAN`` words are learned in overlapping parts, each a line of its own
here. The sample is written once and read by all steps of learning. Scoring reads whole texts and whole lines.

Edge cases: null text counts as empty and is scored; without toxic or clean labels every score is 0 and nothing
offends; null labels, and documents with contradicting ones, teach nothing; repeated rows are scored alike; tables may
be empty; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandspark.llm import store
from demandspark.llm.quality import fold
from demandspark.llm.text import slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BITS = 16
CACHE_WORDS = 300_000
FLUSH_PARTS = 200_000
N_INPUTS = 5
SPAN, OVERLAP = 400, 40


def parts(word: str) -> list[str]:
    """Features of a word: itself, and its first and last letters; marks around it are left out."""
    w = word.lower().strip(".,;:!?\"'()[]{}|*#$%&<>-_")
    if not w:
        return ["#"]
    return ["=" + w] + [f"^{w[:k]}" for k in (4, 5, 6) if len(w) > k] + [f"{w[-k:]}$" for k in (4, 5) if len(w) > k]


def slot(part: str) -> int:
    return zlib.crc32(part.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def tail(k: int, n: int, p: float) -> float:
    """P(X >= k) of a binomial."""
    if k <= n * p:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k, n + 1)]
    return math.fsum(map(math.exp, logs))


def cuts(n: int) -> list[tuple[int, int]]:
    """Parts of a line of ``n`` words, ``SPAN`` words at most and ``OVERLAP`` of them in the next part too: no word is left out."""
    return [(k, min(n, k + SPAN)) for k in range(0, max(1, n - OVERLAP), SPAN - OVERLAP)]


@dataclass
class Chain:
    """Weights by slot, start score and transition scores of two states (0 clean, 1 toxic), and the curve for documents."""

    weights: np.ndarray
    start: float
    steps: np.ndarray
    curve: np.ndarray


def marginals(e: np.ndarray, length: np.ndarray, chain: Chain) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of padded rows of emission scores: P(toxic) of every word, expected transitions, and P(toxic) of first words.

    Messages are kept as the log-odds of state 1, which is enough for two states.
    """
    n, width = e.shape
    t = chain.steps
    ahead = np.zeros((n, width))  # log-odds from the left, own emission included
    ahead[:, 0] = e[:, 0] + chain.start
    move = lambda odds: np.logaddexp(t[0, 1], odds + t[1, 1]) - np.logaddexp(t[0, 0], odds + t[1, 0])
    for k in range(1, width):
        ahead[:, k] = e[:, k] + move(ahead[:, k - 1])
    back = np.zeros((n, width))  # log-odds from the right
    for k in range(width - 2, -1, -1):
        odds = e[:, k + 1] + back[:, k + 1]
        got = np.logaddexp(t[1, 0], odds + t[1, 1]) - np.logaddexp(t[0, 0], odds + t[0, 1])
        back[:, k] = np.where(k + 1 < length, got, 0.0)
    both = ahead + back
    p = 1 / (1 + np.exp(-np.clip(both, -60, 60)))
    p[np.arange(width) >= length[:, None]] = 0
    pairs = np.zeros((2, 2))
    if width > 1:
        inside = np.arange(1, width) < length[:, None]
        left, right = ahead[:, :-1], e[:, 1:] + back[:, 1:]
        s = [[np.full_like(left, t[0, 0]), t[0, 1] + right], [left + t[1, 0], left + t[1, 1] + right]]
        top = np.maximum(np.maximum(s[0][0], s[0][1]), np.maximum(s[1][0], s[1][1]))
        w = [[np.exp(x - top) for x in row] for row in s]
        z = w[0][0] + w[0][1] + w[1][0] + w[1][1]
        pairs = np.array([[(x / z)[inside].sum() for x in row] for row in w])
    return p, pairs, p[:, 0]


def train(lines: list[tuple[list[list[int]], list[int]]], epochs: int = 4, batch: int = 128, rate: float = 0.3, decay: float = 1e-3, seed: int = 0) -> Chain:
    """Maximise the conditional likelihood of labelled lines by adaptive gradient steps."""
    chain = Chain(np.zeros(1 << BITS), 0.0, np.zeros((2, 2)), np.zeros(N_INPUTS))
    seen_w, seen_t, seen_s = np.full(1 << BITS, 1e-3), np.full((2, 2), 1e-3), 1e-3
    r = np.random.default_rng(seed)
    lines = [x for x in lines if x[0]]
    by_length = sorted(range(len(lines)), key=lambda i: len(lines[i][0]))
    groups = [by_length[i : i + batch] for i in range(0, len(lines), batch)]
    for _ in range(epochs):
        for g in r.permutation(len(groups)):
            own = [lines[i] for i in groups[g]]
            length = np.array([len(x[0]) for x in own])
            slots = np.array([s for x in own for word in x[0] for s in word])
            per_word = np.array([len(word) for x in own for word in x[0]])
            row = np.repeat(np.arange(len(own)), length)
            at = np.concatenate([np.arange(k) for k in length])
            y = np.zeros((len(own), length.max()))
            y[row, at] = [v for x in own for v in x[1]]
            e = np.zeros(y.shape)
            owner = np.repeat(np.arange(len(row)), per_word)
            e[row, at] = np.bincount(owner, chain.weights[slots], minlength=len(row))
            p, pairs, first = marginals(e, length, chain)
            g_w = np.bincount(slots, np.repeat((y - p)[row, at], per_word), minlength=1 << BITS) / len(own)
            inside = np.arange(1, y.shape[1]) < length[:, None]
            a, b = y[:, :-1][inside], y[:, 1:][inside]
            seen = np.array([[((1 - a) * (1 - b)).sum(), ((1 - a) * b).sum()], [(a * (1 - b)).sum(), (a * b).sum()]])
            g_t, g_s = (seen - pairs) / len(own), float((y[:, 0] - first).mean())
            g_w -= decay * chain.weights * (g_w != 0)
            seen_w += g_w**2
            seen_t += g_t**2
            seen_s += g_s**2
            chain.weights += rate * g_w / np.sqrt(seen_w)
            chain.steps += rate * g_t / np.sqrt(seen_t)
            chain.start += rate * g_s / math.sqrt(seen_s)
    return chain


class Tagger:
    """Marginals of the words of texts under a chain; keeps emission scores of words it has met."""

    def __init__(self, chain: Chain):
        self.chain, self.known = chain, {}

    def emission(self, word: str) -> float:
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        got = self.known[word] = float(sum(self.chain.weights[slot(x)] for x in parts(word)))
        return got

    def lines(self, rows: list[list[str]], budget: int = 200_000) -> list[np.ndarray]:
        """P(toxic) of every word of every line; lines of like length are padded together."""
        known, out = self.known, [np.zeros(0)] * len(rows)
        order = sorted((i for i in range(len(rows)) if rows[i]), key=lambda i: len(rows[i]))
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and len(rows[order[to]]) * (to + 1 - at) <= budget and len(rows[order[to]]) <= 1.3 * len(rows[order[at]]) + 8:
                to += 1
            own = order[at:to]
            length = np.array([len(rows[i]) for i in own])
            e = np.zeros((len(own), length.max()))
            for k, i in enumerate(own):
                e[k, : length[k]] = [known[w] if w in known else self.emission(w) for w in rows[i]]
            p = marginals(e, length, self.chain)[0]
            for k, i in enumerate(own):
                out[i] = p[k, : length[k]]
            at = to
        return out

    def read(self, texts: list[str | None]) -> list[tuple[int, int, str, np.ndarray]]:
        """(number of the text, offset, line, P(toxic) of its words) of every line with a word."""
        where, rows = [], []
        for i, t in enumerate(texts):
            base = 0
            for line in (t or "").split("\n"):
                if found := WORD.findall(line):
                    where.append((i, base, line))
                    rows.append(found)
                base += len(line) + 1
        return [(*w, p) for w, p in zip(where, self.lines(rows), strict=True)]

    def sums(self, n_texts: int, read: list[tuple[int, int, str, np.ndarray]]) -> np.ndarray:
        """Per text: log-odds of the two largest marginals, log of 1 + the sum of marginals, log of 1 + words, and 1."""
        most, second, total, n = (np.zeros(n_texts) for _ in range(4))
        for i, _, _, p in read:
            top = np.sort(np.r_[p, most[i], second[i]])[-2:] if len(p) < 4 else np.sort(np.r_[np.partition(p, -2)[-2:], most[i], second[i]])[-2:]
            second[i], most[i] = top
            total[i] += p.sum()
            n[i] += len(p)
        odds = lambda p: np.log(np.clip(p, 1e-4, 1 - 1e-4) / (1 - np.clip(p, 1e-4, 1 - 1e-4)))
        return np.column_stack([odds(most), odds(second), np.log1p(total), np.log1p(n), np.ones(n_texts)])

    def inputs(self, texts: list[str | None]) -> np.ndarray:
        return self.sums(len(texts), self.read(texts))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return self.judge(texts)[0]

    def judge(self, texts: list[str | None], least: float = 0.5) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """Score of every text, and its offending words as (start, end, P(toxic)), in code points."""
        read = self.read(texts)
        score = 1 / (1 + np.exp(-np.clip(self.sums(len(texts), read) @ self.chain.curve, -40, 40)))
        found: list[list[tuple[int, int, float]]] = [[] for _ in texts]
        for i, base, line, p in read:
            if p.max() >= least:
                found[i] += [(base + m.start(), base + m.end(), float(q)) for m, q in zip(WORD.finditer(line), p, strict=True) if q >= least]
        return score, found


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 60, decay: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; classes are weighted to a clean-to-toxic ratio of nine."""
    w, c = np.where(y == 1, 1 / max(1, y.sum()), 9 / max(1, (1 - y).sum())), np.zeros(x.shape[1])
    w = w / w.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        g = x.T @ (w * (y - p)) - decay * 0.01 * c
        h = (x * (w * p * (1 - p))[:, None]).T @ x + (decay * 0.01 + 1e-9) * np.eye(len(c))
        c = c + np.clip(np.linalg.solve(h, g), -2, 2)
    return c


def learn(docs: DataFrame, labels: DataFrame, held_out: Column, max_docs: int = 2_500, max_lines: int = 12_000, max_words: int = 1_000_000, max_parts: int = 20_000, chance: float = 1e-7, max_rate: float = 0.2) -> Chain | None:
    """Markers, labelled lines and the chain, from labelled documents outside the held-out fold."""
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.min("toxic").alias("lo"), F.max("toxic").alias("hi")).where(~held_out & (F.col("lo") == F.col("hi")))
    first = lambda which, n: known.where(F.col("lo") == which).select("doc_id", F.col("lo").alias("toxic"), F.xxhash64("doc_id").alias("_at")).orderBy("_at", "doc_id").limit(n).drop("_at")
    chosen = first(1, max_docs).unionAll(first(0, 2 * max_docs))
    # at most 3 * max_docs ids: bounded, so broadcast
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # one text of each chosen id, however many rows have it
    sample = store.keep(sample.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "toxic"), "tx-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        n = [0, 0]

        def flush() -> pa.RecordBatch:
            keys = list({**seen[0], **seen[1]})
            got = pa.record_batch([pa.array([*keys, ""]), pa.array([*(seen[1][k] for k in keys), n[1]], pa.int64()), pa.array([*(seen[0][k] for k in keys), n[0]], pa.int64())], ["part", "toxic", "clean"])
            seen[0].clear()
            seen[1].clear()
            n[:] = 0, 0
            return got

        for b in batches:
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                seen[toxic].update({x for w in set(WORD.findall(text or "")) for x in parts(w)})
                n[toxic] += 1
                if len(seen[0]) + len(seen[1]) > FLUSH_PARTS:
                    yield flush()
        yield flush()

    counted = sample.mapInArrow(count, "part string, toxic long, clean long").groupBy("part").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic >= 4 or part = ''")
    # only parts that toxic documents have at twice the rate of clean ones
    rows = counted.where("part = '' or toxic > clean").orderBy((F.col("part") == "").desc(), F.col("toxic").desc(), "part").limit(max_parts + 1).collect()
    n_toxic, n_clean = next(((r.toxic, r.clean) for r in rows if r.part == ""), (0, 0))
    if not n_toxic or not n_clean:
        store.drop(sample)
        return None
    share = n_toxic / (n_toxic + n_clean)
    marks = frozenset(r.part for r in rows if r.part and r.clean * n_toxic <= max_rate * r.toxic * n_clean and tail(r.toxic, r.toxic + r.clean, share) < chance)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                for line in (text or "").split("\n"):
                    own = [parts(w) for w in WORD.findall(line)]
                    if not own:
                        continue
                    code = zlib.crc32(line.encode("utf-8", "surrogatepass"))
                    for lo, hi in cuts(len(own)):
                        part = own[lo:hi]
                        y = [int(toxic and not marks.isdisjoint(x)) for x in part]
                        at = (zlib.crc32(str(lo).encode(), code) if lo else code) >> (0 if any(y) else 1)
                        out.append((at if any(y) else at + (1 << 31), [[slot(x) for x in w] for w in part], y))
            a, x, y = zip(*out, strict=True) if out else ((), (), ())
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(x, pa.list_(pa.list_(pa.int32()))), pa.array(y, pa.list_(pa.int32()))], ["at", "x", "y"])

    lines = sample.mapInArrow(label, "at long, x array<array<int>>, y array<int>")
    before = F.sum(F.size("x")).over(W.orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.size("x")
    # a window over max_lines // 2 rows
    pick = lambda which: lines.where(which).orderBy("at").limit(max_lines // 2).withColumn("_n", before).where(F.col("_n") < max_words // 2).toArrow()
    bad, good = pick("at < 2147483648"), pick("at >= 2147483648")
    chain = train([*zip(bad.column("x").to_pylist(), bad.column("y").to_pylist(), strict=True), *zip(good.column("x").to_pylist(), good.column("y").to_pylist(), strict=True)])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(chain)
        for b in batches:
            for at in range(0, b.num_rows, 200):
                s = b.slice(at, 200)
                x = tagger.inputs(s.column("text").to_pylist())
                yield pa.record_batch([pa.array(list(x), pa.list_(pa.float64())), s.column("toxic")], ["x", "toxic"])

    got = sample.mapInArrow(sums, "x array<double>, toxic int").toArrow()
    x = np.array(got.column("x").to_pylist())
    chain.curve = fit_curve(x, got.column("toxic").to_numpy().astype(float))
    store.drop(sample)
    return chain


_TAGGERS: dict[int, Tagger] = {}


def tagger_of(chain: Chain) -> Tagger:
    """This worker's tagger of a chain, so that later tasks find known words."""
    key = hash((chain.weights.tobytes(), chain.start, chain.curve.tobytes()))
    if key not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[key] = Tagger(chain)
    return _TAGGERS[key]


OFFENCES = "offences array<struct<start:int,end:int,p:double>>"


def score(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """(doc_id, score, offences) of every whole text; offences are words by offsets in code points, with their marginals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = tagger_of(chain) if chain else None
        form = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        for b in batches:
            for s in slices(b):
                got, found = tagger.judge(s.column("text").to_pylist()) if tagger else (np.zeros(s.num_rows), [[]] * s.num_rows)
                told = [[{"start": a, "end": z, "p": p} for a, z, p in x] for x in found]
                yield pa.record_batch([s.column("doc_id"), pa.array(got, pa.float64()), pa.array(told, form)], ["doc_id", "score", "offences"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, score double, {OFFENCES}")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, offences) of every document."""
    held_out = fold(4, 2)
    got = score(docs, learn(docs, labels, held_out))
    return got.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "offences")
