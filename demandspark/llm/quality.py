"""Quality classifier learnt from positives and unlabelled texts.

Trusted positives are labelled rows of quality 1; everything else in the learning folds is unlabelled, whatever its
label. The class prior is estimated first: of a classifier of positives against unlabelled, the smallest ratio of
the two samples' upper score tails. Then a small network minimises the non-negative unbiased risk
``prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)])`` on inputs that are read off the text alone.

Learning uses at most ``max_positives`` and ``max_unlabelled`` documents, the first by a hash of doc_id, one text of each;
their inputs (a few dozen numbers each) go to the driver, no text does. Every document is scored over its whole text.

Edge cases: null text counts as empty and is scored; null labels teach nothing; without positives or unlabelled
rows every score is the prior 0.5; repeated rows are scored alike; tables may be empty; other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.rules import repeated_words
from demandspark.llm.text import Words, runs_sum, slices

PUNCTUATION = [ord(c) for c in string.punctuation]
N_INPUTS = 13 + len(PUNCTUATION)


def inputs(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text: shares of kinds of characters and of repeated words, on a log scale."""
    w = Words(texts)
    size = np.maximum(np.diff(w.offsets), 1)
    words = np.maximum(w.count, 1)
    share = lambda mask: runs_sum(mask, w.offsets) / size
    h, owner = w.hashes(), w.text_of()
    same = np.zeros(len(h), dtype=np.int64)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    length = (w.end - w.start).astype(np.int64)
    upper, lower = (w.data >= 65) & (w.data <= 90), (w.data >= 97) & (w.data <= 122)
    capital = upper[w.start].astype(np.int64)
    marks = ~(upper | lower | ((w.data >= 48) & (w.data <= 57)) | w.space | (w.data >= 128))
    edges = w.first
    columns = [
        share(upper), share(lower), share((w.data >= 48) & (w.data <= 57)), share(w.data >= 128), share(w.space), share(w.data == 10), share(marks),
        runs_sum(same, edges) / words, repeated_words(w) / words, runs_sum(length, edges) / words / 10, runs_sum((length > 20).astype(np.int64), edges) / words,
        runs_sum(capital, edges) / words, np.log1p(w.count) / 10,
    ]
    seen = np.zeros((len(size), len(PUNCTUATION)))
    if marks.any():
        at = np.flatnonzero(marks)
        code = np.full(256, -1)
        code[PUNCTUATION] = range(len(PUNCTUATION))
        kind = code[w.data[at]]
        text = np.searchsorted(w.offsets, at, side="right") - 1
        ok = kind >= 0
        np.add.at(seen, (text[ok], kind[ok]), 1)
    columns += list((seen / size[:, None]).T)
    return np.log1p(50 * np.column_stack(columns))


class Network:
    """One hidden layer, trained by Adam on full batches; plain numpy, so that tasks need nothing else."""

    def __init__(self, n: int, hidden: int, seed: int):
        r = np.random.default_rng(seed)
        self.p = [r.normal(0, 1 / np.sqrt(n), (n, hidden)), np.zeros(hidden), r.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        self.center, self.scale = np.zeros(n), np.ones(n)

    def fit_scale(self, x: np.ndarray) -> None:
        self.center, self.scale = x.mean(0), x.std(0) + 0.05

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = np.clip((x - self.center) / self.scale, -6, 6)
        a = np.tanh(z @ self.p[0] + self.p[1])
        return z, a, a @ self.p[2] + self.p[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(x)[2], -40, 40)))

    def train(self, x: np.ndarray, slope, steps: int, rate: float = 0.02, decay: float = 1e-4) -> None:
        """slope(f) gives the derivative of the risk by every output f."""
        m, v = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p]
        for t in range(1, steps + 1):
            z, a, f = self.forward(x)
            g = slope(f)
            back = np.outer(g, self.p[2]) * (1 - a**2)
            grads = [z.T @ back + decay * self.p[0], back.sum(0), a.T @ g + decay * self.p[2], np.array([g.sum()])]
            for k, q in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * q
                v[k] = 0.999 * v[k] + 0.001 * q**2
                self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)


def sigmoid(f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f, -40, 40)))


def estimate_prior(p: np.ndarray, u: np.ndarray, seed: int = 0) -> float:
    """Share of positives among the unlabelled: least ratio of score tails, over tails of a tenth of the positives or more."""
    x = np.vstack([p, u])
    net = Network(x.shape[1], 8, seed)
    net.fit_scale(u)
    n_p, n_u = len(p), len(u)
    target = np.r_[np.ones(n_p), np.zeros(n_u)]
    weight = np.r_[np.full(n_p, 0.5 / n_p), np.full(n_u, 0.5 / n_u)]
    net.train(x, lambda f: (sigmoid(f) - target) * weight, 200)
    sp, su = np.sort(net.score(p)), np.sort(net.score(u))
    cuts = np.quantile(sp, np.linspace(0, 0.9, 46))
    tail_p = 1 - np.searchsorted(sp, cuts) / n_p
    tail_u = 1 - np.searchsorted(su, cuts) / n_u
    slack = np.sqrt(np.log(40) / 2 * (1 / n_p + 1 / n_u))
    return float(np.clip(np.min((tail_u + slack) / tail_p), 0.05, 0.98))


def fit(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 400, hidden: int = 16, seed: int = 0) -> Network:
    """Minimise the non-negative unbiased risk with the logistic loss."""
    x = np.vstack([p, u])
    net = Network(x.shape[1], hidden, seed)
    net.fit_scale(u)
    n_p, n_u = len(p), len(u)

    def slope(f: np.ndarray) -> np.ndarray:
        fp, fu = f[:n_p], f[n_p:]
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        up_p, up_u = -prior * sigmoid(fp) / n_p, sigmoid(fu) / n_u  # derivative of the negative part
        if negative < 0:  # step back where that part would turn negative
            return np.r_[-up_p, -up_u]
        return np.r_[-prior * sigmoid(-fp) / n_p + up_p, up_u]

    net.train(x, slope, steps)
    return net


def learn(docs: DataFrame, labels: DataFrame, held_out: Column, max_positives: int = 10_000, max_unlabelled: int = 20_000) -> Network | None:
    """Fit on bounded samples of the learning folds; ``held_out`` is a condition on doc_id."""
    known = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("lo")).where(~held_out & (F.col("lo") == 1))
    first = lambda rows, n: rows.select("doc_id", F.xxhash64("doc_id").alias("_at")).orderBy("_at", "doc_id").limit(n)
    # several times as many as needed are told apart, not all ids of the corpus
    near = int(min(1.0, 4 * max_unlabelled / max(1, docs.count())) * 1_000_003)
    ids = docs.where(~held_out & F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < near)).select("doc_id").distinct()
    chosen = first(known, max_positives).select("doc_id", F.lit(1).alias("is_p")).unionAll(first(ids, max_unlabelled).select("doc_id", F.lit(0).alias("is_p")))
    chosen = chosen.groupBy("doc_id").agg(F.max("is_p").alias("is_p"), F.min("is_p").alias("is_u"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b):
                x = inputs(s.column("text"))
                yield pa.record_batch([s.column("doc_id"), s.column("print"), s.column("is_p"), s.column("is_u"), pa.array(list(x.astype(np.float32)), pa.list_(pa.float32()))], ["doc_id", "print", "is_p", "is_u", "x"])

    # at most max_positives + max_unlabelled ids of 16 bytes: bounded, so broadcast
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("print")).join(F.broadcast(chosen), "doc_id")
    rows = rows.mapInArrow(run, "doc_id long, print long, is_p int, is_u int, x array<float>")
    # a row per chosen id, however many rows have it
    rows = rows.groupBy("doc_id").agg(F.max("is_p").alias("is_p"), F.max("is_u").alias("is_u"), F.min_by("x", "print").alias("x")).toArrow().sort_by("doc_id")
    if not rows.num_rows:
        return None
    x = np.array(rows.column("x").to_pylist(), dtype=np.float64)
    is_p, is_u = rows.column("is_p").to_numpy() == 1, rows.column("is_u").to_numpy() == 0
    if not is_p.any() or not is_u.any():
        return None
    return fit(x[is_p], x[is_u], estimate_prior(x[is_p], x[is_u]))


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, score) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b):
                got = net.score(inputs(s.column("text"))) if net else np.full(s.num_rows, 0.5)
                yield pa.record_batch([s.column("doc_id"), pa.array(got, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def fold(n: int, which: int) -> Column:
    """Whether crc32 of doc_id as text, modulo n, is ``which``; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n == which


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    held_out = fold(3, 1)
    got = score(docs, learn(docs, labels, held_out))
    return got.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents whose score reaches ``least``, with all their columns; nothing is joined, so repeated ids stay."""
    net = learn(docs, labels, fold(3, 1))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b):
                yield s.filter(pa.array(net.score(inputs(s.column("text"))) >= least)) if net else s

    return docs.mapInArrow(run, schema)
