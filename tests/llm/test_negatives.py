"""Hard negatives against plain comparison of all rows, with exact integers."""

import math
import random

import numpy as np
import pytest
from demandspark.llm import negatives

FORM = "vec_id long, embedding array<double>, label int, rank string"


def brute(rows, every=100, positives=5, negative=5, least=80):
    ok = []
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) or abs(x) >= 2.0**50 for x in v):
            continue
        row = (i, label, tuple(v))
        if row not in ok:
            ok.append(row)
    whole = {r: [math.floor(256 * x) for x in r[2]] for r in ok}
    out = []
    for a in ok:
        if a[0] % every:
            continue
        scored = [(-sum(x * y for x, y in zip(whole[a], whole[c], strict=True)), c[0], c[1]) for c in ok if c[0] != a[0] and len(c[2]) == len(a[2])]
        good = sorted((s, i) for s, i, label in scored if label == a[1])[:positives]
        for s, i in good:
            bad = sorted((t, j) for t, j, label in scored if label != a[1] and least * -s <= 100 * -t <= 100 * -s)[:negative]
            out += [(a[0], i, k, j, -s, -t) for k, (t, j) in enumerate(bad, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_packed_products_are_exact():
    r = np.random.default_rng(0)
    for low, high, d in ((-256, 256, 64), (-3, 4, 5), (0, 1, 1), (-(2**20), 2**20, 300), (-(2**40), 2**40, 7), (-5, -1, 3)):
        a, c = r.integers(low, high, (4, d)), r.integers(low, high, (9, d))
        pack = negatives.Packed(c, int(np.abs(a).max()))
        want = [[int(sum(int(x) * int(y) for x, y in zip(p, q, strict=True))) for q in c] for p in a]
        assert [[int(x) for x in row] for row in pack.scores(a)] == want
    assert negatives.Packed(r.integers(-256, 256, (9, 64)), 256).fields >= 2
    assert negatives.Packed(np.zeros((0, 3), dtype=np.int64), 5).scores(np.ones((2, 3), dtype=np.int64)).shape == (2, 0)


@pytest.mark.parametrize("components", [1 << 20, 200])
def test_equals_plain_comparison(spark, components):
    """Also in many blocks; with ties, a frequent vector, repeated ids and rows, nulls, several lengths."""
    r = random.Random(7)
    vector = lambda d: [r.gauss(0, 0.4) + 0.2 for _ in range(d)]
    rows = [(i, vector(6), r.randrange(3), "x") for i in range(320)]
    rows += [(1000 + i, [0.5] * 6, i % 3, "x") for i in range(60)] + [(1000, [0.5] * 6, 0, "x")] * 3 + [(1100, [0.5] * 6, 1, "x"), (1100, vector(6), 1, "x")]
    rows += [(2000 + 10 * i, vector(3), 1 + i % 2, "x") for i in range(30)] + [(3000, [], 1, "x"), (3001, [], 1, "x"), (3002, [], 2, "x")]
    rows += [(None, vector(6), 1, "x"), (400, None, 1, "x"), (500, vector(6), None, "x"), (600, [1.0, None] + [0.0] * 4, 1, "x"), (700, [float("nan")] * 6, 1, "x"), (800, [float("inf")] * 6, 1, "x"), (900, [-1.0] * 6, 9, "x"), (-100, vector(6), 2, "x")]
    df = spark.createDataFrame(rows, FORM)
    want = brute(rows)
    assert len(want) > 60 and got(negatives.mine(df, block_components=components)) == want
    assert got(negatives.mine(df.limit(0))) == []


def test_scores_beyond_64_bits_are_null_but_ordered(spark):
    big = 2.0**40
    rows = [(100, [big, 1.0], 1, ""), (1, [big, 0.0], 1, ""), (2, [big * 0.9, 0.0], 2, ""), (3, [big * 0.95, 0.0], 2, ""), (4, [0.0, 1.0], 1, "")]
    want = brute(rows)
    assert [x[3] for x in want if x[1] == 1] == [3, 2] and want[0][4] > 2**63
    assert got(negatives.mine(spark.createDataFrame(rows, FORM))) == [(*x[:4], *(s if s < 2**63 else None for s in x[4:])) for x in want]


def test_labels_of_the_query(spark):
    df = spark.createDataFrame([(7, [1.0], 9, ""), (8, [1.0], 9, ""), (14, [1.0], None, ""), (None, [1.0], 4, "")], FORM)
    assert [r.label for r in negatives.relabelled(df).collect()] == [0, 9, None, 4]
