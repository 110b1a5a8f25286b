"""Hard negatives by Kronecker-packed products of integer vectors.

Every component x becomes floor(256 * x), and a score is an integer inner product. Candidates are multiplied several at a
time: their components are biased to be non-negative, and those of ``k`` candidates are put side by side into fields of
one wide integer. One multiplication by an anchor's component then serves all of them; the sums of a field never reach
the next one, so the exact scores are cut out of the total afterwards. As long as two fields fit the 53 bits of a
double's integers, the wide integers are doubles and the products a matrix product; wider ones are Python's integers, so scores
are exact whatever the components.

Anchors and candidates are dealt by hash into blocks of a bounded number of components, and every pair of an anchor block
and a candidate block is a cell of its own: a task holds two blocks, whatever the table. Cells return their best
rows only, and windows merge them:

1. positives: the best rows of the anchor's label, per anchor.
2. negatives: the best rows of other labels with a score from ``least`` to 100 % of a positive's, per anchor and positive.

Edge cases: rows with a null vec_id, label or vector, or null or non-finite components take no part, nor do rows with a component
of ``LARGEST`` or more, so that all scores are exact as decimals; repeated rows count once, and a row is never its own
partner, nor that of a row with its vec_id; rows of one vec_id with different vectors or labels are rows of their own;
only vectors of one length meet; empty vectors have score 0; of equal scores the smaller vec_id comes first; a score that
is no 64-bit number is compared exactly and given as null; anchors without positives, and positives without negatives (all
with a score below 0), have no row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandspark.llm import store

SCALE, DOUBLE_BITS = 256, 53
LARGEST = 2.0**50
BLOCK_COMPONENTS = 1 << 20  # 16,384 vectors of 64: some 20 MB of a task for each of its two blocks
SLAB, ANCHORS_AT_ONCE = 2_048, 256
LEAST_INT = np.iinfo(np.int64).min


def quantise(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x); exact, as x is under ``LARGEST``."""
    return np.floor(values.astype(np.float64) * scale).astype(np.int64)


class Packed:
    """Candidates with several components in one wide integer."""

    def __init__(self, candidates: np.ndarray, anchor_most: int):
        n, d = candidates.shape
        self.n = n
        self.bias = max(0, -int(candidates.min(initial=0)))
        most = int(candidates.max(initial=0)) + self.bias
        # |sum over components| of a field stays below 2 ** (bits - 1)
        self.bits = (max(1, d) * max(1, anchor_most) * max(1, most)).bit_length() + 1
        self.fields = max(1, DOUBLE_BITS // self.bits)
        self.exact = self.bits * self.fields <= DOUBLE_BITS
        kind = float if self.exact else int
        lanes = -(-n // self.fields) if n else 0
        wide = np.zeros((lanes, d), dtype=float if self.exact else object)
        for f in range(self.fields):
            part = candidates[f :: self.fields]
            wide[: len(part)] += (part + self.bias).astype(wide.dtype) * kind(1 << (self.bits * f))
        self.wide = wide

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products of all anchors (rows) with all candidates (columns)."""
        out = np.zeros((len(anchors), self.n), dtype=np.int64 if self.exact else object)
        if not self.n or not len(anchors):
            return out
        half = 1 << (self.bits - 1)
        base = sum(half << (self.bits * f) for f in range(self.fields))
        anchors = anchors if self.exact else anchors.astype(object)
        # of doubles: a sum of products that are integers below 2 ** 53, exact in any order
        rest = (anchors.astype(self.wide.dtype) @ self.wide.T).astype(out.dtype) + base
        shift = self.bias * anchors.sum(axis=1)[:, None]
        for f in range(self.fields):
            field = (rest & ((1 << self.bits) - 1)) - half
            rest = rest >> self.bits
            out[:, f :: self.fields] = field[:, : len(range(f, self.n, self.fields))] - shift
        return out


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` best of every group: highest score, then smallest id."""
    order = np.lexsort((ids, -score, group)) if score.dtype != object else np.array(sorted(range(len(score)), key=lambda i: (group[i], -score[i], ids[i])), dtype=np.int64)
    g = group[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(g)) - np.repeat(first, np.diff(np.r_[first, len(g)]))
    return order[rank < top]


class Block:
    """Rows of one vector length: ids, labels and integer vectors."""

    def __init__(self, table: pa.Table, scale: int):
        self.table = table
        self.ids, self.labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
        v = table.column("embedding").combine_chunks()
        self.values = quantise(v.flatten().to_numpy(zero_copy_only=False).reshape(len(self.ids), -1), scale)


def by_length(table: pa.Table, scale: int) -> dict[int, Block]:
    sizes = table.column("embedding").combine_chunks().value_lengths().to_numpy()
    return {int(d): Block(table.filter(pa.array(sizes == d)), scale) for d in np.unique(sizes)}


def leading(score: np.ndarray, valid: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the valid scores that may be among the ``top`` of their row, ties with the last included."""
    if score.dtype != object and score.shape[1] > top:
        masked = np.where(valid, score, LEAST_INT)
        valid = valid & (masked >= np.partition(masked, -top, axis=1)[:, -top, None])
    return np.nonzero(valid)


def cell_rows(anchors: pa.Table, candidates: pa.Table, top: int, scale: int, least: int | None) -> list[tuple[np.ndarray, ...]]:
    """(row, number of the positive or -1, vec_id, score) of the best rows of a cell.

    Without ``least`` those of the anchor's label; with it, those of other labels that score at least ``least`` % of
    each of the anchor's positives (column ``scores``) and no more than it.
    """
    out, right = [], by_length(candidates, scale)
    for d, a in by_length(anchors, scale).items():
        if d not in right:
            continue
        c = right[d]
        most = int(np.abs(a.values).max(initial=0))
        packs = [(s, Packed(c.values[s : s + SLAB], most)) for s in range(0, len(c.ids), SLAB)]
        highs = None if least is None else [[int(x) for x in row] for row in a.table.column("scores").to_pylist()]
        for lo in range(0, len(a.ids), ANCHORS_AT_ONCE):
            part = slice(lo, min(lo + ANCHORS_AT_ONCE, len(a.ids)))
            kept = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
            for s, pack in packs:
                got = pack.scores(a.values[part])
                same = a.labels[part, None] == c.labels[None, s : s + SLAB]
                other = a.ids[part, None] != c.ids[None, s : s + SLAB]
                found = [kept]
                if highs is None:
                    row, col = leading(got, same & other, top)
                    found.append((row, np.full(len(row), -1), c.ids[s + col], got[row, col]))
                else:
                    for p in range(max(map(len, highs[part]))):
                        # a negative's score is at least a share of a positive's and no more, so never negative
                        high = np.array([h[p] if p < len(h) else -1 for h in highs[part]], dtype=got.dtype)[:, None]
                        row, col = leading(got, ~same & other & (got <= high) & (100 * got >= least * high), top)
                        found.append((row, np.full(len(row), p), c.ids[s + col], got[row, col]))
                rows = tuple(np.concatenate(x) for x in zip(*found, strict=True))
                take = best(rows[0] * 10_000 + rows[1], rows[3], rows[2], top)
                kept = tuple(x[take] for x in rows)
            out.append((a.table.column("row").to_numpy()[part][kept[0]], *kept[1:]))
    return out


def cells(anchors: DataFrame, candidates: DataFrame, top: int, scale: int, least: int | None = None) -> DataFrame:
    """(row, positive, vec_id, score): the ``top`` best of every cell (anchor block, candidate block)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = cell_rows(left, right, top, scale, least) if left.num_rows and right.num_rows else []
        row, positive, ids, score = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, dtype=np.int64),) * 4
        exact = pa.array([Decimal(x) for x in score.tolist()], pa.decimal128(38, 0))
        return pa.table({"row": pa.array(row, pa.int64()), "positive": pa.array(positive, pa.int32()), "vec_id": pa.array(ids, pa.int64()), "score": exact})

    keys = ["a_block", "c_block"]
    return anchors.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(run, "row long, positive int, vec_id long, score decimal(38,0)")


def first(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    """Adds ``rank``, from 1, and keeps ``top`` rows of a key; Spark limits each task's rows before it shuffles them."""
    w = W.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def mine(embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, least: int = 80, scale: int = SCALE, block_components: int = BLOCK_COMPONENTS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows whose vec_id is divisible by ``every``."""
    spark = embeddings.sparkSession
    ok = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    ok = ok.where("vec_id is not null and label is not null and embedding is not null").where(F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < LARGEST)))
    rows = store.keep(ok.distinct().withColumn("row", F.monotonically_increasing_id()), "hn-rows")
    asked = (F.col("vec_id") % every) == 0
    size = F.size("embedding").cast("long") + 1
    total = rows.agg(F.sum(size).alias("all"), F.sum(F.when(asked, size)).alias("asked")).first()
    # at least two blocks for each core, so that small tables are shared out too
    n_c = max(-(-(total["all"] or 0) // block_components), 2 * spark.sparkContext.defaultParallelism)
    n_a = max(-(-(total["asked"] or 0) // block_components), 1)
    a_block, c_block = F.pmod(F.xxhash64("row"), F.lit(n_a)).cast("int").alias("a_block"), F.pmod(F.xxhash64("row"), F.lit(n_c)).cast("int").alias("c_block")
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # names of their own: columns that both sides of a cogroup share would be taken for one another
    candidates = rows.select(*(F.col(c).alias(c) for c in ("vec_id", "label", "embedding")), c_block, everywhere(n_a).alias("a_block"))
    anchors = rows.where(asked).select("row", "vec_id", "label", "embedding", a_block)

    good = first(cells(anchors.withColumn("c_block", everywhere(n_c)), candidates, positives, scale), ["row"], positives)
    good = store.keep(good.select("row", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "hn-positives")
    listed = good.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_score"))).alias("_l")).select("row", F.col("_l.positive_score").alias("scores"))
    bad = cells(anchors.join(listed, "row").withColumn("c_block", everywhere(n_c)), candidates, negatives, scale, least)
    bad = first(bad, ["row", "positive"], negatives).select("row", (F.col("positive") + 1).alias("_p"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    of = good.withColumnRenamed("rank", "_p").join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    as_long = lambda c: F.col(c).try_cast("long").alias(c)
    return bad.join(of, ["row", "_p"]).select("anchor_id", "positive_id", "rank", "negative_id", as_long("positive_score"), as_long("negative_score"))


def relabelled(embeddings: DataFrame) -> DataFrame:
    """The registered query's labels: the next of ten where vec_id is divisible by 7, so that some near rows differ in label."""
    return embeddings.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def oracle() -> str:
    """DuckDB SQL for ``mine(relabelled(embeddings))``, by comparison of each anchor with each row."""
    return """with ok as (select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) as bigint) as score
  from ok a join ok c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id and len(a.v) = len(c.v)),
good as (select anchor_id, vec_id as positive_id, score as positive_score from scored where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, cast(row_number() over w as integer) as rank, s.vec_id as negative_id, positive_score, score as negative_score
from good join scored s using (anchor_id) where not same and 80 * positive_score <= 100 * score and score <= positive_score
window w as (partition by anchor_id, positive_id order by score desc, s.vec_id) qualify row_number() over w <= 5"""
