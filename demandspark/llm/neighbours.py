"""Approximate nearest neighbours by inner product along shifted space-filling curves.

Equal vectors form one point. Points are projected on a few directions, each curve with its own rotation and shift, cut
into cells by quantiles of a bounded sample, and ordered by Hilbert index: every curve is range-partitioned and sorted
in Spark, and the ranks along it cut it into blocks of exactly ``block`` points, however many points there are. A query is
compared with all points of its own block and of ``reach`` blocks to either side, on every curve; the lists of all
windows merge, and the best by exact inner products on the original vectors, in double precision, are its neighbours.

How many curves and how wide a window is not guessed: for a bounded set of trial queries the true neighbours are found
by comparison with every point, in blocks, and the cheapest number of curves and reach whose windows hold at least
``recall`` of them is taken. Where vectors have structure, windows are narrow; where they have none (all directions
alike, as in random vectors), no order along a line keeps neighbours together, and the windows widen up to every block.

A task holds the points of one tile (a few blocks) and lets the queries whose windows touch it pass by, so memory follows
the tile; points are not copied for more queries. Vectors of one length are a search of their own: lengths of over
``block`` points get curves one after another, all others are one tile each, in one job.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components take no part; only vectors of
the same length are compared; of equal scores the smaller vec_id comes first; a vec_id with several vectors is searched
for each of them, and is a candidate with each; repeated rows count once; with fewer candidates than ``top``, all are
given; float and double vectors are used as they are, other numbers as doubles; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.llm import skew, store

BLOCK, AXES, LEVELS = 2_048, 8, 7
CURVES, SAMPLE, TRIALS = 4, 20_000, 128
SPAN, QUERIES = 8, 256  # blocks in a tile at most; queries compared at once


def hilbert(cells: np.ndarray, levels: int) -> np.ndarray:
    """Hilbert index of integer cells (rows of ``axes`` numbers under 2**levels), column-wise.

    From the highest bit down each axis either inverts or swaps the lower bits of the first axis; a Gray code of the
    transposed bits then gives the index.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(levels - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            on = (x[i] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(levels - 1, 0, -1):
        turn ^= np.where((x[n - 1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= turn
    out = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(levels - 1, -1, -1):
        for i in range(n):
            out = out << 1 | (x[i] >> level & 1)
    return out


class Curves:
    """Directions and cell borders of every curve, fitted on a sample."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, seed: int = 0):
        r = np.random.default_rng(seed)
        axes = min(AXES, sample.shape[1])
        _, _, main = np.linalg.svd(sample - sample.mean(0), full_matrices=False)
        self.maps, self.cells = [], []
        for c in range(curves):
            keep = main[: min(len(main), axes * (c + 1))]
            turn = np.linalg.qr(r.normal(size=(len(keep), len(keep))))[0] if c else np.eye(len(keep))
            directions = (turn @ keep)[:axes]
            # shifted by a part of a cell, so that borders fall elsewhere on every curve
            q = (np.arange(1, 1 << LEVELS) - c / curves) / (1 << LEVELS)
            self.maps.append(directions)
            self.cells.append(np.quantile(sample @ directions.T, q, axis=0))

    def key(self, x: np.ndarray, c: int) -> np.ndarray:
        at = x @ self.maps[c].T
        return hilbert(np.column_stack([np.searchsorted(self.cells[c][:, i], at[:, i]) for i in range(at.shape[1])]), LEVELS)


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def nearest(queries: np.ndarray, items: np.ndarray, leads: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows of items, scores) of the ``top`` largest inner products of every query; the smaller lead first on ties.

    A matrix product finds who may be among them; their scores are then summed anew in one fixed order, so that a pair has
    the same score in every block that it meets in.
    """
    rough = queries @ items.T
    slack = 1e-11 * np.linalg.norm(queries, axis=1) * np.linalg.norm(items, axis=1).max(initial=0.0)
    least = -np.partition(-rough, top - 1, axis=1)[:, top - 1] - slack if rough.shape[1] > top else np.full(len(rough), -np.inf)
    out = []
    for q, row, cut in zip(queries, rough, least, strict=True):
        hit = np.flatnonzero(row >= cut)
        score = (items[hit] * q).sum(axis=1)
        order = np.lexsort((hit, leads[hit], -score))[:top]
        out.append((hit[order], score[order]))
    return out


def truth(points: DataFrame, trial: np.ndarray, own: np.ndarray, top: int) -> dict[int, np.ndarray]:
    """The nearest ``top`` points of every trial query, by comparison with all points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                ids = part.column("point").to_numpy()
                got = nearest(trial, matrix(part.column("embedding")), ids, top + 1)
                q = np.repeat(np.arange(len(trial)), [len(h) for h, _ in got])
                hit, score = (np.concatenate(x) for x in zip(*got, strict=True))
                other = ids[hit] != own[q]
                yield pa.record_batch([pa.array(q[other], pa.int32()), pa.array(score[other]), pa.array(ids[hit][other])], ["q", "score", "point"])

    w = W.partitionBy("q").orderBy(F.col("score").desc(), "point")
    found = points.select("point", "embedding").mapInArrow(run, "q int, score double, point long")
    rows = found.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top).select("q", "point").toArrow()  # TRIALS * top rows
    q, p = rows.column("q").to_numpy(), rows.column("point").to_numpy()
    return {int(i): p[q == i] for i in np.unique(q)}


def calibrate(places: DataFrame, own: np.ndarray, near: dict[int, np.ndarray], blocks: int, recall: float) -> tuple[int, int]:
    """Cheapest (number of curves, reach in blocks) whose windows hold ``recall`` of the trial queries' true neighbours."""
    ids = np.unique(np.concatenate([own, *near.values()]))
    # TRIALS * (top + 1) ids at most
    few = places.join(F.broadcast(places.sparkSession.createDataFrame([(int(i),) for i in ids], "point long")), "point", "left_semi").toArrow()
    at = [dict() for _ in range(CURVES)]
    for c, b, p in zip(*(few.column(x).to_pylist() for x in ("curve", "block", "point")), strict=True):
        at[c][p] = b
    away = np.array([[abs(at[c][int(p)] - at[c][int(own[q])]) for q in sorted(near) for p in near[q]] for c in range(CURVES)])
    options = []
    for n in range(1, CURVES + 1):
        least = np.sort(away[:n].min(axis=0))
        reach = int(least[int(np.ceil(recall * len(least))) - 1]) if len(least) else 0
        options.append((n * min(2 * reach + 1, blocks), n, reach))
    return min(options)[1:]


def ordered(points: DataFrame, curves: Curves, n: int, block: int) -> DataFrame:
    """(curve, block, point): where every point stands on every curve; a range-partitioned sort, and ranks along it."""
    spark = points.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = matrix(b.column("embedding"))
            for c in range(CURVES):
                yield pa.record_batch([pa.array(np.full(len(v), c, dtype=np.int32)), pa.array(curves.key(v, c)), b.column("point")], ["curve", "key", "point"])

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), CURVES * n // 1_000_000)
    keys = points.select("point", "embedding").mapInArrow(run, "curve int, key long, point long")
    line = keys.repartitionByRange(parts, "curve", "key", "point").sortWithinPartitions("curve", "key", "point")
    line = store.keep(line.select("curve", "point", F.monotonically_increasing_id().alias("at")).withColumn("part", F.shiftright("at", 33)), "nn-line")
    # a row per partition and curve
    counts = line.groupBy("curve", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("curve", "part", (before - F.col("first")).alias("shift"))
    return line.join(F.broadcast(starts), ["curve", "part"]).select("curve", F.floor((F.col("at") + F.col("shift")) / block).cast("int").alias("block"), "point")


def windows_of(points: DataFrame, asked: DataFrame, dim: int, top: int, recall: float, block: int) -> DataFrame:
    """(dim, curve, tile, role, point, lead, embedding): points (role 0) and queries (role 1) of every tile, for one length."""
    spark = points.sparkSession
    n = points.count()
    blocks = -(-n // block)
    # by hash of the vector: about SAMPLE rows
    some = points.where(F.pmod(F.xxhash64("k1", "k2"), F.lit(1_000_003)) < 1_000_003 * min(1.0, SAMPLE / n)).select("point", "embedding", "k1").toArrow().sort_by("k1")
    x, own = matrix(some.column("embedding")), some.column("point").to_numpy()
    trial, own = x[:TRIALS], own[:TRIALS]
    places = ordered(points, Curves(x), n, block)
    n_curves, reach = calibrate(places, own, truth(points, trial, own, top), blocks, recall)
    span = max(1, min(SPAN, reach // 4, blocks // (2 * spark.sparkContext.defaultParallelism)))
    places = places.where(F.col("curve") < n_curves)
    tiles = F.sequence(F.floor(F.greatest(F.lit(0), F.col("block") - reach) / span).cast("int"), F.floor(F.least(F.lit(blocks - 1), F.col("block") + reach) / span).cast("int"))
    item = places.select("curve", F.floor(F.col("block") / span).cast("int").alias("tile"), F.lit(0).alias("role"), "point")
    query = places.join(asked, "point", "left_semi").select("curve", F.explode(tiles).alias("tile"), F.lit(1).alias("role"), "point")
    return item.unionByName(query).join(points.select("point", "lead", "embedding"), "point").select(F.lit(dim).alias("dim"), "curve", "tile", "role", "point", "lead", "embedding")


def compare(rows: DataFrame, top: int) -> DataFrame:
    """(point, near, lead, score): the ``top`` nearest points of every query in every tile, as rows of lists."""
    keys = ["dim", "curve", "tile"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, items = None, [], None
        for b in batches:
            k = np.column_stack([b.column(c).to_numpy() for c in [*keys, "role"]]) if b.num_rows else np.zeros((0, 4))
            cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1), len(k)] if len(k) else [0]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                piece, key = b.slice(lo, hi - lo), tuple(k[lo][:3])
                if key != now:
                    now, held, items = key, [], None
                if k[lo][3] == 0:
                    held.append(piece)
                    continue
                if items is None:
                    t = pa.Table.from_batches(held)
                    items = matrix(t.column("embedding")), t.column("point").to_numpy(), t.column("lead").to_numpy()
                for at in range(0, piece.num_rows, QUERIES):
                    q = piece.slice(at, QUERIES)
                    got = nearest(matrix(q.column("embedding")), items[0], items[2], top)
                    ends = np.cumsum([0, *(len(h) for h, _ in got)])
                    hit, score = (np.concatenate(x) for x in zip(*got, strict=True))
                    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v)) for v in (items[1][hit], items[2][hit], score)]
                    yield pa.record_batch([q.column("point"), *lists], ["point", "near", "lead", "score"])

    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 64)
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys, "role").mapInArrow(run, "point long, near array<long>, lead array<long>, score array<double>")


def merge(lists: DataFrame, top: int) -> DataFrame:
    """(point, near, lead, score): the ``top`` best rows over all lists of a point, each near point once."""

    def best(q, near, lead, score):
        order = np.lexsort((near, q))
        q, near, lead, score = q[order], near[order], lead[order], score[order]
        new = np.r_[True, (q[1:] != q[:-1]) | (near[1:] != near[:-1])]
        q, near, lead, score = q[new], near[new], lead[new], score[new]
        order = np.lexsort((near, lead, -score, q))
        q, near, lead, score = q[order], near[order], lead[order], score[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        few = rank < top
        return q[few], near[few], lead[few], score[few]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        out = lambda x: pa.record_batch([pa.array(v) for v in x], ["point", "near", "lead", "score"])
        for b in batches:
            if not b.num_rows:
                continue
            sizes = np.diff(b.column("near").offsets.to_numpy())
            own = np.repeat(b.column("point").to_numpy(), sizes), *(b.column(c).flatten().to_numpy() for c in ("near", "lead", "score"))
            own = own if rest is None else tuple(np.concatenate(x) for x in zip(rest, own, strict=True))
            got = best(*own)
            # the last point may go on in the next batch
            last = got[0] == got[0][-1]
            if not last.all():
                yield out([x[~last] for x in got])
            rest = tuple(x[last] for x in got)
        if rest is not None:
            yield out(rest)

    return lists.repartition("point").sortWithinPartitions("point").mapInArrow(run, "point long, near long, lead long, score double")


def search(embeddings: DataFrame, every: int = 20, top: int = 20, recall: float = 0.95, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for all rows whose vec_id is divisible by ``every``."""
    v, kind = F.col("embedding"), embeddings.schema["embedding"].dataType.elementType
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        v = v.cast("array<double>")
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    ok = embeddings.select("vec_id", v.alias("embedding")).where("vec_id is not null and embedding is not null").where(whole)
    ok = ok.select("vec_id", "embedding", F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(7), F.col("embedding")).alias("k2"))
    keys = ["k1", "k2"]
    groups = store.keep(ok.groupBy(*keys).agg(F.min("vec_id").alias("vec_id"), F.max("vec_id").alias("last"), F.count(F.lit(1)).alias("rows")), "nn-groups")
    hot = skew.hot_of(groups, keys)
    points = ok.join(groups.select(*keys, "vec_id"), [*keys, "vec_id"]).dropDuplicates([*keys, "vec_id"])
    points = store.keep(points.select(*keys, F.col("vec_id").alias("lead"), "embedding", F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("point")), "nn-points")
    asked = ok.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), *keys).distinct()
    asked = store.keep(skew.look_up(asked, points.select(*keys, "point"), keys, hot).select("query_id", "point"), "nn-asked")
    asked_points = store.keep(asked.groupBy("point").agg(F.count(F.lit(1)).alias("rows")), "nn-askers")

    # a row per length of vectors
    sizes = {r.dim: r.n for r in points.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    large = sorted(d for d, n in sizes.items() if n > block)
    small = points.where(~F.col("dim").isin(large)) if large else points
    item = small.select("dim", F.lit(0).alias("curve"), F.lit(0).alias("tile"), F.lit(0).alias("role"), "point", "lead", "embedding")
    rows = item.unionByName(item.join(asked_points, "point", "left_semi").withColumn("role", F.lit(1)).select(item.columns))
    for d in large:
        rows = rows.unionByName(windows_of(points.where(F.col("dim") == d), asked_points.select("point"), d, top, recall, block))
    # a query is one of its own point's ids, so top + 1 points, and ids, leave top others
    found = store.keep(merge(compare(rows, top + 1), top + 1), "nn-found")

    # points of several ids: the top + 1 smallest of them
    w = W.partitionBy(*keys).orderBy("vec_id")
    again = skew.look_up(ok.select(*keys, "vec_id"), groups.where("vec_id < last").select(*keys), keys, hot, "left_semi").distinct()
    again = again.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top + 1).groupBy(*keys).agg(F.collect_list("vec_id").alias("ids"))
    again = store.keep(again.join(points.select(*keys, F.col("point").alias("near")), keys).select("near", "ids"), "nn-ids")
    popular = skew.hot_of(store.keep(found.groupBy("near").agg(F.count(F.lit(1)).alias("rows")), "nn-popular"), ["near"])
    each = skew.look_up(found, again, ["near"], popular, "left").select("point", (-F.col("score")).alias("minus"), F.explode(F.coalesce("ids", F.array("lead"))).alias("vec_id"))
    listed = each.groupBy("point").agg(F.slice(F.sort_array(F.collect_list(F.struct("minus", "vec_id"))), 1, top + 1).alias("near"))
    mine = skew.look_up(asked, store.keep(listed, "nn-lists"), ["point"], skew.hot_of(asked_points, ["point"]))
    mine = mine.select("query_id", F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, top)).alias("at", "near"))
    return mine.select("query_id", (F.col("at") + 1).alias("rank"), F.col("near.vec_id").alias("vec_id"), (-F.col("near.minus")).alias("score"))
