"""Near-duplicate classes by b-bit MinHash, confirmed on full shingle sets.

Words are lower-cased (A-Z only); a document's set is its distinct shingles of ``WIDTH`` words. Steps, all Spark jobs:

1. One pass over the texts gives each row its set size, a 128-bit fingerprint of the set, ``BANDS * ROWS`` minima as
   band keys, and a packed signature of the lowest ``BITS`` bits of every minimum.
2. Rows with the same set form one node, so groups of copies weigh no more than one.
3. Every band bucket proposes its hub (smallest node) to each other member. The packed signatures of a pair are
   compared by counting equal bit fields; the similarity corrected for chance collisions must come within ``SLACK``
   of the threshold (over 5 standard deviations), which spares the exact check for hopeless pairs.
4. Proposed pairs are checked exactly on full sets; confirmed links are joined into components by propagating
   the smallest node, with pointer jumping.
5. A hub has then been compared with all its bucket. In buckets that still hold several components, the members outside
   the largest one (the probes, ``CHUNK`` to a task) meet all others (``PARTNERS`` to a task): first with their signatures
   alone, which tells the nodes that have a hopeful partner in another component, then these nodes with their full
   sets, a few partners at a time. Only links that join two components come out, never pairs.

So every pair of a bucket is compared or already connected. There is no cap on buckets or partners; a bucket of s members
with m outside its largest component costs s * m / CHUNK rows of signatures. Buckets, hubs, nodes and labels that very
many rows share are joined by broadcast or by salts (``skew``).

A pair at the threshold shares a band with probability ``1 - (1 - 0.75**ROWS)**BANDS``, over 0.999995. Shingles are hashed
modulo a prime (``text.SOUND``).

Edge cases: null, empty and blank texts have the empty set, size 0, and are linked with nothing (each such row stands
under its own doc_id); fewer words than ``WIDTH`` make one shingle of the whole sequence; repeated texts share a class;
rows with one doc_id and different texts are all compared, and tied together through the id; null doc_ids have class null
and link nothing; tables may be empty; other columns are ignored (``classes``) or carried along (``keep_one``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm import skew, store
from demandspark.llm.text import SOUND, Words, mix, rolling, slices

WIDTH, BANDS, ROWS, BITS = 5, 32, 4, 4
PERCENT = 75
SLACK = 0.2
CHUNK, PARTNERS = 512, 1_024
HEAVY_ROWS, TEXT_ROWS = 256, 2_000  # rows with two texts or a set, and with a text, that Python gets at once
_U = np.uint64
_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within it, and where each text's begin."""
    w = Words(texts, lower=True)
    h = w.hashes()
    first = w.windows(WIDTH)
    short = np.flatnonzero((w.count > 0) & (w.count < WIDTH))
    start = np.concatenate([first, w.first[short]])
    end = np.concatenate([first + WIDTH, w.first[short + 1]])
    owner = np.concatenate([w.text_of()[first], short])
    got = rolling(h, start, end, SOUND)
    order = np.lexsort((got, owner))
    got, owner = got[order], owner[order]
    new = np.ones(len(got), dtype=bool)
    new[1:] = (got[1:] != got[:-1]) | (owner[1:] != owner[:-1])
    got, owner = got[new], owner[new]
    return got, np.searchsorted(owner, np.arange(len(w.count) + 1))


def minima(sets: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Smallest value of every hash function over every non-empty set; one row per set."""
    some = np.flatnonzero(np.diff(edges) > 0)
    out = np.zeros((len(edges) - 1, len(_SEEDS)), dtype=np.uint64)
    if not len(some):
        return out
    at = edges[:-1][some]
    for k, seed in enumerate(_SEEDS):
        x = (sets ^ seed) * seed
        out[some, k] = np.minimum.reduceat(x ^ (x >> _U(32)), at)
    return out


def pack(low: np.ndarray) -> np.ndarray:
    """Low ``BITS`` bits of the minima, two to a byte."""
    small = (low & _U((1 << BITS) - 1)).astype(np.uint8)
    return small[:, 0::2] | (small[:, 1::2] << 4)


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s in slices(b):
            sets, edges = shingles(s.column("text"))
            n = np.diff(edges)
            low = minima(sets, edges)
            total = [np.concatenate([[_U(0)], np.cumsum(mix(sets + _U(k)))]) for k in (1, 2)]
            prints = [(t[edges[1:]] - t[edges[:-1]]).view(np.int64) for t in total]
            keys = np.zeros((len(n), BANDS), dtype=np.uint64)
            for k in range(BANDS):
                x = np.full(len(n), _U(k + 1))
                for r in range(ROWS):
                    x = mix(x * _U(31) + low[:, k * ROWS + r])
                keys[:, k] = x
            signature = pack(low)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(n) * BANDS + 1, BANDS), pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.record_batch([s.column("doc_id"), s.column("print"), pa.array(n, pa.int64()), pa.array(prints[0]), pa.array(prints[1]), bands, pa.array([x.tobytes() for x in signature], pa.binary())], ["doc_id", "print", "n", "p1", "p2", "bands", "sig"])


SKETCH = "doc_id long, print long, n long, p1 long, p2 long, bands array<long>, sig binary"


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures: share of equal bit fields, corrected for fields that are equal by chance."""
    x = a ^ b
    equal = ((x & 15) == 0).sum(1, dtype=np.int32) + ((x >> 4) == 0).sum(1, dtype=np.int32)
    chance = 2.0**-BITS
    return (equal / (2 * a.shape[1]) - chance) / (1 - chance)


def likely(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether packed signatures come within the slack of the threshold."""
    return similarity(a, b) >= PERCENT / 100 - SLACK


def signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)


def hot_ends(pairs: DataFrame, key: str, name: str) -> DataFrame:
    return skew.hot_of(store.keep(pairs.groupBy(key).agg(F.count(F.lit(1)).alias("rows")), name), [key])


def hopeful(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose estimated similarity comes within the slack of the threshold, and whose sizes allow it."""
    sig = nodes.select("node", "n", "sig")
    both = skew.look_up(pairs, sig.toDF("a", "na", "sa"), ["a"], hot_ends(pairs, "a", "nd-hubs")).join(sig.toDF("b", "nb", "sb"), "b").where(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                yield x.select(["a", "b"]).filter(pa.array(likely(signatures(x.column("sa")), signatures(x.column("sb")))))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose full shingle sets meet the threshold; the text of a hub of very many pairs is dealt out in copies by salts."""
    hot = hot_ends(pairs, "a", "nd-hubs")
    mine = skew.for_salts(texts.toDF("a", "text"), hot, "a", "salt")
    both = skew.salted(pairs, hot, "a", "b", "salt").join(mine, ["a", "salt"]).join(texts.toDF("b", "text_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for s in slices(x):
                for part in slices(s, "text_b"):
                    sa, ea = shingles(part.column("text"))
                    sb, eb = shingles(part.column("text_b"))
                    ok = []
                    for i in range(part.num_rows):
                        a, b = sa[ea[i] : ea[i + 1]], sb[eb[i] : eb[i + 1]]
                        common = len(np.intersect1d(a, b, assume_unique=True))
                        ok.append(common > 0 and 100 * common >= PERCENT * (len(a) + len(b) - common))
                    yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "text", "text_b").mapInArrow(run, "a long, b long")


def whole(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = HEAVY_ROWS) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Rows of a sorted partition cut where the keys change, and after ``most`` rows."""
    for b in batches:
        if not b.num_rows:
            continue
        k = np.column_stack([b.column(c).to_numpy() for c in keys])
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1), len(k)]
        for x, y in zip(cuts, cuts[1:], strict=False):
            for at in range(x, y, most):
                yield tuple(k[x]), b.slice(at, min(most, y - at))


def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s in slices(b):
            sets, edges = shingles(s.column("text"))
            yield pa.record_batch([s.column("node"), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(sets.view(np.int64)))], ["node", "set"])


class Members:
    """Rows of one bucket as arrays."""

    def __init__(self, rows: pa.RecordBatch):
        self.node, self.n, self.comp, self.minor = (rows.column(x).to_numpy(zero_copy_only=False) for x in ("node", "n", "comp", "minor"))
        self.keys = rows.column("bands").flatten().to_numpy().reshape(len(self.node), -1)
        self.sig = signatures(rows.column("sig"))
        if "set" in rows.schema.names:
            s = rows.column("set")
            self.edges, self.values = s.offsets.to_numpy() - s.offsets[0].as_py(), s.flatten().to_numpy().view(np.uint64)  # sorted as such


def candidates(probes: Members, others: Members, bucket: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (probe, other) of different components, allowed by size and signature, and met in no earlier band.

    Of two members outside the largest component, the smaller node is the probe.
    """
    small, big = np.minimum(probes.n[:, None], others.n), np.maximum(probes.n[:, None], others.n)
    ok = (100 * small >= PERCENT * big) & (probes.comp[:, None] != others.comp) & (~others.minor | (probes.node[:, None] < others.node))
    p, o = np.nonzero(ok)
    if len(p):
        band = int(np.flatnonzero(probes.keys[0] == bucket)[0])
        keep = likely(probes.sig[p], others.sig[o])
        p, o = p[keep], o[keep]
        keep = ~(probes.keys[p, :band] == others.keys[o, :band]).any(1)
        p, o = p[keep], o[keep]
    return p, o


def meet(batches: Iterator[pa.RecordBatch], each) -> Iterator[pa.RecordBatch]:
    """For every group of probes: the rows that ``each(probes, bucket)`` makes of the others, a few at a time (a generator's send)."""
    now, held, going = None, [], None
    for key, piece in runs(batches, ["bucket", "i", "j"]):
        if key != now:
            now, held, going = key, [], None
        first = int(np.count_nonzero(piece.column("role").to_numpy() == 0))
        if first:
            held.append(piece.slice(0, first))
        if first < piece.num_rows and held:
            going = going or each(Members(whole(held)), key)
            if (got := going(Members(piece.slice(first)))) is not None:
                yield got


def screen(probes: Members, key: tuple):
    """Nodes with a hopeful partner, each with its role in the group; a probe once."""
    told = np.zeros(len(probes.node), dtype=bool)

    def one(others: Members) -> pa.RecordBatch | None:
        p, o = candidates(probes, others, key[0])
        if not len(p):
            return None
        p, o = np.unique(p), np.unique(o)
        p = p[~told[p]]
        told[p] = True
        n = len(p) + len(o)
        nodes, role = np.r_[probes.node[p], others.node[o]], np.r_[np.zeros(len(p)), np.ones(len(o))]
        comp, minor = np.r_[probes.comp[p], others.comp[o]], np.r_[probes.minor[p], others.minor[o]]
        return pa.record_batch([*(pa.array(np.full(n, k), t) for k, t in zip(key, (pa.int64(), pa.int32(), pa.int32()), strict=True)), pa.array(role, pa.int32()), pa.array(nodes), pa.array(comp), pa.array(minor)], ["bucket", "i", "j", "role", "node", "comp", "minor"])

    return one


def join_group(probes: Members, key: tuple):
    """Links between components found with full sets, no more than connect what is connected in the group."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while x in root:
            x = root[x]
        return x

    def one(others: Members) -> pa.RecordBatch | None:
        out = []
        p, o = candidates(probes, others, key[0])
        for k in np.unique(p):
            mine = probes.values[probes.edges[k] : probes.edges[k + 1]]
            at = np.minimum(np.searchsorted(mine, others.values), len(mine) - 1)
            hit = np.r_[0, np.cumsum(mine[at] == others.values)]
            common = hit[others.edges[1:]] - hit[others.edges[:-1]]
            for m in o[p == k]:
                a, b = find(int(probes.comp[k])), find(int(others.comp[m]))
                if a != b and 100 * common[m] >= PERCENT * (probes.n[k] + others.n[m] - common[m]):
                    root[max(a, b)] = min(a, b)
                    out.append((int(probes.node[k]), int(others.node[m])))
        return pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b"]) if out else None

    return one


def across(members: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Confirmed links (a, b) between components of a bucket; members are (bucket, node, comp, minor, size, outside)."""
    keys = ["bucket", "i", "j"]
    chunks, parts = F.ceil(F.col("outside") / CHUNK).cast("int"), F.ceil(F.col("size") / PARTNERS).cast("int")
    mine, all_of = lambda n: F.pmod(F.xxhash64("node"), n).cast("int"), lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    cut = members.withColumns({"_c": chunks, "_p": parts})
    who = ["node", "comp", "minor"]
    probes = cut.where("minor").select("bucket", mine(F.col("_c")).alias("i"), all_of(F.col("_p")).alias("j"), F.lit(0).alias("role"), *who)
    others = cut.select("bucket", all_of(F.col("_c")).alias("i"), mine(F.col("_p")).alias("j"), F.lit(1).alias("role"), *who)
    meeting = lambda rows, each, form: rows.repartition(*keys).sortWithinPartitions(*keys, "role").mapInArrow(lambda batches: meet(batches, each), form)
    known = nodes.select("node", "n", "sig", "bands")
    open_ = store.keep(meeting(probes.unionByName(others).join(known, "node"), screen, "bucket long, i int, j int, role int, node long, comp long, minor boolean"), "nd-open")
    wanted = open_.select("node").distinct()
    full = store.keep(texts.join(wanted, "node", "left_semi").mapInArrow(sets_of, "node long, set array<long>").join(known, "node"), "nd-sets", HEAVY_ROWS)
    got = store.keep(meeting(open_.join(full, "node"), join_group, "a long, b long").distinct(), "nd-across", HEAVY_ROWS)
    store.drop(open_, full)
    return got


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of all ends of edges: the smallest node reachable. Rounds of smallest-neighbour steps with pointer jumping."""
    both = store.keep(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct(), "nd-edges")
    hubs = hot_ends(both, "y", "nd-degrees")
    labels = store.keep(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("comp")), "nd-labels")
    while True:
        near = skew.look_up(both, labels.select(F.col("x").alias("y"), "comp"), ["y"], hubs).groupBy("x").agg(F.min("comp").alias("near"))
        step = store.keep(labels.join(near, "x").select("x", F.least("comp", "near").alias("best"), F.col("comp").alias("was")), "nd-step")
        # the label of one's label is at least as small
        up = labels.select(F.col("x").alias("best"), F.col("comp").alias("up"))
        after = skew.look_up(step, up, ["best"], hot_ends(step, "best", "nd-popular")).select("x", F.least("best", "up").alias("comp"), "was")
        after = store.keep(after, "nd-labels")
        changed = not after.where("comp <> was").isEmpty()
        store.drop(labels, step)
        labels = after
        if not changed:
            store.drop(both)
            return labels.select(F.col("x").alias("node"), "comp")


def ties(rows: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """Edges (a, b) between the nodes of each doc_id that has several; None if there is no such doc_id."""
    several = rows.groupBy("doc_id").agg(F.min("p1").alias("lo"), F.max("p1").alias("hi"), F.count(F.lit(1)).alias("rows")).where("lo <> hi")
    several = store.keep(several.select("doc_id", "rows"), "nd-several")
    if several.isEmpty():
        return None
    hot = skew.hot_of(several, ["doc_id"])
    own = skew.look_up(rows, several.select("doc_id"), ["doc_id"], hot, "left_semi").select("doc_id", "p1", "p2").distinct()
    own = store.keep(own.join(nodes.select("p1", "p2", "node"), ["p1", "p2"]).select("doc_id", "node"), "nd-ties")
    first = own.groupBy("doc_id").agg(F.min("node").alias("a"))
    return skew.look_up(own, first, ["doc_id"], hot).where("a <> node").select("a", F.col("node").alias("b"))


def link(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document row."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("print"))
    rows = store.keep(docs.mapInArrow(sketch, SKETCH).withColumn("row", F.monotonically_increasing_id()), "nd-sketch", TEXT_ROWS)
    some = rows.where("n > 0 and doc_id is not null")
    # one node per distinct set, known by the row that stands for it; the empty set is no node
    sets = ["p1", "p2"]
    copies = store.keep(some.groupBy(*sets).agg(F.min("doc_id").alias("lead"), F.min_by("row", "doc_id").alias("node"), F.count(F.lit(1)).alias("rows")), "nd-copies")
    nodes = some.withColumnRenamed("row", "node").join(copies.select("node", "lead"), "node").select("node", "lead", "print", "n", *sets, "bands", "sig")
    nodes = store.keep(nodes, "nd-nodes")
    # a band's keys have its number in them
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = store.keep(banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("rows")).where("rows > 1"), "nd-sizes")
    hot = skew.hot_of(sizes, ["bucket"])
    full = store.keep(skew.look_up(banded, sizes.withColumnRenamed("rows", "size"), ["bucket"], hot), "nd-buckets")
    proposed = store.keep(full.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "nd-proposed")
    # every later pair is among members of these buckets; their texts move once, and few others do
    key = ["doc_id", "print"]
    wanted = store.keep(nodes.join(full.select("node").distinct(), "node", "left_semi").select(F.col("lead").alias("doc_id"), "print", "node"), "nd-wanted")
    texts = store.keep(skew.may_match(docs, wanted, key, "told").where("told").drop("told").join(wanted, key).dropDuplicates(key).select("node", "text"), "nd-texts")
    maybe = store.keep(hopeful(proposed, nodes), "nd-likely")
    found = store.keep(confirm(maybe, texts), "nd-sure", HEAVY_ROWS)
    store.drop(proposed, maybe)
    comps = components(found)
    of = full.where("node <> hub and size > 2").select("bucket", "node").join(comps, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
    of = store.keep(of, "nd-of")
    shares = of.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    open_ = shares.groupBy("bucket").agg(F.max_by("comp", "n").alias("main"), F.sum("n").alias("size"), F.max("n").alias("most")).where("size > most")
    open_ = store.keep(open_.select("bucket", "main", "size", (F.col("size") - F.col("most")).alias("outside")), "nd-mixed")
    members = skew.look_up(of, open_, ["bucket"], hot).withColumn("minor", F.col("comp") != F.col("main"))
    found = found.unionByName(across(store.keep(members, "nd-members"), nodes, texts))
    tied = ties(some, nodes)
    comps = store.keep(components(found if tied is None else found.unionByName(tied)), "nd-comps")
    store.drop(sizes, full, of, texts)
    # a class is named by its smallest doc_id
    named = store.keep(comps.join(nodes.select("node", "lead"), "node").groupBy("comp").agg(F.min("lead").alias("name"), F.count(F.lit(1)).alias("rows")), "nd-named")
    names = skew.look_up(comps, named.select("comp", "name"), ["comp"], skew.hot_of(named, ["comp"])).select("node", "name")
    by_set = store.keep(nodes.select("node", "lead", *sets).join(names, "node", "left").select(*sets, F.coalesce("name", "lead").alias("component_id")), "nd-classes")
    linked = skew.look_up(some.select("doc_id", "n", *sets), by_set, sets, skew.hot_of(copies, sets)).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(rows.where("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def classes(docs: DataFrame) -> DataFrame:
    """Rows of the contract: (doc_id, n_shingles, component_id, kept)."""
    return link(docs).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Documents with one of each class kept: the one of smallest doc_id."""
    out = store.keep(link(docs).where("doc_id <> component_id").select("doc_id").distinct(), "nd-out")
    # only rows that may have to go are shuffled
    told = store.fresh("_told", docs.columns)
    rows = skew.may_match(docs, out, ["doc_id"], told)
    return rows.where(~F.col(told)).select(docs.columns).unionByName(rows.where(told).join(out, "doc_id", "left_anti").select(docs.columns))


def oracle() -> str:
    """DuckDB SQL for ``classes``: all pairs of documents that share a shingle, and what is reachable over their links."""
    return r"""with recursive words as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
starts as (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from words where len(w) > 0),
sets as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s from starts),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
shared as (select a.doc_id as x, b.doc_id as y, count(*) as n from sets a join sets b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
reach as (select doc_id, doc_id as y from documents union select r.doc_id, l.y from reach r join links l on l.x = r.y)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join sizes s on s.doc_id = d.doc_id join (select doc_id, min(y) as component_id from reach group by doc_id) c on c.doc_id = d.doc_id"""
