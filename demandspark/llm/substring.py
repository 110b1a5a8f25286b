"""Substring dedup: words of long passages that an earlier document already has are removed.

A window is ``WINDOW`` consecutive words. A word goes if some window over it also starts in a document with a smaller
doc_id. Rather than comparing all windows, only anchors are hashed at first: runs of ``WINDOW - PERIOD + 1`` words
that start at positions whose remainder modulo ``PERIOD`` is in a difference cover. Any two residues differ by a
difference of two members of the cover, so two equal windows, wherever they start, hold the same anchor at the same
offset. The steps, all Spark jobs:

1. Anchors (64-bit, a filter only) are aggregated to the smallest and largest doc_id; those of one document go.
2. Back in the texts, each shared anchor is extended to all windows that hold it. These windows, hashed to 93 bits (61
   of them modulo a prime), are aggregated to the smallest doc_id that they start in; windows seen in one document only go.
3. Windows that start in an earlier document mark their words, and the texts are rewritten.

Every aggregation has a map side. Anchors and windows that very many rows share are joined by broadcast (``skew``), all
others by shuffle, so no passage, and no group of copies, puts its rows into one task, and no pairs are made.

Edge cases: null text has no words; texts under ``WINDOW`` words lose nothing; rows that share a doc_id are treated as
parts of one document when smaller ids are sought, and each loses its own words (a row is known by its doc_id and a hash
of its text); null doc_ids lose nothing and make no others lose; tables may be empty; other columns are ignored (op3) or
carried along, whatever their names (``remove``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.llm import skew, store
from demandspark.llm.text import FAST, SOUND, Words, rolling, slices

WINDOW = 50
PERIOD = 31
#: The perfect difference set modulo 31.
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
TEXT_ROWS = 2_000  # rows with a text that Python gets at once
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def anchor_starts(w: Words) -> np.ndarray:
    """Word numbers (within the slice) at which anchors start; positions count from each text's first word."""
    first = w.windows(ANCHOR)
    at = first - np.repeat(w.first[:-1], w.count)[first]
    return first[_IN_COVER[at % PERIOD]]


def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of each row, every one once."""
    for b in batches:
        for s in slices(b):
            w = Words(s.column("text"))
            at = anchor_starts(w)
            owner = w.text_of()
            at = at[w.count[owner[at]] >= WINDOW]
            if len(at):
                got, who = rolling(w.hashes(FAST), at, at + ANCHOR, FAST).view(np.int64), owner[at]
                order = np.lexsort((got, who))
                got, who = got[order], who[order]
                new = np.ones(len(got), dtype=bool)
                new[1:] = (got[1:] != got[:-1]) | (who[1:] != who[:-1])
                yield pa.record_batch([pa.array(got[new]), *(s.column(c).take(pa.array(who[new])) for c in ("doc_id", "print"))], ["anchor", "doc_id", "print"])


def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct windows of each text that hold one of its shared anchors; ``h2`` has 32 more bits of the hash and the first position."""
    for b in batches:
        for s in slices(b):
            w = Words(s.column("text"))
            h, g = w.hashes(FAST), w.hashes(SOUND)
            at = anchor_starts(w)
            owner = w.text_of()
            got = rolling(h, at, at + ANCHOR, FAST).view(np.int64)
            shared = s.column("shared")
            lists, sizes = shared.flatten().to_numpy(zero_copy_only=False), np.diff(shared.offsets.to_numpy())
            whose = np.repeat(np.arange(len(sizes)), sizes)
            # membership of (text, anchor) pairs, by rank of the pair
            both_text, both_hash = np.concatenate([owner[at], whose]), np.concatenate([got, lists.astype(np.int64)])
            order = np.lexsort((both_hash, both_text))
            t, x = both_text[order], both_hash[order]
            new = np.ones(len(t), dtype=bool)
            new[1:] = (t[1:] != t[:-1]) | (x[1:] != x[:-1])
            rank = np.empty(len(t), dtype=np.int64)
            rank[order] = np.cumsum(new)
            hit = at[np.isin(rank[: len(at)], rank[len(at) :])]
            # windows that start up to WINDOW - ANCHOR words before a shared anchor
            mark = np.zeros(len(h) + 1, dtype=np.int64)
            low = np.maximum(hit - (WINDOW - ANCHOR), w.first[owner[hit]])
            np.add.at(mark, low, 1)
            np.add.at(mark, hit + 1, -1)
            held = np.cumsum(mark[:-1]) > 0
            first = w.windows(WINDOW)
            first = first[held[first]]
            if len(first):
                a = rolling(g, first, first + WINDOW, SOUND).view(np.int64)
                # a window that a text repeats, once: ``kept_words`` finds the others
                order = np.lexsort((first, a, owner[first]))
                t, x = owner[first][order], a[order]
                new = np.ones(len(t), dtype=bool)
                new[1:] = (t[1:] != t[:-1]) | (x[1:] != x[:-1])
                first, a = first[order][new], x[new]
                c = rolling(h, first, first + WINDOW, FAST) >> np.uint64(32) << np.uint64(32)
                c = (c | (first - w.first[owner[first]]).astype(np.uint64)).view(np.int64)
                rows = pa.array(owner[first])
                yield pa.record_batch([pa.array(a), pa.array(c), s.column("doc_id").take(rows), s.column("print").take(rows)], ["h1", "h2", "doc_id", "print"])


def printed(docs: DataFrame, name: str = "print") -> DataFrame:
    """The documents with a hash of the text, which tells rows of one doc_id apart."""
    return docs.withColumn(name, F.xxhash64("text"))


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, print, starts): first words, from 0, of the windows that also start in an earlier document; a written table.

    Of a window that a text repeats, only the first start is told.
    """
    texts = printed(docs.where("doc_id is not null and text is not null").select("doc_id", "text"))
    found = texts.mapInArrow(anchors, "anchor long, doc_id long, print long")
    ends = [F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("rows")]
    shared = store.keep(found.groupBy("anchor").agg(*ends).where("lo < hi").select("anchor", "rows"), "sd-shared", TEXT_ROWS)
    mine = skew.look_up(found, shared.select("anchor"), ["anchor"], skew.hot_of(shared, ["anchor"]), "left_semi")
    mine = store.keep(mine.groupBy("doc_id", "print").agg(F.collect_set("anchor").alias("shared")), "sd-anchors", TEXT_ROWS)
    seen = store.keep(texts.join(mine, ["doc_id", "print"]).mapInArrow(windows, "h1 long, h2 long, doc_id long, print long"), "sd-windows", TEXT_ROWS)
    store.drop(shared, mine)
    keys = ["h1", "more"]
    more = F.shiftright("h2", 32).alias("more")
    early = store.keep(seen.groupBy("h1", more).agg(*ends).where("lo < hi").select(*keys, "lo", "rows"), "sd-early")
    late = skew.look_up(seen.select("h1", more, "doc_id", "print", "h2"), early.drop("rows"), keys, skew.hot_of(early, keys)).where("doc_id > lo")
    marks = store.keep(late.groupBy("doc_id", "print").agg(F.sort_array(F.collect_set(F.col("h2").bitwiseAND(0xFFFFFFFF).cast("int"))).alias("starts")), "sd-marks")
    store.drop(seen, early)
    return marks


def kept_words(w: Words, starts: list) -> np.ndarray:
    """Which words of the slice stay; a window goes wherever its text repeats it."""
    mark = np.zeros(len(w.start) + 1, dtype=np.int64)
    at = [w.first[i] + np.asarray(s) for i, s in enumerate(starts) if s is not None and len(s)]
    if at:
        at, owner, first = np.concatenate(at), w.text_of(), w.windows(WINDOW)
        h = rolling(w.hashes(SOUND), first, first + WINDOW, SOUND)
        own = np.isin(first, at)
        # windows equal to a marked one of the same text, by rank of (text, hash)
        order = np.lexsort((h, owner[first]))
        t, x = owner[first][order], h[order]
        rank = np.empty(len(first), dtype=np.int64)
        rank[order] = np.cumsum(np.r_[True, (t[1:] != t[:-1]) | (x[1:] != x[:-1])])
        gone = first[np.isin(rank, rank[own])]
        np.add.at(mark, gone, 1)
        np.add.at(mark, gone + WINDOW, -1)
    return np.cumsum(mark[:-1]) == 0


def rewrite(w: Words, keep: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Kept words of every text, joined by one space, and how many words went."""
    raw = w.data.tobytes()
    out, gone = [], np.zeros(len(w.count), dtype=np.int64)
    for i in range(len(w.count)):
        a, b = w.first[i], w.first[i + 1]
        k = keep[a:b]
        if k.all():
            out.append(b" ".join(raw[w.offsets[i] : w.offsets[i + 1]].split()))
        else:
            gone[i] = (~k).sum()
            out.append(b" ".join(raw[s:e] for s, e in zip(w.start[a:b][k], w.end[a:b][k], strict=True)))
    return out, gone


def digest(docs: DataFrame) -> DataFrame:
    """Rows of the contract: (doc_id, n_words, n_removed, kept_sha256)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b):
                w = Words(s.column("text"))
                texts, gone = rewrite(w, kept_words(w, s.column("starts").to_pylist()))
                yield pa.record_batch([s.column("doc_id"), pa.array(w.count, pa.int64()), pa.array(gone), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = printed(docs.select("doc_id", "text")).join(repeated(docs), ["doc_id", "print"], "left")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove(docs: DataFrame) -> DataFrame:
    """The documents with all their columns and the repeated words cut out of the texts.

    Only a text that loses words is rewritten (its words joined by one space); a document that loses all goes.
    A column n_chars, if there is one, is counted again.
    """
    names = docs.columns
    key, starts, length = (store.fresh(c, names) for c in ("print", "starts", "length"))
    marks = repeated(docs).withColumnsRenamed({"print": key, "starts": starts})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b):
                w = Words(s.column("text"))
                texts, gone = rewrite(w, kept_words(w, s.column(starts).to_pylist()))
                old = s.column("text").to_pylist()
                new = [t.decode() if g else o for t, g, o in zip(texts, gone, old, strict=True)]
                n = pa.array([len(x) if g else None for x, g in zip(new, gone, strict=True)], pa.int64())
                columns = [pa.array(new, pa.string()) if c == "text" else s.column(c) for c in names]
                yield pa.record_batch([*columns, n], [*names, length]).filter(pa.array((gone == 0) | (gone < w.count)))

    joined = printed(docs, key).join(marks, ["doc_id", key], "left").select(*names, starts)
    schema = T.StructType([*docs.schema.fields, T.StructField(length, T.LongType())])
    got = joined.mapInArrow(run, schema)
    if "n_chars" in names:
        got = got.withColumn("n_chars", F.coalesce(F.col(length), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return got.select(names)


def oracle() -> str:
    """The contract in DuckDB SQL."""
    return f"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from documents),
w as (select doc_id, i, md5(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) as h from (select doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) as i from d where len(ws) >= {WINDOW})),
late as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by h) as lo from w) where doc_id > lo),
gone as (select distinct doc_id, i + k as p from late, range({WINDOW}) as r(k)),
g as (select doc_id, list(p) as ps from gone group by doc_id),
kept as (select d.doc_id, ws, ps, case when ps is null then ws else list_transform(list_filter(range(1, len(ws) + 1), lambda p: not list_contains(ps, p)), lambda p: ws[p]) end as left_over from d left join g using (doc_id))
select doc_id, len(ws)::bigint as n_words, coalesce(len(ps), 0)::bigint as n_removed, sha256(array_to_string(left_over, ' ')) as kept_sha256 from kept"""
