"""Phrases whose words stand together oftener than apart, by marginalising the counts of the longest windows.

Counting phrases of 1 to 4 words by exploding each text four times moves four times the rows. Here each word makes one
row at most: its window of itself and the three words behind it (four lead columns w1 to w4), padded where the piece
ends. Only these longest windows are counted; ROLLUP over (lang, w1, w2, w3, w4) then sums them over ever shorter prefixes,
and as each occurrence of a phrase is the prefix of exactly one window, the sum at a prefix is the phrase's count. The
level of lang alone is the number of words.

A phrase is wanted only from ``least`` occurrences on, and none is more frequent than a word, or a shorter phrase, in it. So
windows are shortened before they are summed, without changing the count of any phrase that is wanted:

1. Words are counted by hash, and those under ``least`` end a window. The others are told to the tasks as a bitmap of fixed size;
   colliding hashes keep windows that could have been cut, never the other way round.
2. Windows move once, to a part of the table by their first two words, where sums over their first 2, 3 and 4 words are
   exact; what is under ``least`` is padding from there on. So few rows are left for ROLLUP, whose shorter prefixes sum
   exactly what they did.

There are as many parts as keep each at about ``PART_WORDS`` words, whatever the table. As most windows occur once, a window
costs what its row costs: so a slice of texts sends each part one row with all its windows, as numbers into a list of the slice's words,
compressed. Pairs of two words that each hold over 1/``SHARE`` of all words are dealt by their third word too (their first
two words are then never cut off), and words alone by slices, so that no part gets a frequent one's rows. Windows are
added up within a slice, where words are numbered by Arrow's dictionary; no equality is decided by a hash.

Edge cases: null texts count as empty ones; a null lang is ``und``; repeated rows, and rows with null or repeated doc_ids,
count each; phrases never cross a separator; ties in score are broken by count, then by the bytes of the phrase; products
are decimals of 38 digits; with fewer phrases than ``top`` all are given; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandspark.llm import skew, store
from demandspark.llm import text as T

ORDER = 4
WORDS = [f"w{k}" for k in range(1, ORDER + 1)]
SEPARATORS = np.frombuffer(b".,;:!?\n\x0b\x0c\r", dtype=np.uint8)
SLICE_BYTES, PART_WORDS, LOTS = 1 << 22, 3 << 20, 8
#: Bits of the bitmap of frequent words: 8 MB, whatever the table.
BITS = 1 << 26
#: Fewer than SHARE words hold over 1/SHARE of all words; a pair of two of them is dealt out SALTS times.
SHARE, SALTS = 1_000, 64

_U = np.uint64
_SEPARATES = np.zeros(256, dtype=bool)
_SEPARATES[SEPARATORS] = True
_BREAKS = _SEPARATES.copy()
_BREAKS[[9, 32]] = True
_BIT = (1 << np.arange(8)).astype(np.uint8)


class Slice:
    """Words of a slice of texts, numbered by (lang, word): ``code`` of each, and whether the next one is in the same piece."""

    def __init__(self, batch: pa.RecordBatch):
        offsets, data = T.buffers(batch.column("text"))
        data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        word = ~_BREAKS[data]
        opens, closes = word.copy(), word.copy()
        opens[1:] &= ~word[:-1] | edge[1:-1]
        closes[:-1] &= ~word[1:] | edge[1:-1]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.n = len(start)
        bounds = np.zeros(self.n + 1, dtype=np.int64)
        np.cumsum(end - start, out=bounds[1:])
        words = pa.LargeStringArray.from_buffers(self.n, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[word])))
        coded = words.dictionary_encode()
        names, number = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        del words, word, opens, closes, edge, coded
        doc = (np.searchsorted(offsets, start, side="right") - 1).astype(np.int32)
        piece = np.cumsum(_SEPARATES[data], dtype=np.int32)[start]
        self.joined = np.zeros(self.n, dtype=bool)
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])
        langs = batch.column("lang").cast(pa.large_string()).fill_null("und").dictionary_encode()
        self.langs = langs.dictionary
        lang = langs.indices.to_numpy(zero_copy_only=False)[doc] if self.n else np.zeros(0, dtype=np.int64)
        # words of each language apart
        size = max(1, len(names))
        pair, self.code = np.unique(lang.astype(np.int64) * size + number, return_inverse=True)
        self.words, self.lang = names.take(pa.array(pair % size)), pair // size  # by code
        self.hashes = T.mix(hashes(self.words) + T.mix(hashes(self.langs))[self.lang] * _U(3)).view(np.int64)


def hashes(words: pa.Array) -> np.ndarray:
    offsets, data = T.buffers(words)
    return T.rolling(T._BYTES[data], offsets[:-1], offsets[1:], T.FAST)


def joined_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    for b in batches:
        for s in T.slices(b, "text", SLICE_BYTES):
            got = Slice(s)
            if got.n:
                yield got


def frequent(docs: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bitmap of the hashes of words of at least ``least`` occurrences, hashes of words with over 1/SHARE of all, number of words)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in joined_slices(batches):
            yield pa.record_batch([pa.array(s.hashes), pa.array(np.bincount(s.code, minlength=len(s.hashes)))], ["h", "n"])

    counted = store.keep(docs.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "ph-words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    hot = counted.where(F.col("n") * SHARE > total).select("h").toArrow().column("h").to_numpy()  # fewer than SHARE
    at = F.col("h").bitwiseAND(F.lit(BITS - 1)) + 1
    maps = counted.where(F.col("n") >= least).groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bits = np.zeros(BITS // 8, dtype=np.uint8)
    for r in maps.collect():  # at most 2,048 rows of 4 KB
        bits[(r.part - 1) * 4096 : r.part * 4096] = np.frombuffer(r.bits, dtype=np.uint8)
    store.drop(counted)
    return bits, np.sort(hot), total


class Windows:
    """Padded longest windows of a part of a slice: ``codes`` (4 by windows, from 1, the first ascending) into ``keys``, 0 for padding.

    A key is a word, a tab, which no word holds, and its language.
    """

    def __init__(self, keys: pa.LargeStringArray, codes: np.ndarray, n: np.ndarray, dealt: np.ndarray):
        self.keys, self.codes, self.n, self.dealt = keys, codes, n, dealt

    def pack(self) -> bytes:
        offsets, data = T.buffers(self.keys)
        codes = self.codes.astype(np.uint16 if len(self.keys) < 1 << 16 else np.uint32)
        codes[0, 1:] -= codes[0, :-1].copy()  # small differences take little room
        head = np.array([len(self.keys), len(self.n), len(data), codes.itemsize], dtype=np.int64)
        raw = b"".join(x.tobytes() for x in (head, np.diff(offsets).astype(np.uint32), data, codes, self.n.astype(np.uint32), self.dealt.astype(np.uint8)))
        return np.int64(len(raw)).tobytes() + pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)

    @staticmethod
    def unpack(packed: bytes) -> Windows:
        raw = pa.decompress(packed[8:], decompressed_size=int(np.frombuffer(packed[:8], dtype=np.int64)[0]), codec="zstd")
        k, m, size, width = (int(x) for x in np.frombuffer(raw, dtype=np.int64, count=4))
        at = 32

        def take(kind, count: int) -> np.ndarray:
            nonlocal at
            at += count * np.dtype(kind).itemsize
            return np.frombuffer(raw, dtype=kind, count=count, offset=at - count * np.dtype(kind).itemsize)

        offsets = np.r_[np.int64(0), np.cumsum(take(np.uint32, k), dtype=np.int64)]
        keys = pa.LargeStringArray.from_buffers(k, pa.py_buffer(offsets), pa.py_buffer(take(np.uint8, size)))
        codes = take(np.uint16 if width == 2 else np.uint32, ORDER * m).reshape(ORDER, m).copy()
        codes[0] = np.cumsum(codes[0], dtype=codes.dtype)
        # copies, so that what was decompressed is given back
        return Windows(pa.concat_arrays([keys]), codes, take(np.uint32, m).copy(), take(np.uint8, m).copy())


def numbers(values: np.ndarray) -> np.ndarray:
    """Place of each value among the distinct ones."""
    return np.unique(values, return_inverse=True)[1]


def cut_windows(s: Slice, number: int, bits: np.ndarray, hot: np.ndarray, parts: int) -> Iterator[tuple[int, Windows]]:
    """The slice's windows by part."""
    at = s.hashes & np.int64(BITS - 1)
    may = ((bits[at >> 3] & _BIT[at & 7]) > 0)[s.code]
    goes_on = np.zeros(s.n, dtype=bool)
    goes_on[:-1] = s.joined[:-1] & may[:-1] & may[1:]
    # code + 1 of the words of a window, 0 for padding; behind the words stands an empty one of each language, for words that are cut
    empty = len(s.hashes) + s.lang[s.code]
    codes = np.zeros((ORDER, s.n), dtype=np.int32)
    codes[0] = np.where(may, s.code, empty) + 1
    alive = np.ones(s.n, dtype=bool)
    for k in range(1, ORDER):
        alive[: s.n - k + 1] &= goes_on[k - 1 :]
        alive[s.n - k :] = False
        codes[k, : s.n - k] = np.where(alive[: s.n - k], codes[0, k:], 0)
    size = np.int64(len(s.hashes) + len(s.langs) + 1)
    # two of them make one number, so equality is exact
    whole = numbers(codes[0] * size + codes[1])
    last = numbers(codes[2] * size + codes[3])
    whole *= last.max(initial=0) + 1
    whole += last
    del last, alive, goes_on, may
    at, n = np.unique(whole, return_index=True, return_counts=True)[1:]
    codes = codes[:, at]
    del whole, at
    by = np.r_[np.int64(0), s.hashes, np.zeros(len(s.langs), dtype=np.int64)]
    common = np.isin(by, hot)
    dealt = common[codes[0]] & common[codes[1]] & (codes[1] > 0)
    salt = np.where(codes[1] == 0, number % SALTS, np.where(dealt, by[codes[2]] % SALTS, 0)).astype(_U)
    part = (T.mix(by[codes[0]].view(_U) * _U(0x9E3779B97F4A7C15) + by[codes[1]].view(_U) * _U(3) + salt) % _U(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    codes, n, dealt, part = codes[:, order], n[order], dealt[order], part[order]
    langs = s.langs.take(pa.array(np.r_[s.lang, np.arange(len(s.langs))]))
    words = pa.concat_arrays([s.words, pa.array([""] * len(s.langs), pa.large_string())])
    keys = pc.binary_join_element_wise(words, langs, pa.scalar("\t", pa.large_string()))
    borders = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
    place = np.zeros(len(keys) + 1, dtype=np.int64)
    for a, b in zip(borders, borders[1:], strict=False):
        own = codes[:, a:b]
        used = np.flatnonzero(np.bincount(own.ravel(), minlength=len(place))[1:]) + 1
        place[used] = np.arange(1, len(used) + 1)  # in the same order
        yield int(part[a]), Windows(keys.take(pa.array(used - 1)), place[own], n[a:b], dealt[a:b])


def shortened(packed: list[bytes], least: int) -> Iterator[pa.RecordBatch]:
    """(lang, w1, w2, w3, w4, n) of a part, with padding in place of what makes the first 2, 3 or 4 words less frequent than ``least``."""
    found = [Windows.unpack(x) for x in packed]
    keys = pa.chunked_array([w.keys for w in found]).combine_chunks().dictionary_encode()
    known, place = keys.dictionary, keys.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
    n, dealt = (np.concatenate([getattr(w, c) for w in found]) for c in ("n", "dealt"))
    codes, key, at = np.empty((ORDER, len(n)), dtype=np.int32), 0, 0
    for w in found:
        own = np.r_[np.int32(0), place[key : key + len(w.keys)]]
        for k in range(ORDER):
            codes[k, at : at + len(w.n)] = own[w.codes[k]]
        key, at = key + len(w.keys), at + len(w.n)
    del found, keys, place
    parts = pc.split_pattern(known, "\t", max_splits=1)
    words, langs = (pa.concat_arrays([pa.array([""], pa.large_string()), pc.list_element(parts, k)]) for k in (0, 1))
    # windows that begin with the same word go together; the lots need not be worked on at once
    lot = codes[0] % LOTS
    for k in range(LOTS):
        own = np.flatnonzero(lot == k)
        cut, total = summed(codes[:, own], n[own], dealt[own], len(known) + 1, least)
        yield pa.record_batch([langs.take(pa.array(cut[0])).cast(pa.string()), *(words.take(pa.array(c)).cast(pa.string()) for c in cut), pa.array(total)], ["lang", *WORDS, "n"])


def summed(codes: np.ndarray, n: np.ndarray, dealt: np.ndarray, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows cut to what is frequent, each once, with their counts."""
    prefix, weight = codes[0].astype(np.int64), n.astype(np.float64)
    for k in range(1, ORDER):
        prefix *= size
        prefix += codes[k]
        prefix = numbers(prefix)
        rare = (np.bincount(prefix, weights=weight) < least)[prefix]  # sums below 2 ** 53
        codes[k:, rare & (dealt == 0) if k == 1 else rare] = 0
    whole, last = numbers(codes[0].astype(np.int64) * size + codes[1]), numbers(codes[2].astype(np.int64) * size + codes[3])
    _, at, where = np.unique(whole * (last.max(initial=0) + 1) + last, return_index=True, return_inverse=True)
    total = np.zeros(len(at), dtype=np.int64)
    np.add.at(total, where, n)
    return codes[:, at], total


def windows(docs: DataFrame, least: int, part_words: int = PART_WORDS) -> DataFrame:
    """(lang, w1, w2, w3, w4, n): padded longest windows, shortened to what is frequent and added up within parts. Padding is an empty word."""
    spark = docs.sparkSession
    bits, hot, total = frequent(docs, least)
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-total // part_words))
    known = spark.sparkContext.broadcast((bits, hot))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, s in enumerate(joined_slices(batches)):
            own = [(part, w.pack()) for part, w in cut_windows(s, number, *known.value, parts)]
            yield pa.record_batch([pa.array([x for x, _ in own], pa.int32()), pa.array([x for _, x in own], pa.binary())], ["part", "windows"])
        pa.default_memory_pool().release_unused()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for part, packed in zip(b.column("part").to_pylist(), b.column("windows").to_pylist(), strict=True):
                if part != now and held:
                    yield from shortened(held, least)
                    held = []
                now = part
                held.append(packed)
        if held:
            yield from shortened(held, least)

    dealt = docs.mapInArrow(deal, "part int, windows binary").repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(add, "lang string, " + ", ".join(f"{w} string" for w in WORDS) + ", n long")


def counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, w1, w2, w3, w4, f): every phrase of up to four words with its count from ``least`` on (missing words null), and each lang's number of words.

    Rows of ROLLUP that end in padding repeat the row of the shorter prefix; the condition goes below the aggregation.
    """
    rolled = windows(docs, least).rollup("lang", *WORDS).agg(F.sum("n").alias("f"))
    last = F.coalesce(*reversed([F.col(w) for w in WORDS]))
    return rolled.where("lang is not null").where(last.isNull() | (last != "")).where((F.col("f") >= least) | F.col("w1").isNull())


def phrase(words: list[Column]) -> Column:
    """Words by single spaces; a word holds none, so phrases are equal if their words are."""
    return F.concat_ws(" ", *words)


def score_of() -> Column:
    """floor(2000000 * a / (l + r)) of three counts, exactly."""
    return F.expr("cast(2000000 * cast(a as decimal(27, 0)) div (cast(l as decimal(27, 0)) + cast(r as decimal(27, 0))) as long)")


def collocations(docs: DataFrame, least: int = 30, top: int = 2_000, inside_percent: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to 4 words, from ``least`` occurrences on."""
    docs = docs.select("text", F.col("lang").cast("string").alias("lang")).where("text is not null")
    words = [F.col(w) for w in WORDS]
    length = sum((w.isNotNull().cast("int") for w in words), F.lit(0))
    every = store.keep(counts(docs, least).select("lang", length.alias("k"), phrase(words).alias("phrase"), F.array_compact(F.array(*words)).alias("words"), "f"), "ph-counts")
    n = every.where("k = 0").select("lang", F.col("f").alias("n"))
    known = every.where("k between 1 and 3").select("lang", F.col("phrase").alias("part"), "f")
    found = every.where("k >= 2").select("lang", "phrase", "k", "words", F.col("f").alias("a"))

    # a row per cut and side; a part can be part of very many phrases
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    first, rest = F.slice("words", 1, F.col("cut")), F.slice("words", F.col("cut") + 1, F.col("k") - F.col("cut"))
    sides = F.explode(F.array(F.struct(F.lit("l").alias("side"), F.concat_ws(" ", first).alias("part")), F.struct(F.lit("r").alias("side"), F.concat_ws(" ", rest).alias("part"))))
    parts = found.select("lang", "phrase", "a", "k", "words", cut).select("lang", "phrase", "a", "cut", sides.alias("_s")).select("lang", "phrase", "a", "cut", "_s.side", "_s.part")
    parts = store.keep(parts, "ph-parts")
    popular = skew.hot_of(store.keep(parts.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("rows")), "ph-popular"), ["lang", "part"])
    sized = skew.look_up(parts, known, ["lang", "part"], popular)
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("f")))
    scored = sized.groupBy("lang", "phrase", "a", "cut").agg(of("l").alias("l"), of("r").alias("r"))
    lowest = scored.withColumn("score", score_of()).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("_m"))

    # what a longer candidate covers: its parts of two words and more
    spans = [(i, m) for m in range(2, ORDER) for i in range(1, ORDER - m + 2)]
    inner = F.explode(F.array_compact(F.array(*(F.when((F.col("k") > m) & (F.col("k") >= i + m - 1), F.concat_ws(" ", F.slice("words", i, m))) for i, m in spans))))
    covering = found.where("k > 2").select("lang", F.col("a").alias("_f"), inner.alias("phrase")).groupBy("lang", "phrase").agg(F.max("_f").alias("_longer"))
    exact = lambda c, by: F.col(c).cast("decimal(27,0)") * by
    own = lowest.join(covering, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (exact("_longer", 100) < exact("a", inside_percent)))
    own = own.select("lang", "phrase", "a", "_m.l", "_m.r", "_m.score")

    # in two steps, as a language may hold most phrases
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = own.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("_rn", F.row_number().over(W.partitionBy("lang", "_salt").orderBy(*best))).where(F.col("_rn") <= top)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    # a row per language
    return ranked.join(F.broadcast(n), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle() -> str:
    """DuckDB SQL for ``collocations``: all windows of 1 to 4 words by unnesting."""
    return r"""with pieces as (select coalesce(lang, 'und') as lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') as w
  from (select lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents where text is not null)),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces where len(w) > 0),
grams as (select lang, k, w[i:i + k - 1] as words, count(*) as f from starts, (select unnest([1, 2, 3, 4]) as k) where i + k - 1 <= len(w) group by all),
n as (select lang, sum(f)::bigint as n from grams where k = 1 group by lang),
found as (select lang, k, words, f as a from grams where k >= 2 and f >= 30),
cuts as (select lang, k, words, a, unnest(range(1, k)) as c from found),
scored as (select x.lang, x.words, x.a, c, p.f as l, q.f as r, (2000000::hugeint * x.a // (p.f + q.f))::bigint as score from cuts x join grams p on p.lang = x.lang and p.words = x.words[1:c] join grams q on q.lang = x.lang and q.words = x.words[c + 1:]),
lowest as (select * from scored qualify row_number() over (partition by lang, words order by score, c) = 1),
covered as (select f.lang, f.words[i:i + m - 1] as words, max(a) as longer from found f, (select unnest([1, 2, 3]) as i), (select unnest([2, 3]) as m) where m < f.k and i + m - 1 <= f.k group by all),
own as (select lang, array_to_string(words, ' ') as phrase, a, l, r, score from lowest left join covered using (lang, words) where longer is null or 100::hugeint * longer < 80::hugeint * a)
select lang, row_number() over v as rank, phrase, a, l, r, n, score from own join n using (lang) window v as (partition by lang order by score desc, a desc, phrase) qualify row_number() over v <= 2000"""
