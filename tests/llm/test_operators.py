"""Operators against brute force on small rows: nulls, empty and long texts, ties, copies, extra columns, empty tables."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction
from html import unescape
from math import comb

import numpy as np
import pytest
from demandspark.llm import html, mixing, neardup, neighbours, quality, rules, sharding, skew, substring, toxicity
from pyspark.sql import functions as F

WORD = re.compile("[^\x20\x09-\x0d]+")
FORM = "doc_id long, text string, lang string, source string, n_chars long, size string"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 7))) for _ in range(400)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    base, passage = say(120), say(60)
    texts = [None, "", "   \n ", "one two", "One TWO", " ".join(base)]
    for _ in range(40):  # near copies of a base that is not the first of them
        copy = list(base)
        for k in r.sample(range(120), 3):
            copy[k] = "x" + r.choice(words)
        texts.append(" ".join(copy))
    texts[5], texts[30] = texts[30], texts[5]
    texts += [" ".join(say(30) + passage + say(30)) for _ in range(6)] + ["dup line\n" * 40] * 3 + [" ".join(say(9000))]
    texts += [" ".join(say(r.randrange(1, 200))) for _ in range(20)] + [texts[-1], texts[-2]]
    texts += ["over and " * 90, "x " * 30 + "over and " * 70 + " ".join(say(60)) + " over and" * 40, " ".join([*passage, *say(5), *passage])]
    return [(i, t, "en" if i % 3 else None, "hot" if i % 2 else f"s{i % 5}" if i % 7 else None, 1, "x") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, FORM)


def components(rows):
    sets = {}
    for i, t, *_ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def shuffled_bytes(spark):
    """Bytes that all stages of the session have written for shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    none = sc._jvm.java.util.ArrayList()
    stages = sc._jsc.sc().statusStore().stageList(none, False, False, sc._gateway.new_array(sc._jvm.double, 0), none)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_neardup_shuffles_no_texts_without_a_match(spark):
    """Whole texts of all rows went through two shuffles and a sort, which filled the executors' memory."""
    r = random.Random(8)
    rows = [(i, " ".join("".join(r.choices("abcdefghijklmnop", k=9)) for _ in range(2000))) for i in range(150)]
    rows += [(1000, rows[0][1] + " more"), (1001, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).persist()
    assert docs.count() == 152
    before = shuffled_bytes(spark)
    got = {x.doc_id for x in neardup.keep_one(docs).collect()}
    assert got == set(range(150))
    moved, texts = shuffled_bytes(spark) - before, sum(len(t) for _, t in rows)
    assert moved < texts / 4, (moved, texts)


@pytest.mark.parametrize("bits", [1, 8, 1 << 25])
def test_rows_that_may_match_include_all_that_do(spark, monkeypatch, bits):
    """Also with a bitmap that is full, with null keys, and with an empty table."""
    monkeypatch.setattr(skew, "BITS", bits)
    rows = spark.createDataFrame([(None, "a"), *((i, "b") for i in range(-500, 500))], "_part long, _bits string")
    table = spark.range(-600, 600, 7).toDF("_part")
    told = skew.may_match(rows, table, ["_part"], "told")
    assert told.columns == ["_part", "_bits", "told"] and told.count() == 1001
    assert told.where("told").join(table, "_part").count() == rows.join(table, "_part").count() > 0
    assert not skew.may_match(rows, table.where("false"), ["_part"], "told").where("told").count()
    if bits > 8:
        assert told.where("told").count() < 200


def test_neardup_equals_brute_force(docs, rows):
    want = components(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.classes(docs).collect()}
    assert got == want
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}
    assert neardup.classes(docs.limit(0)).count() == 0


def test_group_links_connect_through_a_middle():
    import pyarrow as pa

    r = np.random.default_rng(1)
    middle = np.sort(r.choice(10**9, 100, replace=False))
    sets = [np.sort(np.r_[np.delete(middle, r.choice(100, 12, replace=False)), 10**9 + 100 * k + np.arange(12)]) for k in range(12)] + [middle]
    n = len(sets)
    low = neardup.minima(np.concatenate(sets).astype(np.uint64), np.cumsum([0, *map(len, sets)]))
    form = {"bucket": pa.array([7] * n, pa.int64()), "i": pa.array([0] * n, pa.int32()), "j": pa.array([0] * n, pa.int32()), "node": pa.array(range(n), pa.int64()), "comp": pa.array(range(n), pa.int64()), "minor": pa.array([True] * n), "n": pa.array(map(len, sets), pa.int64()), "sig": pa.array([x.tobytes() for x in neardup.pack(low)], pa.binary()), "bands": pa.array([[7]] * n, pa.list_(pa.int64())), "set": pa.array(sets, pa.list_(pa.int64()))}
    both = [pa.record_batch([*form.values(), pa.array([role] * n, pa.int32())], [*form, "role"]) for role in (0, 1)]
    seen = {(x["role"], x["node"]) for b in neardup.meet(iter(both), neardup.screen) for x in b.to_pylist()}
    assert {i for _, i in seen} == set(range(n))
    root = list(range(n))
    for b in neardup.meet(iter(both), neardup.join_group):
        for x in b.to_pylist():
            a, b_ = root[x["a"]], root[x["b"]]
            root = [min(a, b_) if y in (a, b_) else y for y in root]
    assert set(root) == {0}


def complement(n):
    """A Thue-Morse word of 2**n letters and its complement: equal under any polynomial hash modulo 2**64."""
    w = "a"
    for _ in range(n):
        w += w.translate(str.maketrans("ab", "ba"))
    return w, w.translate(str.maketrans("ab", "ba"))


def test_unlike_words_with_equal_fast_hashes_stay_unlike(spark):
    a, b = complement(10)
    rest = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, a), (4, b), (5, f"{a} {a} {a} {b} {b}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in neardup.classes(docs).collect()}
    assert got[3].component_id == 3 and got[4].component_id == 4
    # the 12 windows of row 2 with the first word differ from those of row 1 only in it
    cut = {r.doc_id: r.n_removed for r in substring.digest(docs).collect()}
    assert cut == {1: 0, 2: 60, 3: 0, 4: 0, 5: 0}


def test_rows_that_share_an_id_keep_to_their_own_texts(spark):
    r = random.Random(9)
    say = lambda n: [r.choice("abcdefghij") + str(r.randrange(300)) for _ in range(n)]
    one, two, other = say(90), say(90), say(60)
    near = lambda w: " ".join([*w[:-2], "x", "y"])
    rows = [(1, " ".join(one)), (2, " ".join(two)), (9, near(one)), (9, near(two)), (9, None), (None, " ".join(one)), (12, " ".join(other)), (12, " ".join(other))]
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == [(0, 86, 0), (1, 86, 1), (2, 86, 1), (9, 0, 9), (9, 86, 1), (9, 86, 1), (12, 56, 12), (12, 56, 12)]
    docs = spark.createDataFrame([(1, " ".join(one[:60]), 1, 2), (2, " ".join(one[:60]), 3, 4), (2, " ".join(two[:60]), 5, 6), (None, " ".join(one[:60]), 7, 8)], "doc_id long, text string, print int, starts int")
    assert sorted((r.doc_id or 0, r.n_removed) for r in substring.digest(docs).collect()) == [(0, 0), (1, 0), (2, 0), (2, 60)]
    left = substring.remove(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text, r["print"], r.starts) for r in left.collect()) == sorted([(0, " ".join(one[:60]), 7, 8), (1, " ".join(one[:60]), 1, 2), (2, " ".join(two[:60]), 5, 6)])


def test_substring_equals_brute_force(docs, rows):
    seen, want = {}, {}
    for i, t, *_ in rows:
        w = WORD.findall(t or "")
        gone, own = [False] * len(w), []
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            if seen.get(key, i) < i:
                gone[k : k + 50] = [True] * 50
            own.append(key)
        for key in own:
            seen.setdefault(key, i)
        want[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.digest(docs).collect()}
    assert got == want
    left = substring.remove(docs)
    assert left.columns == docs.columns and left.count() == sum(n == 0 or g < n for n, g, _ in want.values())


def test_cover_and_rolling():
    assert {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER} == set(range(substring.PERIOD))


def test_sharding(docs, rows):
    got = sharding.shard(docs, 7).collect()
    assert len(got) == len(rows) and len({(r.shard, r.slot) for r in got}) == len(rows)
    n = [sum(r.shard == s for r in got) for s in range(7)]
    assert max(n) - min(n) <= 1 and all(r.slot < n[r.shard] for r in got)
    text = {r[0]: r[1] or "" for r in rows}
    assert all(r.size == len(text[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in got)
    assert len({r.shard for r in got if text[r.doc_id].startswith("dup")}) == 1
    assert sharding.shard(docs.limit(0), 7).count() == 0


def test_sharding_cuts_fewer_links(spark):
    """Cut links (pairs of equal texts in two shards) by brute force: far fewer than under a hash, and none if classes fit."""
    r = random.Random(12)
    texts = [f"t{k}" for k, n in enumerate((90, 60, 40, 25, 9, 9, 5, 3, 2, 2)) for _ in range(n)] + [f"alone {i}" for i in range(155)]
    r.shuffle(texts)
    docs = spark.createDataFrame([(i if i % 50 else None, t, "x", 1) for i, t in enumerate(texts)] + [(5, None, "x", 1), (5, "", "x", 1), (6, "", "x", 1)], "doc_id long, text string, shard string, k1 int")
    got = sharding.shard(docs, 8).collect()
    assert len(got) == len(texts) + 3 and all(r.law == "rows" and r.grown_shard is None for r in got)
    n = [sum(x.shard == s for x in got) for s in range(8)]
    assert max(n) - min(n) <= 1 and {(x.shard, x.slot) for x in got} == {(s, k) for s in range(8) for k in range(n[s])}
    by_crc = {zlib.crc32(t.encode()): t for t in texts}

    def cut(where):
        return sum(a[0] == b[0] and a[1] != b[1] for k, a in enumerate(where) for b in where[:k])

    mine = [(by_crc[x.text_crc32], x.shard) for x in got if by_crc.get(x.text_crc32, "a").startswith("t")]
    hashed = [(t, r.randrange(8)) for t, _ in mine]
    # the two largest classes do not fit a shard of some 50 rows: their pairs over two shards must be cut
    least = 50 * 40 + 50 * 10
    assert 0.95 * least <= cut(mine) < 1.1 * least < cut(hashed) / 2


def deviation(rows, streams):
    """Largest distance, over all prefixes of slots, between units of a stream and its target."""
    at, worst = dict.fromkeys(streams, 0), 0.0
    for t, s in enumerate(rows, 1):
        at[s] += 1
        worst = max(worst, *(abs(at[i] - w * t) for i, w in streams.items()))
    return worst


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_schedule_stays_within_a_block_of_real_weights(spark, seed):
    r = random.Random(seed)
    w = sorted((r.random() ** 3 + 0.02 for _ in range(7)), reverse=True)
    w = [x / sum(w) for x in w]
    parts = mixing.parts_of(w)
    got = mixing.schedule(spark, parts, 40, 128).orderBy("slot").collect()
    assert [x.slot for x in got] == list(range(40 * 128)) and all(x.release <= x.slot < x.due for x in got)
    for s in range(7):
        assert [x.unit for x in got if x.stream == s] == list(range(sum(x.stream == s for x in got)))
    assert deviation([x.stream for x in got], dict(enumerate(w))) < 2  # units, of half a block
    assert mixing.had(parts, 40, 128) == [sum(x.stream == s for x in got) for s in range(7)]


def test_mixing(spark, docs, rows):
    got = mixing.mix(docs, block_bytes=256).collect()
    assert len(got) == len(rows) and any(r.in_mix for r in got)
    assert all(r.release <= r.slot < r.due for r in got if r.in_mix) and sum({r.source: r.target for r in got}.values()) == pytest.approx(1)
    assert mixing.blend(docs).columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0
    for bad in ({"s1": -1.0}, {"s1": float("nan")}, {"nobody": 1.0}):
        with pytest.raises(ValueError):
            mixing.mix(docs, bad)


def test_mixing_starts_no_python_workers(spark, docs, monkeypatch):
    """Tuples go through an RDD, whose Python workers of their own stay in the executors' memory."""

    def refuse(*_, **__):
        raise AssertionError("an RDD of Python objects")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    assert mixing.mix(docs, block_bytes=256).count() == docs.count()
    assert mixing.mix(docs, {"s1": 2.0, None: 1.0}, block_bytes=256).count() == docs.count()


def test_mixing_follows_given_weights_by_bytes(spark):
    r = random.Random(4)
    rows = [(i, "x" * r.randrange(100), r.choice("aaabbc") if i % 40 else None) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {"a": 0.55, "b": 0.3123, "c": 0.1377, None: 0.0}
    got = mixing.mix(docs, {"a": 5.5, "b": 3.123, "c": 1.377, None: 0}, block_bytes=512).collect()
    assert {x.slot for x in got if x.source is None} == {None} and len(got) == 6000
    mixed = sorted((x for x in got if x.in_mix), key=lambda x: (x.slot, x.block))
    end = max(x.slot for x in mixed)
    assert len({x.source for x in got if not x.in_mix and x.source}) >= 1 and {x.slot for x in mixed} == set(range(end + 1))
    done, at, n = {"a": 0, "b": 0, "c": 0}, 0, len(mixed)
    for t in range(end + 1):
        while at < n and mixed[at].slot == t:
            done[mixed[at].source] += mixed[at].size
            at += 1
        # a block, and the document that reaches over the end of a unit
        assert all(abs(done[s] - want[s] * 256 * (t + 1)) < 512 + 116 for s in done)


def test_small_sources_share_a_stream(spark):
    r = random.Random(6)
    rows = [(i, "y" * r.randrange(200), "big" if i % 2 else f"host{r.randrange(1500)}") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"big": 0.5} | {f"host{k}": 0.5 / 1500 * (1 + k % 2) for k in range(1500)}
    got = mixing.mix(docs, weights, block_bytes=1024).collect()
    assert len(got) == 9000 and all(x.slot is not None for x in got)
    first = [x for x in got if x.slot < 300]
    size = lambda of: sum(x.size for x in first if of(x))
    assert abs(size(lambda x: x.source == "big") / size(lambda x: True) - 0.4) < 0.02
    odd, even = (size(lambda x, o=o: x.source != "big" and int(x.source[4:]) % 2 == o) for o in (1, 0))
    assert 1.6 < odd / even < 2.4
    assert sorted(x.doc_id for x in mixing.blend(docs, weights=weights).collect()) == list(range(9000))


def test_blend_keeps_every_document_in_slot_order(spark, docs, rows):
    mixed = mixing.mix(docs, block_bytes=256, power=0.0).collect()
    assert not all(r.in_mix for r in mixed)  # some source runs out before the others
    got = [r.doc_id for r in mixing.blend(docs, block_bytes=256, power=0.0).collect()]
    assert sorted(got) == sorted(r[0] for r in rows)
    slot = {r.doc_id: r.slot for r in mixed}
    assert [slot[i] for i in got] == sorted(slot.values()) and not any(x is None for x in slot.values())
    assert mixing.blend(docs.limit(0)).count() == 0


def test_blend_keeps_rows_of_null_and_repeated_ids(spark):
    form = "doc_id long, text string, lang string, source string, n_chars long, size string"
    # id 1 has a short text of one source and a long tail of another; two rows are alike in everything but lang
    rows = [(None, "a" * 900, "x", "s", 1, "z"), (None, "b" * 900, "y", "s", 2, "z"), (None, None, "n", None, 3, "z")]
    rows += [(1, f"{k} " * 300, f"l{k}", "s" if k % 3 else "t", k, None) for k in range(40)] + [(2, "same", "p", "t", 5, "z"), (2, "same", "q", "t", 5, "z")]
    got = [tuple(r) for r in mixing.blend(spark.createDataFrame(rows, form), block_bytes=256).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in (r[0], r[4])) + (r[2],)
    assert sorted(got, key=key) == sorted(rows, key=key)
    # rows of one id keep slots of their own: sources take turns among the rows of id 1 instead of standing together by id
    own = [r[3] for r in got if r[0] == 1]
    assert any(a != b for a, b in zip(own[: len(own) // 2], own[1:], strict=False)) and sum(a != b for a, b in zip(own, own[1:], strict=False)) > 5


def test_rules_counts(spark, docs, rows):
    labels = spark.createDataFrame([(i, 1) for i in range(10)] + [(3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in rules.judge(docs, labels).collect()}
    for i, t, *_ in rows:
        w = WORD.findall(t or "")
        tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        again = {k + d for k, x in enumerate(tri) if tri.count(x) > 1 for d in range(3)} if len(w) < 2000 else None
        real = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert (got[i].n_words, got[i].word_chars, got[i].n_dup_lines) == (len(w), sum(map(len, w)), len(real) - len(set(real)))
        assert again is None or got[i].n_repeat_words == len(again)
        assert got[i].base_failed == (len(w) < 50 or 100 * got[i].n_repeat_words > 50 * len(w))
    assert rules.judge(docs.limit(0), labels).count() == 0
    assert rules.at_most(0, 10, 0.1) == pytest.approx(0.9**10) and rules.at_most(10, 10, 0.1) == 1


def test_rules_control_false_rejection(spark):
    r = random.Random(8)
    say = lambda share: " ".join("#a" if r.random() < share else "word" + str(r.randrange(10**6)) for _ in range(80))
    rows = [(i, say(0.0), "en", None) for i in range(3000)] + [(3000 + i, say(0.3), "en", None) for i in range(200)] + [(4000 + i, say(0.3), f"rare{i}", None) for i in range(300)]
    rows += [(5000 + i, say(0.3), None, None) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, extra string")
    labels = spark.createDataFrame([(i, 1) for i in (*range(3000), *range(4000, 4300), *range(5000, 8000))], "doc_id long, quality int")
    measured = rules.measure(docs)
    counts = measured.collect()
    cuts = {r.lang: r for r in rules.cutoffs(measured, labels).collect()}
    assert len(cuts) == 302 and cuts["en"].cut_symbols is not None and cuts[None].cut_symbols is not None
    assert all(x[f"cut_{c}"] is None for lang, x in cuts.items() if lang and lang.startswith("rare") for c in rules.RULES)
    share, level = 0.02 / len(rules.RULES), 0.05 / (302 * len(rules.RULES))
    for lang in ("en", None):
        n = 3000
        for rule, (up, down, grid) in rules.RULES.items():
            own = [m for m in counts if m.lang == lang and (m.doc_id < 3000 or m.doc_id >= 5000)]
            want = None
            for c in grid:
                hits = sum(m[up] >= c * m[down] > 0 for m in own)
                if hits > share * n or sum(comb(n, k) * Fraction(share) ** k * Fraction(1 - share) ** (n - k) for k in range(hits + 1)) > level:
                    break
                want = c
            assert cuts[lang][f"cut_{rule}"] == want
    kept = {r.doc_id: r.kept for r in rules.judge(docs, labels).collect()}
    assert sum(kept[i] for i in range(3000)) >= 0.98 * 3000 and sum(kept[i] for i in range(3000, 3200)) < 20
    assert all(kept[i] for i in range(4000, 4300)) and sum(kept[i] for i in range(5000, 8000)) >= 0.98 * 3000


def test_classifiers_without_labels(spark, docs, rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    assert {r.score for r in toxicity.classify(docs, none).collect()} == {0.0}
    assert quality.keep_good(docs, none).count() == len(rows)


@pytest.fixture(scope="module")
def labelled(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]


def held(got, labels, column):
    truth = {r.doc_id: r[column] for r in labels.collect() if r[column] is not None}
    return [(r, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]


def test_quality_on_held_out_labels(spark, labelled):
    docs, labels = labelled
    odd = docs.limit(3).unionByName(spark.createDataFrame([(None, None, "en", "s", 0), (10**9, "", None, None, None), (10**9, "word " * 30_000, "en", "s", 1)], docs.schema)).withColumn("score", F.lit("x"))
    got = quality.classify(docs.withColumn("score", F.lit("x")).unionByName(odd), labels).collect()
    assert len(got) == docs.count() + 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    rows = held(got, labels, "quality")
    assert len(rows) > 80 and sum(r.predicted == y for r, y in rows) >= 0.93 * len(rows)
    again = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    # labels of the held-out fold do not matter
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    flipped = labels.withColumn("quality", F.when(third, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in quality.classify(docs, flipped).collect()} == again
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_toxicity_on_held_out_labels(spark, labelled):
    docs, labels = labelled
    odd = spark.createDataFrame([(None, None, "en", "s", 0), (10**9, "", None, None, None)], docs.schema)
    got = toxicity.classify(docs.unionByName(odd).withColumn("toxic", F.lit("x")), labels).collect()
    assert len(got) == docs.count() + 2 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    rows = held(got, labels, "toxic")
    clean, bad = [r for r, y in rows if not y], [r for r, y in rows if y]
    assert sum(r.predicted for r in clean) <= 0.06 * len(clean) and sum(r.predicted for r in bad) >= 0.5 * len(bad)
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        assert r.doc_id in text or not r.offences
        assert all(0.5 <= x.p <= 1 and WORD.fullmatch(text[r.doc_id][x.start : x.end]) for x in r.offences)
    assert any(len(r.offences) > 0 for r in bad)
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def test_offences_equal_tagging_word_by_word():
    chain = toxicity.Chain(np.zeros(1 << toxicity.BITS), -1.0, np.array([[0.5, -1.0], [-0.2, 0.9]]), np.zeros(5))
    chain.weights[toxicity.slot("=vile")] = 4.0
    text = "a fine line\n\n so vile, and vile again\u00e9\nVILE"
    got = toxicity.Tagger(chain).judge([text, None, ""])[1]
    want, base = [], 0
    for line in text.split("\n"):
        found = list(WORD.finditer(line))
        e = [4.0 if m[0].lower().strip(",") == "vile" else 0.0 for m in found]
        total, one = 0.0, np.zeros(len(e))
        for y in np.ndindex(*[2] * len(e)):
            w = np.exp((-1.0 * y[0] if y else 0) + sum(a * b for a, b in zip(e, y, strict=True)) + sum(chain.steps[a, b] for a, b in zip(y, y[1:], strict=False)))
            total, one = total + w, one + w * np.array(y)
        want += [(base + m.start(), base + m.end(), p) for m, p in zip(found, one / total, strict=True) if p >= 0.5]
        base += len(line) + 1
    assert [x[:2] for x in got[0]] == [x[:2] for x in want] and np.allclose([x[2] for x in got[0]], [x[2] for x in want]) and got[1:] == [[], []]


def test_positive_unlabelled_risk():
    r = np.random.default_rng(0)
    p, u = r.normal(1, 0.4, (800, 3)), np.vstack([r.normal(1, 0.4, (1500, 3)), r.normal(-1, 0.4, (500, 3))])
    prior = quality.estimate_prior(p, u)
    assert 0.65 < prior < 0.9
    s = quality.fit(p, u, prior).score(u)
    assert ((s > 0.5) == (np.arange(2000) < 1500)).mean() > 0.97


def test_marginals_equal_enumeration():
    chain = toxicity.Chain(np.zeros(4), 0.3, np.array([[0.5, -1.0], [-0.2, 0.9]]), np.zeros(5))
    e = np.array([[0.4, -1.2, 2.0, 0.1]])
    p, pairs, _ = toxicity.marginals(e, np.array([4]), chain)
    total, one, both = 0.0, np.zeros(4), np.zeros((2, 2))
    for y in np.ndindex(2, 2, 2, 2):
        s = np.exp(0.3 * y[0] + sum(e[0, k] * y[k] for k in range(4)) + sum(chain.steps[y[k], y[k + 1]] for k in range(3)))
        total += s
        one += s * np.array(y)
        for k in range(3):
            both[y[k], y[k + 1]] += s
    assert np.allclose(p[0], one / total) and np.allclose(pairs, both / total)


def test_toxicity_learns_from_lines_of_any_length(spark):
    assert [toxicity.cuts(n) for n in (1, 400, 401)] == [[(0, 1)], [(0, 400)], [(0, 400), (360, 401)]]
    assert all(set().union(*(range(*c) for c in toxicity.cuts(n))) == set(range(n)) for n in (399, 760, 761, 5000))
    r = random.Random(2)
    words = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    texts = [[r.choice(words) for _ in range(450)] for _ in range(120)]
    for t in texts[:60]:
        t[r.randrange(405, 450)] = "vilezz"
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, toxic int")
    chain = toxicity.learn(docs, labels, toxicity.F.lit(False))
    assert chain.weights.any()
    got = toxicity.Tagger(chain).scores([" ".join(t) for t in texts])
    assert ((got >= 0.3) == (np.arange(120) < 60)).all()


def article_of(page):
    inside = re.search("<article>(.*?)</article>", page, re.S)[1]
    return " ".join(unescape(re.sub("<[^>]*>", "", re.sub("</?(?:p|h1|br)[^>]*>", " ", inside))).split())


def test_html_against_known_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {r.page_id: article_of(r.html) for r in pages.collect()}
    got = {r.page_id: r for r in html.extract_pages(pages).collect()}
    assert {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())
    # the markup that taught the weights is gone: the scan alone must find the article
    weights = html.learn(pages)
    for r in pages.collect():
        assert html.main_text(r.html.replace("<article>", "<div class=story>").replace("</article>", "</div>"), weights) == want[r.page_id]


def test_html_edge_cases_through_spark(spark):
    page = "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav><div class='ad'>buy it now</div><article><h1>A &amp; B</h1><p>one  two<br>three <b>fo</b>ur</p><aside>no</aside><div class='ad-slot'>no</div><p class='related-work'>caf&eacute; <i class=copyright-law>a b</i> c d e f g h i j k l m n o p q</p></article><div id=comments><p>me too</p></div><footer>foot</footer>"
    long = "<body><article>" + "<p>word word</p>" * 60_000 + "</article>"
    rows = [(1, "u", page, "x", 7), (2, None, None, "x", 7), (3, "u", "", None, 7), (4, "u", "<", "x", 7), (5, "u", long, "x", 7), (None, "u", "<p>", "x", 7), (1, "u", page, "x", 7)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = [(r.page_id, r.text) for r in html.extract_pages(docs).collect()]
    plain = "A & B one two three four café a b c d e f g h i j k l m n o p q"
    assert sorted(got, key=str) == sorted([(1, plain), (2, ""), (3, ""), (4, "<"), (5, " ".join(["word"] * 120_000)), (None, ""), (1, plain)], key=str)
    assert html.extract_pages(docs.limit(0)).count() == 0 and html.learn(docs.limit(0)) == {}
    # without any labelled page
    bare = page.replace("article>", "section>")
    assert html.main_text(bare, {}) == plain


def test_html_scan_is_linear():
    for piece in ("<a ", "<i>x ", '<a ">', "<a '\"> ", "<!--", '<div class="', "</p>", "<", "&", "<script>"):
        took = []
        for n in (40_000, 160_000):
            began = time.perf_counter()
            html.main_text(piece * n, {})
            took.append(time.perf_counter() - began)
        assert took[1] < 10 * took[0] + 0.3, piece


def test_region_equals_brute_force():
    r = random.Random(3)
    for _ in range(300):
        x = [r.choice((-2.0, -1.0, 0.5, 1.0)) for _ in range(r.randrange(0, 25))]
        sums = {(a, b): sum(x[a:b]) for a in range(len(x)) for b in range(a + 1, len(x) + 1)}
        best = max([0.0, *sums.values()])
        a, b = html.region(x)
        assert sum(x[a:b]) == best and (a, b) == min([k for k, v in sums.items() if v == best and best > 0] or [(0, 0)], key=lambda k: (k[1], -k[0])) or best == 0


def near_lists(spark, rows, kind="float", **options):
    got = {}
    for g in neighbours.search(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, rank string"), **options).collect():
        got.setdefault(g.query_id, []).append((g["rank"], g.vec_id, g.score))
    assert all([r for r, *_ in sorted(x)] == list(range(1, len(x) + 1)) for x in got.values())
    return {q: [(v, s) for _, v, s in sorted(x)] for q, x in got.items()}


def test_neighbours_equal_brute_force(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 6)).astype(np.float32)
    x[50:90] = x[7]
    rows = [(i, v.tolist(), "a") for i, v in enumerate(x)] + [(1000, None, "a"), (1020, [], "a"), (1040, [0.0] * 6, "a"), (1060, [float("nan")] * 6, "a"), (1080, [1.0, None] * 3, "a")]
    rows += rows[:3] + [(1100, [1.0, 2.0], "a"), (1101, [2.0, 1.0], "a")]
    got = near_lists(spark, rows)
    x = x.astype(np.float64)
    for q in range(0, 300, 20):
        s = x @ x[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(300), -s.round(12)))[:20]
        assert [v for v, _ in got[q]] == want.tolist()
        assert np.allclose([s for _, s in got[q]], s[want], rtol=1e-14)
    assert set(got) == {*range(0, 300, 20), 1100} and got[1100] == [(1101, 4.0)]


def test_neighbours_over_many_blocks(spark, monkeypatch):
    r = np.random.default_rng(4)
    centers = r.normal(size=(60, 16))
    x = np.repeat(centers, 60, axis=0) + 0.15 * r.normal(size=(3600, 16))
    taken = []
    real = neighbours.calibrate
    monkeypatch.setattr(neighbours, "calibrate", lambda *a: taken.append((a[3], real(*a))) or taken[-1][1])
    got = near_lists(spark, [(i, v.tolist(), "a") for i, v in enumerate(x)], "double", block=64)
    (blocks, (curves, reach)) = taken[0]
    assert blocks == 57 and curves * (2 * reach + 1) < blocks / 2  # windows are narrow here
    hits = 0
    for q in range(0, 3600, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len({v for v, _ in got[q]} & set(np.argsort(-s)[:20].tolist()))
        assert all(abs(score - s[v]) <= 1e-12 * abs(score) for v, score in got[q])
    assert hits >= 0.9 * 20 * 180


def test_neighbours_keep_double_precision(spark):
    rows = [(20, [1.0, 0.0], "a"), (1, [1.0, 1e39], "a"), (2, [1e-50, 0.0], "a"), (3, [0.05, 0.0], "a"), (4, [0.0, 1.0], "a"), (3, [0.01, 0.0], "b")]
    assert near_lists(spark, rows, "double") == {20: [(1, 1.0), (3, 0.05), (3, 0.01), (2, 1e-50), (4, 0.0)]}
    assert near_lists(spark, [], "double") == {}


RICH = {
    "<h1>Title here</h1><p>intro words one two three</p><ul><li>first item</li><li>second item</li></ul><p>closing words a b c</p>": "Title here intro words one two three first item second item closing words a b c",
    "<h2>T</h2><table><tr><td>a</td><td>b</td></tr></table><p>one two</p><blockquote>quoted words here</blockquote>": "T a b one two quoted words here",
    "<h1>Head line</h1><p>first words of it</p><aside>apart from it</aside><p>and on</p><div class='ad banner'>buy now</div><p>to the end</p>": "Head line first words of it and on to the end",
    "<h1>Plants</h1><dl><dt>moss</dt><dd>is green</dd></dl><ol>" + "<li>one of many</li>" * 80 + "</ol><p>done</p><figure><img src=x><figcaption>a leaf</figcaption></figure>": "Plants moss is green " + "one of many " * 80 + "done a leaf",
    "<p>see <a href=1>the first</a> and <a href=2>the second</a> of them</p><ul><li>with <a href=3>a link</a> in it</li></ul><aside><a href=4>top</a></aside><p>last words</p>": "see the first and the second of them with a link in it last words",
}
AROUND = "<html><head><title>no</title></head><body><header><div>Site name</div></header><nav><ul>" + "<li><a href=x>Menu entry</a></li>" * 12 + "</ul></nav><div class=ad>Buy this</div>{}<div id=comments><p>I do not agree at all with you</p></div><ul><li><a href=1>Older post</a></li><li><a href=2>Newer post</a></li></ul><footer><p>All rights reserved by us</p></footer></body></html>"


@pytest.mark.parametrize("learnt", [True, False])
def test_html_keeps_lists_tables_quotes_and_text_around_asides(spark, learnt):
    """In an unnamed element, with weights of pages that have headings and paragraphs alone, and with none."""
    weights = html.learn(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")) if learnt else {}
    for body, want in RICH.items():
        assert html.main_text(AROUND.format(f"<div>{body}</div>"), weights) == want
        assert html.main_text(AROUND.format(f"<article>{body}</article>"), weights) == want


def test_html_articles_rewritten_with_lists_and_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = html.learn(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    kinds = [("<ul><li>", "</li></ul>"), ("<table><tr><td>", "</td></tr></table>"), ("<blockquote>", "</blockquote>"), ("<aside>apart</aside><p>", "</p>")]
    for r in pages.collect():
        n = iter(range(10**6))
        part = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        part = re.sub("<p>([^<]*)</p>", lambda m: kinds[next(n) % 4][0] + m[1] + kinds[(next(n) - 1) % 4][1] if m[1] else "", part)
        changed = r.html[: r.html.index("<article>")] + f"<div>{part}</div>" + r.html[r.html.index("</article>") + 10 :]
        want = " ".join(unescape(re.sub("<[^>]*>", "", re.sub("</?(?:p|h1|br|ul|li|table|tr|td|blockquote)[^>]*>", " ", re.sub("<aside>.*?</aside>", " ", part)))).split())
        assert html.main_text(changed, weights) == want


def test_html_learns_from_one_page_of_an_id(spark, monkeypatch):
    rows = [(1, f"<article><p>{'w ' * k}</p></article>") for k in range(1, 50)] * 3 + [(2, "<main><h1>x</h1></main>"), (None, "<article><p>y</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    seen = []
    monkeypatch.setattr(html, "weights_of", lambda counts: seen.append(counts) or {})
    html.learn(df)
    assert seen[0][".p"] == (1, 0) and seen[0][".h1"] == (1, 0)
