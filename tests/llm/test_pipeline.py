"""The corpus pipeline: every stage against a brute-force version on its own input."""

import hashlib
import random
import re

import pytest

from demandspark.llm import mixing, pieces, quality
from demandspark.llm.queries import tokenizer_path

corpus_pipeline = pytest.importorskip("corpus_pipeline")
WORD = re.compile("[^\x20\x09-\x0d]+")
FORM = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The smallest labelled documents, with odd rows, in a folder of their own."""
    r = random.Random(11)
    say = lambda n: " ".join(r.choice(("the", "of", "and", "stone", "river", "wood", "light", "house")) + str(r.randrange(50)) for _ in range(n))
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = [tuple(x) for x in docs.collect()]
    last = max(x[0] for x in rows)
    good = next(x for x in rows if len(WORD.findall(x[1] or "")) > 120)
    rows += [(None, say(90), "en", "s1", 1), (None, good[1], None, None, None), (last + 1, None, "en", "s1", 0), (last + 2, "", "en", "s2", 0), (good[0], say(120), "en", "s0", 2), (last + 3, f"{say(40)} {good[1]}", "en", "s0", 3)]
    at = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, FORM).write.parquet(f"{at}/documents.parquet")
    labels.write.parquet(f"{at}/labels.parquet")
    return str(at), rows


@pytest.fixture(scope="module")
def staged(spark, tables, tmp_path_factory):
    """Rows that went into each stage, and those that came out."""
    at, _ = tables
    out = tmp_path_factory.mktemp("stages")
    docs, steps = spark.read.parquet(f"{at}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, at)
        before = [tuple(x) for x in docs.collect()]
        in_order = [tuple(x) for x in got.collect()] if name == "mixing" else None
        if name != "pieces":
            assert got.columns == docs.columns and got.schema == docs.schema
        got.write.parquet(f"{out}/{name}")
        docs = spark.read.schema(got.schema).parquet(f"{out}/{name}")
        steps[name] = before, in_order or [tuple(x) for x in docs.collect()], docs
    return steps


def order(rows):
    return sorted(rows, key=repr)


def test_stages_are_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "substring", "mixing", "pieces"]


def test_quality_stage_keeps_what_the_classifier_scores(spark, tables, staged):
    at, rows = tables
    before, after, _ = staged["quality"]
    assert order(before) == order(rows)
    net = quality.learn(spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet"), quality.fold(3, 1))
    import pyarrow as pa

    score = net.score(quality.inputs(pa.array([r[1] for r in before], pa.string())))
    assert order(after) == order(r for r, s in zip(before, score, strict=True) if s >= 0.5)
    assert 0.5 * len(before) < len(after) < len(before)


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_near_dedup_stage_keeps_one_of_each_class(staged):
    before, after, _ = staged["near_dedup"]
    nodes = [(r[0], shingles(r[1])) for r in before if r[0] is not None]
    root = {i: i for i, _ in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(nodes):
        for j, b in nodes[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert order(after) == order(r for r in before if r[0] is None or find(r[0]) == r[0])
    assert len(after) < len(before)


def test_substring_stage_cuts_later_windows(staged):
    before, after, _ = staged["substring"]
    first, want = {}, []
    split = [(r, WORD.findall(r[1] or "")) for r in before]
    for r, w in split:
        if r[0] is not None:
            for k in range(len(w) - 49):
                key = tuple(w[k : k + 50])
                first[key] = min(first.get(key, r[0]), r[0])
    for r, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if r[0] is not None and first[tuple(w[k : k + 50])] < r[0]:
                gone[k : k + 50] = [True] * 50
        left = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        if not any(gone):
            want.append(r)
        elif left:
            want.append((r[0], left, *r[2:4], len(left)))
    assert order(after) == order(want) and any(a != b for a, b in zip(order(after), order(before), strict=False))


def test_mixing_stage_orders_all_rows_by_slot(staged):
    before, after, docs = staged["mixing"]
    assert order(after) == order(before)
    slots = {(r.doc_id, r.source, r.size): r.slot for r in mixing.mix(docs).collect()}
    got = [slots[r[0], r[3], len((r[1] or "").encode()) + 16] for r in after]
    assert got == sorted(got)


def test_pieces_stage_encodes_all_rows(staged):
    import sentencepiece

    before, after, _ = staged["pieces"]
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in before:
        ids = model.encode(r[1] or "", add_eos=True)
        want.append((r[0], len(ids), digest(" ".join(map(str, ids))), digest(model.decode(ids))))
    assert order(after) == order(want)
    assert pieces.Vocabulary.load(tokenizer_path("piece_bpe_32k.model")).end_id == model.eos_id()


def test_run_gives_the_rows_of_the_stages(spark, tables, staged):
    assert order(tuple(r) for r in corpus_pipeline.run(spark, tables[0]).collect()) == order(staged["pieces"][1])


def test_result_is_in_the_order_of_the_mix(spark, tables, staged):
    """What mixing decides, the order, is that of the last stage's rows and of the whole run's."""
    mixed, docs = staged["mixing"][1:]
    want = [r[0] for r in mixed]
    assert want != [r[0] for r in staged["mixing"][0]]
    assert [r.doc_id for r in corpus_pipeline.pieces_stage(spark, docs, tables[0]).collect()] == want
    assert [r.doc_id for r in corpus_pipeline.run(spark, tables[0]).collect()] == want
