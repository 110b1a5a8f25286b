"""Piece codec against the library whose results it must equal."""

import hashlib
import random

import pytest
from demandspark.llm.pieces import Codec, Vocabulary, digest_documents, digest_in_order, encode_documents, forgetting
from demandspark.llm.queries import tokenizer_path

sentencepiece = pytest.importorskip("sentencepiece")
PATH = tokenizer_path("piece_bpe_32k.model")
FIXED = ["", " ", "a", "hello  world", " hello ", "\n", "a▁b", "\x00x", "é 𝒳", "x�", "a<s>b</s><unk>", "   x     y", "▁▁a  ", "日本語 中文", "\t\ta b", "1234567 8.9!!", "ab " * 4000, " " * 90 + "x" * 300]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return Codec(Vocabulary.load(PATH), cache_units=100)


def test_ids_and_text_equal_the_library(model, codec):
    r = random.Random(3)
    letters = " \n abcdefghijklmnop▁éöß日,.!{}()0123=\t𝒳"
    texts = FIXED + ["".join(r.choice(letters) for _ in range(r.randrange(1, 50))) for _ in range(800)]
    texts += ["".join(r.choice(codec.v.pieces[3:]) for _ in range(r.randrange(1, 12))) for _ in range(800)]
    for t in texts:
        want = [*model.encode(t), 2]
        assert codec.encode(t) == want
        assert codec.decode(want) == model.decode(want)
        ids, plain = " ".join(map(str, want)).encode(), model.decode(want).encode()
        assert codec.digest(t) == (len(want), hashlib.sha256(ids).hexdigest(), hashlib.sha256(plain).hexdigest())


def test_decode_of_any_ids(model, codec):
    r = random.Random(4)
    for _ in range(500):
        ids = [r.randrange(300) if r.random() < 0.7 else r.randrange(32000) for _ in range(r.randrange(8))]
        assert codec.decode(ids) == model.decode(ids)


def test_query_rows(spark, model):
    rows = [(i, t, "x") for i, t in enumerate([None, "", "same text", "same text", *FIXED])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in digest_documents(docs, PATH).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        ids = [*model.encode(t or ""), 2]
        assert got[i].n_tokens == len(ids)
        assert got[i].decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    assert {r.doc_id: r.ids for r in encode_documents(docs, PATH).collect()}[2] == [*model.encode("same text"), 2]
    assert digest_documents(docs.limit(0), PATH).count() == 0


def test_next_task_of_a_worker_merges_no_pair_again():
    c, texts, merged = Codec(Vocabulary.load(PATH)), ["the thatndea onentiontion hablees", "Attireheerstsh nd lytionat edhain"], []
    merge = c.remerge
    c.remerge = lambda text: merged.append(text) or merge(text)
    first = [c.digest(t) for b in forgetting(c, iter([texts])) for t in b]
    assert merged and not c.units and not c.stems
    merged.clear()
    assert [c.digest(t) for b in forgetting(c, iter([texts])) for t in b] == first
    assert not merged


def test_idle_worker_keeps_agreeing_pairs_packed():
    """Kept as small objects they held on to the memory of the encodings that went."""
    c, text = Codec(Vocabulary.load(PATH)), "the thatndea onentiontion hablees"
    first = [c.digest(t) for b in forgetting(c, iter([[text]])) for t in b]
    assert not c.pairs and len(c.packed[0]) == len(c.packed[1]) > 0
    batches = forgetting(c, iter([[text]]))
    known = dict(zip(c.packed[0], map(bool, c.packed[1]), strict=True))
    assert [c.digest(t) for t in next(batches)] == first and c.pairs == known
    assert not list(batches) and not c.pairs


def test_units_that_decode_to_other_text():
    """Without byte pieces an unknown character is shown by a sign; with a piece that holds a plain space, no text matches that."""
    c = Codec(Vocabulary(("<unk>", "</s>", "a", "b", "▁", "ab", "▁a", " b"), (0.0, 0.0, -3.0, -4.0, -5.0, -1.0, -2.0, 0.0), "ucnnnnnn", 1))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for text, ids, shown in (("ab b", [4, 5, 4, 3, 1], "ab b"), ("a▁b", [6, 4, 3, 1], "a b"), ("aé ab", [6, 0, 4, 5, 1], "a ⁇  ab"), ("éé a", [4, 0, 6, 1], " ⁇  a")):
        for _ in range(2):
            assert c.encode(text) == ids and c.decode(ids) == shown
            assert c.digest(text) == (len(ids), digest(" ".join(map(str, ids))), digest(shown))


def test_digests_in_the_order_of_the_files(spark, model, tmp_path):
    """The later files are larger, so Spark reads them first; one holds rows in falling order, and one id is null."""
    rows = [(k if k else None, f"word{k} " * (1 + k * k), k) for k in (3, 2, 1, 0, 4, 5, 6, 7)]
    for part in range(4):
        spark.createDataFrame(rows[2 * part : 2 * part + 2], "doc_id long, text string, _at long").coalesce(1).write.parquet(f"{tmp_path}/{part}")
        (next((tmp_path / str(part)).glob("part-*.parquet"))).rename(tmp_path / f"part-{part * 40000}-x.parquet")
    docs = spark.read.parquet(*(str(p) for p in tmp_path.glob("part-*.parquet")))
    got = digest_in_order(docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = [(i, len(model.encode(t)) + 1) for i, t, _ in rows]
    assert [(r.doc_id, r.n_tokens) for r in got.collect()] == want
    assert [(r.doc_id, r.n_tokens) for r in digest_in_order(spark.createDataFrame(rows, docs.schema), PATH).collect()] == want
    assert digest_in_order(docs.limit(0), PATH).count() == 0
