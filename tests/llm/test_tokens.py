"""Token counts against the libraries' encodings of whole texts."""

import random

import pytest
from demandspark.llm import tokens
from demandspark.llm.queries import tokenizer_path

FILES = ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"]
BITS = ["a", "b ", "  ", "\n", " \n", "é", "▁", " ▁", "the ", "<|endoftext|>", "<s>", "</s>", "Ünï", " 12", "'s", "\t", "̈", "　", ".", "漢字", "🙂", "\r\n", "\x00"]


@pytest.mark.parametrize("name", FILES)
def test_parts_give_the_tokens_of_whole_texts(name):
    r = random.Random(3)
    texts = ["".join(r.choice(BITS) for _ in range(r.randrange(300))) for _ in range(200)] + ["", " ", "\n", " \n ", "a" * 5000, " " * 300 + "x", "word " * 4000]
    of = tokens.lengths_of(tokens.read_model(tokenizer_path(name)))
    want = [len(x) for x in (of.model.encode(texts) if name.endswith("model") else of.model.encode_batch(texts, add_special_tokens=False))]
    for part_chars, batch_bytes in ((1, 1), (2, 64), (5, 1 << 10), (64, 1 << 20), (1 << 14, 1 << 18)):
        assert tokens.count_texts(texts, of, part_chars, batch_bytes).tolist() == want
    assert max(map(len, [tokens.cuts("word " * 4000, of.places, 64)])) > 200


@pytest.mark.parametrize("name", FILES)
def test_rows_are_counted_one_by_one(spark, name):
    long = "lorem ipsum dolor\n" * 6000
    rows = [(1, None, "x"), (2, "", "x"), (3, "one two", None), (3, "one two", None), (None, "three", "y"), (4, long, "z"), (5, "é" * 40_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(2)
    path = tokenizer_path(name)
    of = tokens.lengths_of(tokens.read_model(path))
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs, path, limit=100).collect())
    n = [len(x) for x in (of.model.encode([t or "" for _, t, _ in rows]) if name.endswith("model") else of.model.encode_batch([t or "" for _, t, _ in rows], add_special_tokens=False))]
    assert got == sorted((i or 0, len((t or "").encode()), k, k > 100) for (i, t, _), k in zip(rows, n, strict=True))
    assert tokens.count_tokens(docs.limit(0), path).collect() == []


def test_files_with_added_tokens_of_white_space_are_not_cut():
    path = tokenizer_path("byte_bpe_50k.json")
    of = tokens.WordLengths(tokens.read_model(path).replace('"content":"<|endoftext|>"', '"content":"end of text"', 1))
    assert tokens.cuts("word " * 50, of.places, 4) == [0, 250]
