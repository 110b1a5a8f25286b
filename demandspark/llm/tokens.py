"""Token counts of whole texts: library encodings in batches that are balanced by bytes, of which only lengths leave a task.

A text longer than ``part_chars`` is encoded in parts, so memory follows the batch and never the text. It is cut only
where cutting changes no token:

* sentencepiece models: in front of spaces that follow another character, if no piece of the vocabulary has a space
  after another character (checked when the model is loaded). The model puts a space in front of each text, so a part
  drops the first of its own. In front of a line break, if no longer piece has one: then the added space is a token to
  take off again.
* tokenizers files: in front of a space or line break that follows a character other than white space. Their patterns
  part words there, whatever follows, and no added token holds white space (checked as well).

A stretch without such a place stays whole. Parts of many texts fill a batch up to ``batch_bytes``, so one call has about
as much work as the next, whatever the texts' lengths. There is no shuffle: each task counts the texts that it reads.

Edge cases: null and empty texts have 0 bytes and 0 tokens; special strings inside texts are what the library takes them
for by default; repeated rows, null and repeated doc_ids are counted row by row; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from demandspark.llm import text as T

PART_CHARS, BATCH_BYTES, LIMIT = 1 << 14, 1 << 18, 4_096
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class PieceLengths:
    """Numbers of pieces by a sentencepiece model."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.at_space = not any("▁" in p.lstrip("▁") for p in pieces) and self._lengths(["a b", "a", "b", " b"])[0] == sum(self._lengths(["a", "b"])) and self._lengths(["a  b"])[0] == sum(self._lengths(["a", " b"]))
        self.at_break = not any("\n" in p for p in pieces) and self._lengths(["a\nb"])[0] == sum(self._lengths(["a", "\nb"])) - 1
        places = ["(?<=[^ ▁]) +(?=[^ ▁])"] * self.at_space + ["(?<=.)(?=\n)"] * self.at_break
        self.places = re.compile("|".join(places) or "(?!)", re.S)

    def _lengths(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]

    def part(self, text: str, start: int, end: int) -> str:
        return text[start + (start > 0 and text[start] == " ") : end]

    def added(self, text: str, start: int) -> int:
        """Tokens that a part has too many."""
        return int(start > 0 and text[start] == "\n")

    def lengths(self, parts: list[str]) -> list[int]:
        return self._lengths(parts)


class WordLengths:
    """Numbers of tokens by a file of the tokenizers library, without added tokens, truncation and padding."""

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(model)
        self.model.no_truncation()
        self.model.no_padding()
        odd = any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in json.loads(model).get("added_tokens", []))
        self.places = re.compile("(?!)" if odd else r"(?<=\S)(?=[ \n])")

    def part(self, text: str, start: int, end: int) -> str:
        return text[start:end]

    def added(self, text: str, start: int) -> int:
        return 0

    def lengths(self, parts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode_batch_fast(parts, add_special_tokens=False)]


Lengths = PieceLengths | WordLengths


def read_model(path: str) -> bytes | str:
    """The model as executors get it; read on the driver alone."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            return f.read()
    with open(path, "rb") as f:
        return f.read()


_LENGTHS: dict[int, Lengths] = {}


def lengths_of(model: bytes | str) -> Lengths:
    """This Python worker's counter of a model; made once."""
    key = hash(model)
    if key not in _LENGTHS:
        _LENGTHS.clear()
        _LENGTHS[key] = WordLengths(model) if isinstance(model, str) else PieceLengths(model)
    return _LENGTHS[key]


def cuts(text: str, places: re.Pattern, part_chars: int) -> list[int]:
    """Where to cut a text: the first place at or after each ``part_chars`` characters (two at least, so no part is a dropped space)."""
    out, at, step = [0], 0, max(2, part_chars)
    while at + step < len(text):
        m = places.search(text, at + step)
        if m is None:
            break
        at = m.start()
        out.append(at)
    return [*out, len(text)]


def count_texts(texts: list[str | None], of: Lengths, part_chars: int = PART_CHARS, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
    """Number of tokens of every text."""
    out = np.zeros(len(texts), dtype=np.int64)
    parts: list[str] = []
    owners: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if parts:
            np.add.at(out, owners, of.lengths(parts))
        parts.clear()
        owners.clear()
        size = 0

    for i, text in enumerate(texts):
        if not text:
            continue
        borders = cuts(text, of.places, part_chars) if len(text) > part_chars else [0, len(text)]
        for a, b in zip(borders, borders[1:], strict=False):
            out[i] -= of.added(text, a)
            parts.append(of.part(text, a, b))
            owners.append(i)
            size += len(parts[-1].encode())
            if size >= batch_bytes:
                flush()
    flush()
    return out


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT, part_chars: int = PART_CHARS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))  # a vocabulary: a few MB whatever the table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = lengths_of(model.value)
        for b in batches:
            for s in T.slices(b, "text", 8 * batch_bytes):
                n_bytes = np.diff(T.buffers(s.column("text"))[0])
                n = count_texts(s.column("text").to_pylist(), of, part_chars, batch_bytes)
                yield pa.record_batch([s.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
