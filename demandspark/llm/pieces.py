"""SentencePiece encoding and decoding of merge-type (BPE) models by backtracking.

A merge-type model glues the best-scoring adjacent pair again and again. The result is the only sequence of
pieces in which every piece re-merges to itself and every two neighbours, merged anew from characters, come out
as the same two pieces. So it can be found from left to right: take the longest piece that starts here (a trie finds
it), keep it if it agrees with the piece before, else try the next shorter one, which a table has for each piece; when
none is left, mark the position as failed and step back.

The model writes a space as U+2581 and reads both alike; here both are a space, in texts and in pieces. Merging never
crosses the border of a *unit*: a run of spaces with the characters up to the next space, as long as
no piece holds a space after another character, which the vocabulary is checked for. Units repeat, so each Python
task keeps the encodings of up to ``cache_units`` of them, and gives their memory back at its end. Which pieces agree
is kept by the worker for its next tasks, packed between them. Texts are never cut.

Edge cases: null text counts as empty; an empty text has no piece, only the end id; characters outside the
vocabulary become their UTF-8 byte pieces (or the unknown id if the model has none); repeated rows are encoded
alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from demandspark.llm import store

SPACE, OTHER = "▁", "!"
TEXT_ROWS = 2_000  # rows with a text that Python gets at once
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id with their scores; ``kinds`` has n(ormal), b(yte), c(ontrol) or u(nknown) for each."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: str
    end_id: int

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a model file on the driver; executors get the plain tables."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kinds = "".join("u" if model.is_unknown(i) else "c" if model.is_control(i) else "b" if model.is_byte(i) else "n" for i in ids)
        return Vocabulary(tuple(map(model.id_to_piece, ids)), tuple(map(model.get_score, ids)), kinds, model.eos_id())


class Codec:
    """Encoder and decoder over one vocabulary, with a bounded cache of encoded units."""

    def __init__(self, vocabulary: Vocabulary, cache_units: int = 200_000):
        self.v, self.cache_units = vocabulary, cache_units
        self.pieces = [p.replace(SPACE, " ") for p in vocabulary.pieces]
        self.ids = {p: i for i, (p, raw, k) in enumerate(zip(self.pieces, vocabulary.pieces, vocabulary.kinds, strict=True)) if k == "n" and " " not in raw}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds, strict=True)) if k == "b"}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = vocabulary.kinds.index("u")
        self.chars = {p for p in self.ids if len(p) == 1}
        self.inside: set[tuple[str, str]] = set()  # neighbours within some piece; no merge joins any others
        for p in self.ids:
            if " " in p.lstrip(" "):
                raise ValueError(f"piece {p!r} has a space after another character")
            if not self.chars.issuperset(p):
                raise ValueError(f"piece {p!r} has a character that is no piece")
            self.inside.update(zip(p, p[1:], strict=False))
        self.rank = {p: vocabulary.scores[i] for p, i in self.ids.items()}
        self.names, self.sizes = [str(i) for i in range(len(self.pieces))], [len(p) for p in self.pieces]
        self.trie = ahocorasick.Automaton()
        self.longest: dict[str, int] = {}  # start of a piece -> longest piece that it begins with
        self.shorter = [-1] * len(self.pieces)  # piece -> next shorter piece that it begins with
        for p, i in sorted(self.ids.items(), key=lambda x: len(x[0])):  # shorter pieces first
            if self.remerge(p) == (i,):  # else merging never ends in it
                self.trie.add_word(p, i)
                for size in range(1, len(p)):
                    self.longest.setdefault(p[:size], self.longest.get(p[: size - 1], -1))
                self.shorter[i] = self.longest.get(p[:-1], -1)
                self.longest[p] = i
        self.width = max(map(len, self.longest), default=1)
        self.pairs: dict[int, bool] = {}
        self.packed = array("q"), b""
        self.stems: dict[str, list[int]] = {}
        self.units, self.texts = Units(self), Texts(self)
        self.shown = [p if k == "n" else "" if k == "c" else " ⁇ " for p, k in zip(self.pieces, vocabulary.kinds, strict=True)]
        breaks = "\n" if "\n" not in self.chars else ""
        self.cut = re.compile(f" *[^ {breaks}]+| +" + ("|\n" if breaks else ""))

    def remerge(self, text: str) -> tuple[int, ...]:
        """Pieces of a short text by merging its characters, best score first, leftmost on ties."""
        parts, none = list(text), -math.inf
        scores = [self.rank.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) > none:
            k = scores.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            if k:
                scores[k - 1] = self.rank.get(parts[k - 1] + parts[k], none)
            if k < len(scores):
                scores[k] = self.rank.get(parts[k] + parts[k + 1], none)
        return tuple(self.ids[p] for p in parts)

    def agree(self, a: int, b: int) -> bool:
        """Whether pieces a and b can stand next to each other: re-merging their characters gives both again."""
        key = a * len(self.names) + b
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) >= 500_000:
                self.pairs.clear()
            ok = self.pairs[key] = self.remerge(self.pieces[a] + self.pieces[b]) == (a, b)
        return ok

    def backtrack(self, text: str) -> list[int]:
        """Pieces of a text whose characters are all in the vocabulary."""
        n, width, count = len(text), self.width, len(self.names)
        reach, longest, shorter, sizes, pairs = self.trie.longest_prefix, self.longest, self.shorter, self.sizes, self.pairs
        failed = bytearray(n + 1)  # by position
        out: list[int] = []
        at, last = 0, -1
        i = longest[text[: reach(text[:width])]]
        while True:
            while i >= 0:
                end = at + sizes[i]
                if not failed[end]:
                    ok = last < 0 or pairs.get(last * count + i)
                    if ok or (ok is None and self.agree(last, i)):
                        break
                i = shorter[i]
            if i >= 0:
                out.append(i)
                if end == n:
                    return out
                at, last = end, i
                i = longest[text[at : at + reach(text[at : at + width])]]
                continue
            if not out:
                raise ValueError(f"no sequence of pieces spells {text!r}")
            failed[at] = 1
            i = out.pop()
            at, last = at - sizes[i], out[-1] if out else -1
            i = shorter[i]

    def recall(self) -> None:
        """Unpack which pieces agree."""
        self.pairs.update(zip(self.packed[0], map(bool, self.packed[1]), strict=True))

    def forget(self) -> None:
        """Empty all caches and pack which pieces agree: small objects that stay among those that go would hold their memory."""
        self.packed = array("q", self.pairs), bytes(self.pairs.values())
        for kept in (self.pairs, self.units, self.texts, self.stems):
            kept.clear()

    def stem(self, text: str) -> list[int]:
        """Ids of characters of the vocabulary that may merge with each other, through a cache."""
        got = self.stems.get(text)
        if got is None:
            got = self.backtrack(text)
            if len(text) <= 64:
                if len(self.stems) >= self.cache_units:
                    self.stems.clear()
                self.stems[text] = got
        return got

    def unknown_ids(self, text: str) -> list[int]:
        """Ids of one character that the vocabulary lacks: its bytes, or the unknown id."""
        raw = text.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in raw] if self.bytes else [self.unknown]

    def unit(self, text: str) -> list[int]:
        """Ids of a unit, parted where two neighbours are in no piece; so an unknown character stands alone."""
        if self.chars.issuperset(text):
            if len(text) > 1 and (text[-2], text[-1]) not in self.inside:
                return self.stem(text[:-1]) + self.stem(text[-1])
            return self.stem(text)
        borders = [k for k, pair in enumerate(zip(text, text[1:], strict=False), 1) if pair not in self.inside]
        ids: list[int] = []
        for a, b in zip([0, *borders], [*borders, len(text)], strict=True):
            got = self.stem(text[a:b]) if self.chars.issuperset(text[a:b]) else self.unknown_ids(text[a:b])
            ids += got[1:] if got == [self.unknown] == ids[-1:] else got
        return ids

    def split(self, text: str) -> list[str]:
        """Units of a text, with the leading space that the model adds."""
        return self.cut.findall(" " + text.replace(SPACE, " ")) if text else []

    def encode(self, text: str | None) -> list[int]:
        """All ids of a text with the end id."""
        return [i for u in self.split(text or "") for i in self.unit(u)] + [self.v.end_id]

    def plain(self, ids: list[int]) -> str:
        """Text of ids, added leading space included."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.shown[i] for i in ids])
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(_utf8(raw))
                raw = bytearray()
            out.append(self.shown[i])
        return "".join(out) + _utf8(raw)

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids without the leading space that encoding adds."""
        ids = list(ids)
        text = self.plain(ids)
        lead = next((i for i in ids if self.v.kinds[i] != "c"), None)
        return text[1:] if lead is not None and self.v.kinds[lead] == "n" and text.startswith(" ") else text

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the ids and of the decoded text, through the cache of units."""
        end = str(self.v.end_id)
        if not text:
            return 1, hashlib.sha256(end.encode()).hexdigest(), hashlib.sha256(b"").hexdigest()
        units = self.split(text)
        ids, plain = f"{' '.join(map(self.units.__getitem__, units))} {end}", text.replace(SPACE, " ")
        if OTHER in ids:
            ids, plain = ids.replace(OTHER, ""), "".join(map(self.texts.__getitem__, units))[1:]  # without the space added before the first unit
        return ids.count(" ") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()


class Units(dict):
    """Ids as text by unit, with a mark where they decode to anything but the unit; starts anew when full."""

    def __init__(self, of: Codec):
        super().__init__()
        self.of = of

    def made(self, unit: str) -> str:
        ids, names = self.of.unit(unit), self.of.names
        return " ".join([names[i] for i in ids]) + ("" if self.of.plain(ids) == unit else OTHER)

    def __missing__(self, unit: str) -> str:
        got = self.made(unit)
        if len(unit) <= 64:
            if len(self) >= self.of.cache_units:
                self.clear()
            self[unit] = got
        return got


class Texts(Units):
    """Decoded text by unit, for texts with a unit that has the mark."""

    def made(self, unit: str) -> str:
        return self.of.plain(self.of.unit(unit))


def _utf8(raw: bytearray) -> str:
    """UTF-8 bytes as text; each byte that is part of no character gives U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        size = 1 if raw[at] < 0x80 else 2 if raw[at] >> 5 == 6 else 3 if raw[at] >> 4 == 14 else 4 if raw[at] >> 3 == 30 else 1
        try:
            out.append(raw[at : at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


_CODECS: dict[int, Codec] = {}


def codec(vocabulary: Vocabulary) -> Codec:
    """This Python worker's codec of a vocabulary; made once."""
    key = hash(vocabulary)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocabulary)
    return _CODECS[key]


def forgetting(c: Codec, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, and at their end no encodings kept: an idle worker holds the vocabulary, and packed which pieces agree, alone."""
    c.recall()
    try:
        yield from batches
    finally:
        c.forget()
        pa.default_memory_pool().release_unused()


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids array) of every whole text, with an end id."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary.value)
        for b in forgetting(c, batches):
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ids = [c.encode(t) for t in part.column("text").to_pylist()]
                yield pa.record_batch([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def digest_documents(docs: DataFrame, model_path: str, *others: str) -> DataFrame:
    """Per document the number of ids, and digests of the ids and of the text decoded from them; after that, the columns ``others``."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary.value)
        for b in forgetting(c, batches):
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                n, ids, texts = zip(*map(c.digest, part.column("text").to_pylist()), strict=True)
                yield pa.record_batch([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(texts), *map(part.column, others)], [*names, *others])

    schema = T.StructType.fromDDL(SCHEMA)
    names = schema.names
    return docs.select("doc_id", "text", *others).mapInArrow(run, T.StructType([*schema, *(docs.schema[c] for c in others)]))


def digest_in_order(docs: DataFrame, model_path: str) -> DataFrame:
    """``digest_documents`` of a written table, with its rows in the order in which they stand in the table's files.

    The digests are sorted, not the texts; they are written first, as a sort reads its rows twice.
    """
    at = store.fresh("_at", docs.columns)
    got = store.keep(digest_documents(store.numbered(docs, at), model_path, at), "pc-digests", TEXT_ROWS)
    return got.orderBy(at).drop(at)
