"""Byte-pair encoding with contiguous rank arrays, and decoding, for whole texts.

A short word is held as one contiguous list of parts beside the list of the ranks of adjacent pairs: the smallest rank
is found by a scan, its boundary is deleted, and the two neighbouring ranks are refreshed.  Words of more than
``SHORT_PARTS`` parts go through a heap over a linked list instead, which gives the same merges in n log n time.
Results are remembered per white-space-delimited chunk in a table of bounded size.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import quoted, ship, text_of, unused, without

#: A word of more parts than this is merged with a heap.
SHORT_PARTS = 200
#: Chunks and words that a Python worker remembers, and the longest of them, so that the tables have some 100 MB at most.
REMEMBERED, REMEMBERED_CHARS = 200_000, 64
#: The vocabulary file is broadcast; a larger one is refused.
VOCABULARY_BYTES = 64 << 20
_SHIFT, _NONE = 21, 1 << 62
_MASK = (1 << _SHIFT) - 1
#: Fixed value: the Unicode white space characters (str.split() would also split at U+001C to U+001F).
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte: itself where printable, else the next from U+0100."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, following = {b: chr(b) for b in printable}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b] = chr(following)
            following += 1
    return [letters[b] for b in range(256)]


class _Remembered(dict):
    """A table that fills itself and starts afresh when full; long keys are not kept."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(key) > REMEMBERED_CHARS:
            return self.make(key)
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Tokenizer:
    """Encoder and decoder of a tokenizer file of the word-end BPE kind (lower case, NFC, white space dropped)."""

    def __init__(self, description: str):
        spec = json.loads(description)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.tokens: list[str | None] = [None] * size
        for token, i in [*vocab.items(), *self.specials.items()]:
            self.tokens[i] = token
        letters = _byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + suffix] for c in letters]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left] << _SHIFT | vocab[right]] = rank << _SHIFT | vocab[left + right]
        split = next(s for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.of_word = _Remembered(self._encode_word)
        self.of_chunk = _Remembered(self._encode_chunk)

    def _encode_word(self, word: str) -> bytes:
        raw = word.encode()
        parts = [self.inner[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        merged = self.merge_short(parts) if len(parts) <= SHORT_PARTS else self.merge_long(parts)
        return _packed(merged)

    def merge_short(self, parts: list[int]) -> list[int]:
        rank_of = self.merges.get
        ranks = [rank_of(a << _SHIFT | b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            parts[i] = best & _MASK
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] << _SHIFT | parts[i], _NONE)
            if i < len(ranks):
                ranks[i] = rank_of(parts[i] << _SHIFT | parts[i + 1], _NONE)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        n, rank_of = len(parts), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = [rank_of(parts[i] << _SHIFT | parts[i + 1], _NONE) for i in range(n - 1)] + [_NONE]
        heap = [(r, i) for i, r in enumerate(ranks) if r != _NONE]
        heapq.heapify(heap)

        def refresh(i: int) -> None:
            j = after[i]
            ranks[i] = rank_of(parts[i] << _SHIFT | parts[j], _NONE) if j < n else _NONE
            if ranks[i] != _NONE:
                heapq.heappush(heap, (ranks[i], i))

        while heap:
            best, i = heapq.heappop(heap)
            if ranks[i] != best or parts[i] < 0:
                continue
            j = after[i]
            parts[i], parts[j], ranks[j] = best & _MASK, -1, _NONE
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            refresh(i)
            if before[i] >= 0:
                refresh(before[i])
        return [p for p in parts if p >= 0]

    def _encode_chunk(self, chunk: str) -> bytes:
        out = []
        for piece in self.special.split(chunk) if self.special else [chunk]:
            if piece in self.specials:
                out.append(_packed([self.specials[piece]]))
            elif piece:
                # Letter by letter: a final sigma is not treated apart.
                lowered = piece.lower() if piece.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", piece)))
                out.extend(map(self.of_word.__getitem__, self.words.findall(lowered)))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        chunks = text.split() if not _ODD_SPACE.search(text) else [c for c in _SPACE.split(text) if c]
        return b"".join(map(self.of_chunk.__getitem__, chunks))

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, specials included, joined by spaces (the file names no decoder)."""
        numbers = array("I")
        numbers.frombytes(ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        return " ".join(map(self.tokens.__getitem__, numbers))


def _packed(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


_LOADED: dict[int, Tokenizer] = {}


def _tokenizer(shared) -> Tokenizer:
    if shared.id not in _LOADED:
        _LOADED.clear()
        _LOADED[shared.id] = Tokenizer(shared.value)
    return _LOADED[shared.id]


class _Vocabulary:
    """A broadcast tokenizer file with a name that workers can remember it by."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as f:
            description = f.read(VOCABULARY_BYTES + 1)
        if len(description) > VOCABULARY_BYTES:
            raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
        self.handle = spark.sparkContext.broadcast(description)
        self.id = hash(description)

    @property
    def value(self) -> str:
        return self.handle.value


def encoder(spark: SparkSession, path: str):
    """A column function: text (null: empty) to ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` (text)."""
    ship(spark)
    vocabulary = _Vocabulary(spark, path)

    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def encode_and_decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = _tokenizer(vocabulary)
        for texts in batches:
            ids = [tokenizer.encode(t.as_py() or "") for t in texts]
            decoded = pa.array(map(tokenizer.decode, ids), pa.string(), size=len(ids))
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), decoded], ["ids", "decoded"])

    return encode_and_decode


def bpe_encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``ids`` (binary) and ``decoded`` (string) of every whole text.

    A null or empty text has no ids and the empty decoded text; a long one takes memory for itself and its ids.  Repeated rows
    stay.  Input columns named ids or decoded (in any case) are replaced, also where one of them holds the text.  An empty
    table gives no rows.
    """
    names = without(docs, "ids", "decoded").columns
    (pair,) = unused((*names, "ids", "decoded"), "pair")
    both: Column = encoder(docs.sparkSession, path)(text_of(F.col(quoted(text_col))))
    columns = [F.col(quoted(c)) for c in names]
    return docs.select(*columns, both.alias(pair)).select(*columns, f"{pair}.ids", f"{pair}.decoded")
