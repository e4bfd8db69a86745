"""Benchmark decontamination by pigeonhole edit matching.

With an error budget of k, an item is split into k + 1 pieces, of which at least one occurs unchanged in any text within
the budget.  One automaton finds all exact piece hits of a block of items in a pass over a document; every hit
implies where the item would lie, and Myers' bit-parallel algorithm verifies the edit distance there.  Items and texts have
a space at both ends, so an item does not match inside words.

Items come in blocks of bounded size.  A pass over the documents searches for one block, so a worker never holds more than one
automaton; the finds of a pass (and nothing of the other documents) are written in the shared folder.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import quoted, ship, text_of, unused, without, written

#: Errors allowed, as a share of an item's normalised length.
ERROR_RATE = 0.08
#: Code points of items in a block; a block's automaton takes some hundred bytes for each.  An item is never cut.
BLOCK_CHARS = 1_000_000
_WORD = re.compile(r"[^\W_]+")
_MATCH = T.ArrayType(
    T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)
_ARROW_MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))


def normalise(text: str) -> str:
    """Lower-cased letters and digits, one space between words and at both ends; without words: empty."""
    words = _WORD.findall(text.lower())
    return f" {' '.join(words)} " if words else ""


def budget(length: int, rate: float = ERROR_RATE) -> int:
    return int(rate * length)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of near-equal length with their offsets."""
    n, m = k + 1, len(item)
    return [(m * i // n, item[m * i // n : m * (i + 1) // n]) for i in range(n)]


def masks_of(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    return dict(masks)


def myers(masks: dict[str, int], m: int, text: str, anchored: bool = False) -> tuple[int, int]:
    """The least edit distance of a pattern of length m to a substring of ``text``, and where it ends (first such end).

    With ``anchored`` the substring must start where the text starts.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, at = m, 0
    for j, c in enumerate(text, 1):
        same = masks.get(c, 0)
        vertical = same | minus
        horizontal = (((same & plus) + plus) ^ plus) | same
        up = minus | (~(horizontal | plus) & full)
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1 | anchored) & full
        down = (down << 1) & full
        plus = down | (~(vertical | up) & full)
        minus = up & vertical
        if score < best:
            best, at = score, j
    return best, at


class ItemBlock:
    """A block of items ready to be searched for."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(i, n, budget(len(n) - 2, rate)) for i, n in ((i, normalise(t or "")) for i, t in items) if n]
        self.masks = [masks_of(n) for _, n, _ in self.items]
        self.back_masks = [masks_of(n[::-1]) for _, n, _ in self.items]
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, text, errors) in enumerate(self.items):
            for offset, piece in pieces(text, errors):
                found[piece].append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if found:
            self.automaton.make_automaton()

    def search(self, text: str) -> list[dict]:
        """The best match of every item within its budget in a normalised text: item_id, distance, start, end."""
        if not self.items or not text:
            return []
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (length, uses) in self.automaton.iter(text):
            for k, offset in uses:
                starts[k].add(end - length + 1 - offset)
        matches = []
        for k in sorted(starts):
            item_id, item, errors = self.items[k]
            m, best = len(item), None
            for low, high in _merged(sorted(starts[k]), m, errors, len(text)):
                distance, end = myers(self.masks[k], m, text[low:high])
                if distance <= errors and (best is None or distance < best[0]):
                    best = distance, low + end
            if best:
                distance, end = best
                _, length = myers(self.back_masks[k], m, text[max(0, end - m - errors) : end][::-1], anchored=True)
                matches.append({"item_id": item_id, "distance": distance, "start": end - length, "end": end})
        return matches


def _merged(starts: list[int], m: int, errors: int, size: int) -> Iterator[tuple[int, int]]:
    """Windows around the implied starts; those that overlap are one."""
    low = high = None
    for s in starts:
        a, b = max(0, s - errors), min(size, s + m + errors)
        if high is not None and a <= high:
            high = max(high, b)
        else:
            if high is not None:
                yield low, high
            low, high = a, b
    if high is not None:
        yield low, high


def _original(text: str, matches: list[dict]) -> list[dict]:
    """Matches with the positions, in the original text, of the words that they touch."""
    lowered, spans, at = text.lower(), [], 1
    for word in _WORD.finditer(lowered):
        spans.append((at, at + len(word[0]), word.start(), word.end()))
        at += len(word[0]) + 1
    if len(lowered) == len(text):
        origin = range(len(text) + 1)
    else:  # some letters have more than one lower-case code point
        origin = [i for i, c in enumerate(text) for _ in c.lower()]
    starts, ends = [w[0] for w in spans], [w[1] for w in spans]
    out = []
    for match in matches:
        first = min(bisect_right(ends, match["start"]), len(spans) - 1)
        last = max(bisect_left(starts, match["end"]) - 1, first)
        out.append(match | {"start": origin[spans[first][2]], "end": origin[spans[last][3] - 1] + 1})
    return out


_READY: dict[int, ItemBlock] = {}


def _ready(shared, key: int, rate: float) -> ItemBlock:
    """The block's automaton, kept by the worker until it meets another block."""
    if key not in _READY:
        _READY.clear()
        _READY[key] = ItemBlock(shared.value, rate)
    return _READY[key]


def _searcher(spark: SparkSession, block: list[tuple[int, str]], rate: float):
    shared, key = spark.sparkContext.broadcast(block), hash((tuple(block), rate))

    @F.arrow_udf(returnType=_MATCH)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ready = _ready(shared, key, rate)
        for texts in batches:
            out = []
            for t in texts:
                raw = t.as_py() or ""
                matches = ready.search(normalise(raw))
                out.append(_original(raw, matches) if matches else [])
            yield pa.array(out, _ARROW_MATCH)

    return search


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    rows = items.select(F.col(quoted(id_col)).cast("long"), F.col(quoted(text_col)).cast("string")).toLocalIterator()
    for item_id, text in rows:
        if block and size + len(text or "") > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text or "")
    if block:
        yield block


def find_leaks(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", rate: float = ERROR_RATE
) -> DataFrame:
    """All columns of ``docs`` plus ``leaks``: for each item found, (item_id, distance, start, end) of its best match.

    The distance is between normalised texts (``normalise``) and at most ``rate`` times the item's length; of equal
    distances the first match counts.  Start and end are positions in the text of the words that the match touches.  Null and
    empty texts have no leaks, items without a letter or digit never match, and repeated items match each.  Repeated rows
    stay.  Texts and items may have any length.  An input column called leaks (in any case) is replaced, also where it holds
    the text.  Leaks are sorted.  Empty tables give no leaks.
    """
    spark = docs.sparkSession
    ship(spark)
    names = without(docs, "leaks").columns
    text = text_of(F.col(quoted(text_col)))
    columns = [F.col(quoted(c)) for c in names]
    blocks = _blocks(items, item_id_col, item_text_col)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return docs.select(*columns, F.array().cast(_MATCH).alias("leaks"))
    if second is None:
        return docs.select(*columns, F.array_sort(_searcher(spark, first, rate)(text)).alias("leaks"))
    row, some, given = unused((*names, "leaks"), "row", "some", "given")
    numbered = written(docs.select(*columns, text.alias(given), F.monotonically_increasing_id().alias(row)), "leak-texts")
    found = None
    for block in chain((first, second), blocks):
        searched = numbered.select(row, _searcher(spark, block, rate)(F.col(given)).alias(some)).where(F.size(some) > 0)
        part = written(searched.select(row, F.explode(some).alias(some)), "leaks")
        found = part if found is None else found.unionByName(part)
    # A document has a find for each item at most.
    listed = found.groupBy(row).agg(F.array_sort(F.collect_list(some)).alias("leaks"))
    joined = numbered.join(listed, row, "left")
    return joined.select(*columns, F.coalesce("leaks", F.array().cast(_MATCH)).alias("leaks"))
