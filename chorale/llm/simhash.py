"""SimHash near-duplicates: fingerprints of word shingles, linked by pigeonring filtering.

A fingerprint is cut into a ring of eight segments of eight bits.  If two fingerprints differ in at most three bits, the
pigeonring principle gives a start from which every chain of l consecutive segments differs in at most 3 l / 8 bits: the
first two segments are equal, the first five differ in at most one bit, the first seven in at most two.  So two of the
third to fifth segments are equal as well, and 32 equal bits make the key of a candidate; a join on the 24 such keys
checks the chain before the full Hamming distance.  Keys with very many fingerprints are refined by the remaining bits
(at most three of their eight nibbles differ), so no bucket holds more than 4,096 of them.  Equal fingerprints are one node.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shared import checkpointed, quoted, ship, text_of, unused, without, written

SHINGLE_WORDS, SEED, MAX_BITS = 3, 42, 3
#: Fingerprints under one key above which the key is refined.
DENSE = 256
#: Dense keys up to this many are broadcast (under 2 MB); more are joined by a shuffle.
BROADCAST_KEYS = 100_000
#: Shingle hashes that are unpacked at once.
_BLOCK = 1 << 16


def shingle_hashes(raw: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """The hashes of all shingles of a UTF-8 text: A-Z lower-cased, ASCII white space between words; few words are one shingle."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)))) if len(words) >= shingle_words else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, seed) for s in shingles), np.uint64, max(1, len(words) - shingle_words + 1))


def fingerprint_of(hashes: np.ndarray) -> int:
    """The SimHash: bits that are set in over half the hashes; without any: 0."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        ones += np.unpackbits(hashes[at : at + _BLOCK].view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([fingerprint_of(shingle_hashes(t.as_py() or b"")) for t in texts.cast(pa.binary())], pa.int64())


fingerprint = F.arrow_udf(_fingerprints, T.LongType())


def _segment(fp: Column, i: int) -> Column:
    """Segment i (from the top, around the ring) as a long."""
    return F.shiftrightunsigned(fp, 56 - 8 * (i % 8)).bitwiseAND(F.lit(0xFF).cast("long"))


def _keys(fp: Column) -> Column:
    """The 24 candidate keys: start and choice above 32 bits of four segments."""
    keys = []
    for start in range(8):
        for chosen in combinations((2, 3, 4), 2):
            value = F.lit(len(keys)).cast("long")
            for offset in (0, 1, *chosen):
                value = F.shiftleft(value, 8).bitwiseOR(_segment(fp, start + offset))
            keys.append(value)
    return F.array(*keys)


def _chosen_segments() -> list[tuple[int, list[int]]]:
    return [(start * 3 + c, sorted((start + o) % 8 for o in (0, 1, *chosen))) for start in range(8) for c, chosen in enumerate(combinations((2, 3, 4), 2))]


def _fine_keys(key: Column, fp: Column) -> Column:
    """For a dense key: of the 32 bits outside it, every choice of five of the eight nibbles (at least five are equal)."""
    number = F.shiftrightunsigned(key, 32)
    rest = F.lit(None).cast("long")
    for n, used in _chosen_segments():
        value = F.lit(0).cast("long")
        for i in range(8):
            if i not in used:
                value = F.shiftleft(value, 8).bitwiseOR(_segment(fp, i))
        rest = F.when(number == n, value).otherwise(rest)
    fine = []
    for n, chosen in enumerate(combinations(range(8), 5)):
        mask = sum(0xF << (4 * c) for c in chosen)
        fine.append(F.lit(n << 32).bitwiseOR(rest.bitwiseAND(F.lit(mask).cast("long"))))
    return F.array(*fine)


def _linked(a: Column, b: Column, key: Column) -> Column:
    """Chain check from the key's start, then the full check."""
    start = F.floor(F.shiftrightunsigned(key, 32) / 3).cast("int") * 8
    difference = a.bitwiseXOR(b)
    turned = F.when(start == 0, difference)
    for s in range(8, 64, 8):
        turned = turned.when(start == s, F.shiftleft(difference, s).bitwiseOR(F.shiftrightunsigned(difference, 64 - s)))
    first = lambda segments: F.bit_count(F.shiftrightunsigned(turned, 64 - 8 * segments))
    return (first(5) <= 1) & (first(7) <= 2) & (F.bit_count(difference) <= MAX_BITS)


def _join(keyed: DataFrame, on: list[str]) -> DataFrame:
    left, right = keyed.alias("l"), keyed.alias("r")
    same = F.lit(True)
    for c in on:
        same = same & (F.col(f"l.{c}") == F.col(f"r.{c}"))
    a, b = F.col("l.fp"), F.col("r.fp")
    return left.join(right, same & (a < b) & _linked(a, b, F.col("l.key"))).select(a.alias("a"), b.alias("b"))


def fingerprint_links(fingerprints: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) to all pairs (a, b), a < b, that differ in at most three bits."""
    keyed = fingerprints.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    dense = checkpointed(keyed.groupBy("key").count().where(F.col("count") > DENSE).select("key"))
    n_dense = dense.limit(BROADCAST_KEYS + 1).count()
    if not n_dense:
        return _join(keyed, ["key"]).distinct()
    if n_dense <= BROADCAST_KEYS:
        dense = F.broadcast(dense)
    fine = keyed.join(dense, "key", "left_semi").select("fp", "key", F.explode(_fine_keys(F.col("key"), F.col("fp"))).alias("fine"))
    return _join(keyed.join(dense, "key", "left_anti"), ["key"]).union(_join(fine, ["key", "fine"])).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``carry`` (all) of ``docs`` plus ``fp`` (long) and ``component_id``: the smallest id reachable.

    A null or empty text has fingerprint zero and is linked like any other; equal fingerprints are linked.  A long text is
    hashed as a whole.  Null ids do not count as smallest: a component of null ids only has a null component_id.  Repeated rows
    stay and agree.  Input columns named fp or component_id (in any case) are replaced, also where one of them holds the id or
    text.  An empty table gives no rows.
    """
    ship(docs.sparkSession)
    names = without(docs, "fp", "component_id").columns
    names = names if carry is None else [c for c in names if c in carry]
    given, of = unused((*names, "fp", "component_id"), "given", "of")
    marked = written(docs.select(*[F.col(quoted(c)) for c in names], F.col(quoted(id_col)).alias(given), fingerprint(text_of(F.col(quoted(text_col)))).alias("fp")), "fingerprints")
    nodes = checkpointed(marked.groupBy("fp").agg(F.min(given).alias("best")))
    members = components(fingerprint_links(nodes.select("fp")))
    rooted = nodes.join(members, nodes["fp"] == members["node"], "left").select(F.col("fp").alias(of), "best", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min("best").alias("component_id"))
    # Many rows to one: a hot fingerprint is split by AQE's skew join.
    joined = marked.drop(given).join(rooted.join(best, "root").select(of, "component_id"), F.col("fp") == F.col(of))
    return joined.drop(of)
