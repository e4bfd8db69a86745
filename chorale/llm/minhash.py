"""Near copies for the pipeline: one document of each group, by the Jaccard similarity of five-word shingles.

At a similarity of 0.8 the SimHashes of two texts differ in about ten of 64 bits, a budget at which pigeonring keys no longer
tell texts apart.  So groups have two kinds of links: the SimHash links of ``simhash`` (three bits, pigeonring filtering) on
five-word shingles, and pairs that an exact check of the shingles finds at 0.8 or more.  Candidates of the latter come
from MinHash: 20 bands of five values, of which texts of similarity s share one with probability 1 - (1 - s^5)^20, 0.9996
at 0.8.  Texts with the same shingles are one node.

In a band with few texts all pairs are candidates.  In a dense band each text is first compared to a few leaders, which joins most
large groups at the cost of their size.  What is still apart there is compared in full, by blocks of texts as sets of shingle
hashes: a task meets two blocks at a time and returns only which groups are linked, so pairs are never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shared import checkpointed, quoted, ship, text_of, unused, written
from .simhash import SEED, fingerprint_links, fingerprint_of, shingle_hashes

SHINGLE_WORDS, SIMILARITY = 5, 0.8
BANDS, BAND_VALUES = 20, 5
#: Texts in a band above which it is dense, and the leaders that its texts are compared to.
DENSE, LEADERS = 32, 4
#: Texts of a block, tasks that share a dense band's blocks, and shingles of two blocks that are looked at at once.
BLOCK, PARTS, _COLUMNS = 128, 8, 4096
#: Rows up to this many are broadcast (a few MB); more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Shingle hashes that are permuted at once.
_BLOCK = 2048
_RNG = np.random.Generator(np.random.PCG64(SEED))
_MIX, _ODD = _RNG.integers(0, 1 << 64, (2, BANDS * BAND_VALUES, 1), np.uint64) | np.array([[[0]], [[1]]], np.uint64)
_SIGNATURE = T.StructType(
    [T.StructField("node", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("bands", T.ArrayType(T.LongType()))]
)


def shingles_of(raw: bytes) -> set[bytes]:
    """The distinct shingles of a UTF-8 text: A-Z lower-cased, ASCII white space between words; one if it has few words."""
    words = raw.lower().split()
    if len(words) < SHINGLE_WORDS:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)))))


def similar(a: set[bytes], b: set[bytes]) -> bool:
    both = len(a & b)
    return both >= SIMILARITY * (len(a) + len(b) - both)


def signature_of(raw: bytes) -> tuple[int, int, int, list[int]]:
    """A hash of the set of shingles, the SimHash, the number of distinct shingles, and the bands (none without words)."""
    every = shingle_hashes(raw, SHINGLE_WORDS)
    hashes = np.unique(every)
    node = int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).astype(np.int64))
    if not len(hashes):
        return node, 0, 0, []
    least = np.full(BANDS * BAND_VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _BLOCK):
        least = np.minimum(least, ((hashes[at : at + _BLOCK] ^ _MIX) * _ODD).min(1))
    bands = least.reshape(BANDS, BAND_VALUES)
    digests = np.array([xxhash.xxh64_intdigest(b.tobytes(), n) for n, b in enumerate(bands)], np.uint64)
    return node, fingerprint_of(every), len(hashes), digests.view(np.int64).tolist()


def _signatures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
    for texts in batches:
        rows = [signature_of(t.as_py() or b"") for t in texts.cast(pa.binary())]
        yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], _SIGNATURE.names)


def _checked(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([similar(shingles_of(x.as_py()), shingles_of(y.as_py())) for x, y in zip(a.cast(pa.binary()), b.cast(pa.binary()))], pa.bool_())


signature = F.arrow_udf(_signatures, _SIGNATURE)
checked = F.arrow_udf(_checked, T.BooleanType())


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _pair(a: Column, b: Column) -> Column:
    """Two rows (node, size) as a candidate, the lesser node first."""
    return F.struct(
        F.least(a["node"], b["node"]).alias("a"), F.greatest(a["node"], b["node"]).alias("b"), F.least(a["size"], b["size"]).alias("less"), F.greatest(a["size"], b["size"]).alias("more")
    )


def _candidates(pairs: DataFrame) -> DataFrame:
    """Distinct (a, b) of the pairs whose sizes allow the similarity."""
    return pairs.select("p.*").where((F.col("a") < F.col("b")) & (F.col("less") >= SIMILARITY * F.col("more"))).select("a", "b").distinct()


def _band_pairs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of rows (key, node, size, apart) with the same key that differ in ``apart``, or with leaders of it; and the dense keys."""
    leaders = F.array(*[F.min_by(F.struct("node", "size", "apart"), F.xxhash64("node", F.lit(salt))) for salt in range(LEADERS)])
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("apart").alias("low"), F.max("apart").alias("high"), leaders.alias("leaders"))
    shared = written(shared.where("low < high").drop("low", "high"), "bands")
    row = F.struct("node", "size").alias("row")
    few = rows.join(shared.where(F.col("n") <= DENSE).select("key"), "key", "left_semi").select("key", "apart", row)
    left, right = few.alias("l"), few.alias("r")
    pairs = left.join(right, (F.col("l.key") == F.col("r.key")) & (F.col("l.apart") < F.col("r.apart"))).select(_pair(F.col("l.row"), F.col("r.row")).alias("p"))
    dense = shared.where(F.col("n") > DENSE)
    led = rows.join(_small(dense.select("key", "leaders")), "key").select("apart", row, F.explode("leaders").alias("leader"))
    return pairs.union(led.where("apart <> leader.apart").select(_pair(F.col("row"), F.col("leader")).alias("p"))), dense.select("key")


def _texts(marked: DataFrame, wanted: DataFrame, row: str, text: Column) -> DataFrame:
    """(node, text) of rows (node, row)."""
    return marked.select(row, text.alias("text")).join(_small(checkpointed(wanted)), row).select("node", "text")


def _linked(candidates: DataFrame, marked: DataFrame, best: DataFrame, row: str, text: Column) -> DataFrame:
    """The candidates (a, b) that are similar; ``best`` has the row of each node whose text is read."""
    pairs = written(candidates, "pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = written(_texts(marked, best.join(ends, "node"), row, text), "texts")
    one, two = (texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}")) for n in "ab")
    return checkpointed(pairs.join(one, "a").join(two, "b").where(checked("text_a", "text_b")).select("a", "b"))


def _hashes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([np.unique(shingle_hashes(t.as_py() or b"", SHINGLE_WORDS)).view(np.int64) for t in texts.cast(pa.binary())], pa.list_(pa.int64()))


hashes_of = F.arrow_udf(_hashes, T.ArrayType(T.LongType()))


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set of the left has in common with each of the right."""
    known = np.intersect1d(np.concatenate(left), np.concatenate(right))
    found = np.zeros((len(left), len(right)), np.float32)
    places = [[np.searchsorted(known, x[np.isin(x, known)]) for x in side] for side in (left, right)]
    for at in range(0, len(known), _COLUMNS):
        marks = []
        for side in places:
            marks.append(np.zeros((len(side), _COLUMNS), np.float32))
            for n, x in enumerate(side):
                marks[-1][n, x[(x >= at) & (x < at + _COLUMNS)] - at] = 1
        found += marks[0] @ marks[1].T
    return found


def _forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Of pairs of groups those that link what the ones before do not."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.get(x, x) != x:
            above[x] = x = above.get(above[x], above[x])
        return x

    kept = []
    for a, b in pairs.tolist():
        if (x := top(a)) != (y := top(b)):
            above[y] = x
            kept.append((a, b))
    return kept


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for n in range(len(batch)):
            sides = [batch.column(c)[n].values for c in (0, 1)]
            groups = [s.field("apart").to_numpy() for s in sides]
            sets = [[x.values.to_numpy() for x in s.field("hashes")] for s in sides]
            sizes = [np.array([len(x) for x in side]) for side in sets]
            both = common(*sets).astype(np.int64)
            near = (both >= SIMILARITY * (sizes[0][:, None] + sizes[1] - both)) & (groups[0][:, None] != groups[1])
            i, j = np.nonzero(near)
            links = _forest(np.unique(np.stack([groups[0][i], groups[1][j]], 1), axis=0))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])


def _dense_links(placed: DataFrame, marked: DataFrame, best: DataFrame, row: str, text: Column) -> DataFrame:
    """Links (a, b) between groups: of all pairs of rows (key, node, apart) with one key, those similar that differ in ``apart``."""
    open_keys = placed.groupBy("key").agg(F.min("apart").alias("low"), F.max("apart").alias("high")).where("low < high").select("key")
    placed = checkpointed(placed.join(_small(open_keys), "key", "left_semi"))
    texts = _texts(marked, best.join(placed.select("node").distinct(), "node"), row, text)
    sets = written(texts.select("node", hashes_of("text").alias("hashes")), "hashes")
    block = F.floor((F.row_number().over(Window.partitionBy("key").orderBy("node")) - 1) / BLOCK)
    blocks = placed.withColumn("block", block).join(sets, "node").groupBy("key", "block").agg(F.collect_list(F.struct("apart", "hashes")).alias("texts"))
    blocks = written(blocks, "blocks")
    left = blocks.select("key", F.pmod("block", F.lit(PARTS)).alias("part"), F.col("block").alias("first"), F.col("texts").alias("one"))
    right = blocks.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))).alias("part"), F.col("block").alias("second"), F.col("texts").alias("two"))
    return left.join(right, ["key", "part"]).where("first <= second").select("one", "two").mapInArrow(_met, "a long, b long")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies: the one with the smallest id (a null id is smaller), then any one of equal ids.

    Texts are linked if their sets of five-word shingles have a Jaccard similarity of 0.8 or more, or if their SimHashes on
    them differ in at most three bits; groups are what links reach.  Texts without words (null, empty, white space) are one
    group, and a text of fewer than five words has one shingle.  Long texts count as a whole.  Repeated rows are copies.
    Other columns, of any name, stay.  An empty table gives no rows.
    """
    ship(docs.sparkSession)
    names = docs.columns
    of, row = unused(names, "of", "row")
    text = text_of(F.col(quoted(text_col)))
    marked = written(docs.select(*[F.col(quoted(c)) for c in names], signature(text).alias(of), F.monotonically_increasing_id().alias(row)), "signatures")
    rank = F.struct(F.col(quoted(id_col)).alias("id"), F.col(row).alias("row"))
    nodes = marked.select(f"{of}.*", rank.alias("rank")).groupBy("node").agg(F.min("rank").alias("best"), *[F.first(c).alias(c) for c in ("fp", "size", "bands")])
    nodes = written(nodes, "nodes")
    best = nodes.select("node", F.col("best.row").alias(row))

    # Links of fingerprints, from each node to the least one with its fingerprint and between those.
    worded = nodes.where("size > 0").select("node", "fp")
    least = worded.groupBy("fp").agg(F.min("node").alias("least"))
    by_print = checkpointed(fingerprint_links(worded.select("fp").distinct()))
    ends = [least.select(F.col("fp").alias(c), F.col("least").alias(f"node_{c}")) for c in "ab"]
    links = by_print.join(ends[0], "a").join(ends[1], "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    links = links.union(worded.join(least, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")))

    # Links of similar texts: all pairs of bands with few texts, and those to leaders in dense ones.
    pairs, dense = _band_pairs(nodes.select("node", "size", F.col("node").alias("apart"), F.explode("bands").alias("key")))
    links = checkpointed(links.union(_linked(_candidates(pairs), marked, best, row, text)))
    members = components(links)

    # In dense bands, all pairs of what is still apart: links lead from root to root.
    if not dense.isEmpty():
        placed = nodes.select("node", F.explode("bands").alias("key")).join(_small(dense), "key", "left_semi")
        rooted = placed.join(members, "node", "left").select("key", "node", F.coalesce("root", "node").alias("apart"))
        more = checkpointed(_dense_links(rooted, marked, best, row, text))
        further = checkpointed(components(more).select(F.col("node").alias("root"), F.col("root").alias("top")))
        every = members.unionByName(further.select(F.col("root").alias("node"), "root")).distinct()  # a group of one has no row yet
        members = every.join(further, "root", "left").select("node", F.coalesce("top", "root").alias("root"))

    grouped = nodes.select("node", "best").join(members, "node", "left").select("best", F.coalesce("root", "node").alias("root"))
    chosen = grouped.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias(row))
    return marked.join(chosen, row, "left_semi").select(*map(quoted, names))
