"""Vector algebra in DataFrame form: means, affinities, neighbour graphs, degrees, silhouettes.

Pairs exist only inside a recording (``keys``), never across the table, and one recording's pairs are made in several tasks.
What needs no pairs (means, silhouettes) goes through sums of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import dot, unit_vector
from ..shipping import ship

#: Tasks that make the pairs of one recording, each of a part of the rows and all columns; and rows of a block.
PARTS, BLOCK = 8, 512


def vector_mean(vectors: DataFrame, by: list[str], vec: str = "vec", weight: str | None = None) -> DataFrame:
    """Element-wise mean per group, weighted if a weight is named; where weights sum to 0 or less, the weighted sum."""
    elements = vectors.select(*by, *([weight] if weight else []), F.posexplode(vec).alias("pos", "x"))
    if weight:
        total = F.sum(weight)
        value = F.sum(F.col(weight) * F.col("x")) / F.when(total > 0, total).otherwise(F.lit(1.0))
    else:
        value = F.avg(F.col("x").cast("double"))
    means = elements.groupBy(*by, "pos").agg(value.alias("x"))
    return means.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("vec"))


def feature_norm(vectors: DataFrame, by: list[str], idx: str, vec: str = "vec") -> DataFrame:
    """Each feature less its mean over the group, divided by sqrt(population variance + 1e-12)."""
    elements = vectors.select(*by, idx, F.posexplode(vec).alias("pos", "x")).withColumn("x", F.col("x").cast("double"))
    stats = elements.groupBy(*by, "pos").agg(F.avg("x").alias("__mean"), F.sqrt(F.var_pop("x") + 1e-12).alias("__std"))
    scaled = elements.join(stats, [*by, "pos"]).select(*by, idx, "pos", ((F.col("x") - F.col("__mean")) / F.col("__std")).alias("x"))
    return scaled.groupBy(*by, idx).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("vec"))


def _blocks(vectors: DataFrame, keys: list[str], idx: str, vec: str) -> DataFrame:
    """(keys, block, ids, units): unit vectors in blocks of BLOCK by idx, each one array; null vectors have no pairs."""
    units = vectors.where(F.col(vec).isNotNull()).select(*keys, F.col(idx).cast("long").alias("id"), unit_vector(F.col(vec)).alias("u"))
    block = F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy("id")) - 1) / BLOCK)
    listed = units.withColumn("block", block).groupBy(*keys, "block").agg(F.array_sort(F.collect_list(F.struct("id", "u"))).alias("rows"))
    return listed.select(*keys, "block", F.col("rows.id").alias("ids"), F.flatten(F.col("rows.u")).alias("units"))


def _meet(rows: DataFrame, every: DataFrame, keys: list[str], work, out: str) -> DataFrame:
    """``work`` on the cosines of each pair of blocks of a recording: it takes the ids i and j and the cosines (i, j), and returns columns.

    A task holds one pair of blocks at a time, whatever the recording's size, and a recording's pairs are dealt to PARTS tasks.
    """
    ship(rows.sparkSession)
    left = rows.select(*keys, F.pmod("block", F.lit(PARTS)).alias("part"), F.col("ids").alias("i"), F.col("units").alias("a"))
    right = every.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))).alias("part"), F.col("ids").alias("j"), F.col("units").alias("b"))
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    names, n_keys = [*keys, *(c.split()[0] for c in out.split(", "))], len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(len(batch)):
                i, a, j, b = (c[n].values.to_numpy(zero_copy_only=False) for c in batch.columns[n_keys:])
                w = a.reshape(len(i), -1) @ b.reshape(len(j), -1).T
                w[i[:, None] == j] = 1.0
                found = work(i, j, w)
                named = (pa.array([c[n].as_py()] * len(found[0]), c.type) for c in batch.columns[:n_keys])
                yield pa.RecordBatch.from_arrays([*named, *map(pa.array, found)], names)

    pairs = left.join(right, [*keys, "part"]).select(*keys, "i", "a", "j", "b")
    return pairs.mapInArrow(run, f"{kinds}, {out}")


def _spans(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Least cosine and range of each recording, over all its pairs."""
    parts = _meet(blocks, blocks, keys, lambda i, j, w: ([w.min()], [w.max()]), "low double, high double")
    return parts.groupBy(*keys).agg(F.min("low").alias("__low"), (F.max("high") - F.min("low")).alias("__span"))


def _scaled(pairs: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    w = F.when(F.col("__span") < 1e-12, F.lit(1.0)).otherwise((F.col("w") - F.col("__low")) / F.col("__span"))
    return pairs.join(F.broadcast(_spans(blocks, keys)), keys).select(*keys, "i", "j", w.alias("w"))


def cosine_affinity(vectors: DataFrame, keys: list[str], idx: str = "sub_idx", vec: str = "vec", rows: Column | None = None) -> DataFrame:
    """(keys, i, j, w): cosines with ones on the diagonal, scaled to 0..1 by all pairs of the recording; a range under 1e-12 gives ones.

    ``rows`` is a condition that says which rows i of the affinity are wanted (all).
    """
    blocks = _blocks(vectors, keys, idx, vec)
    wanted = blocks if rows is None else _blocks(vectors.where(rows), keys, idx, vec)
    pairs = _meet(wanted, blocks, keys, lambda i, j, w: (np.repeat(i, len(j)), np.tile(j, len(i)), w.ravel()), "i long, j long, w double")
    return _scaled(pairs, blocks, keys)


def nearest_vectors(vectors: DataFrame, keys: list[str], p: int, idx: str = "sub_idx", vec: str = "vec", digits: int = 9) -> DataFrame:
    """``nearest`` of ``cosine_affinity`` rounded to ``digits``, without the pairs as rows.

    Of each row of a pair of blocks go on the p strongest and all that rounding may put level with the last of them; of equal
    cosines those of the p lowest j, which come first.
    """
    blocks = _blocks(vectors, keys, idx, vec)
    slack = 4 * 10.0**-digits  # rounding moves a cosine by one digit of the range, which is 2 at most

    def work(i: np.ndarray, j: np.ndarray, w: np.ndarray):
        place = max(0, len(j) - p)
        bound = np.partition(w, place, axis=1)[:, place]
        row, column = np.nonzero(~(w < bound[:, None] - slack))
        value = w[row, column]
        order = np.lexsort((column, value, row))
        first = np.r_[True, (np.diff(row[order]) != 0) | (value[order][1:] != value[order][:-1])]
        kept = order[np.arange(len(order)) - np.flatnonzero(first)[np.cumsum(first) - 1] < p]
        return i[row[kept]], j[column[kept]], value[kept]

    pairs = _scaled(_meet(blocks, blocks, keys, work, "i long, j long, w double"), blocks, keys)
    return nearest(pairs.withColumn("w", F.round("w", digits)), keys, p)


def nearest(affinity: DataFrame, keys: list[str], p: int) -> DataFrame:
    """The p strongest of each row, itself included; ties go to the lower j."""
    rank = F.row_number().over(Window.partitionBy(*keys, "i").orderBy(F.desc("w"), "j"))
    return affinity.withColumn("rank", rank).where(F.col("rank") <= p)


def neighbour_graph(affinity: DataFrame, keys: list[str], p: int) -> DataFrame:
    """``graph_of`` the p nearest of an affinity."""
    return graph_of(nearest(affinity, keys, p), keys)


def graph_of(near: DataFrame, keys: list[str]) -> DataFrame:
    """Edges (i, j, w) of the symmetrised graph of each row's nearest: 1 where both choose each other, else 1/2."""
    chosen = near.select(*keys, "i", "j")
    both = F.array(F.struct(F.col("i").alias("i"), F.col("j").alias("j")), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    return chosen.select(*keys, F.explode(both).alias("e")).groupBy(*keys, "e").agg((F.count(F.lit(1)) * 0.5).alias("w")).select(*keys, "e.i", "e.j", "w")


def degrees(graph: DataFrame, keys: list[str]) -> DataFrame:
    """Row sums without the diagonal: the diagonal of the unnormalised Laplacian; nodes without other edges have 0."""
    return graph.groupBy(*keys, "i").agg(F.coalesce(F.sum(F.when(F.col("i") != F.col("j"), F.col("w"))), F.lit(0.0)).alias("degree"))


def laplacian(graph: DataFrame, keys: list[str]) -> DataFrame:
    """Non-zero entries of degree minus weight, the weight's diagonal taken as 0."""
    off = graph.where("i <> j").select(*keys, "i", "j", (-F.col("w")).alias("w"))
    return off.unionByName(degrees(graph, keys).select(*keys, "i", F.col("i").alias("j"), F.col("degree").alias("w")))


def silhouette(vectors: DataFrame, keys: list[str], idx: str, label: str, vec: str = "vec") -> DataFrame:
    """Mean silhouette by cosine distance per recording: (keys, k, silhouette).

    One cluster gives -1.  A single member has inner distance 0.  Where both distances are 0 the score is undefined (null).
    The mean distance of a unit vector u to a cluster of n with the sum S of units is 1 - u S / n, so there are no pairs.
    """
    units = vectors.select(*keys, F.col(idx).alias("i"), F.col(label).alias("own"), unit_vector(F.col(vec), 0.0).alias("u"))
    sums = units.select(*keys, "own", F.posexplode("u").alias("pos", "x")).groupBy(*keys, "own", "pos").agg(F.sum("x").alias("x"), F.count(F.lit(1)).alias("n"))
    clusters = sums.groupBy(*keys, F.col("own").alias("other")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("sum"), F.max("n").alias("n")
    )
    same, along = F.col("own") == F.col("other"), dot(F.col("u"), F.col("sum"))
    inner = F.when(F.col("n") > 1, 1 - (along - dot(F.col("u"), F.col("u"))) / (F.col("n") - 1)).otherwise(F.lit(0.0))
    each = units.join(clusters, keys).groupBy(*keys, "i").agg(
        F.max(F.when(same, inner)).alias("a"), F.coalesce(F.min(F.when(~same, 1 - along / F.col("n"))), F.lit(0.0)).alias("b"), F.first("own").alias("own")
    )
    score = F.when(F.greatest("a", "b") != 0, (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    total = each.groupBy(*keys).agg(F.countDistinct("own").alias("k"), F.when(F.bool_and(score.isNotNull()), F.avg(score)).alias("__mean"))
    return total.select(*keys, "k", F.when(F.col("k") <= 1, F.lit(-1.0)).otherwise(F.col("__mean")).alias("silhouette"))


def mode_vote(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value per key; ties go to the smallest."""
    counts = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    best = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), value))
    return counts.withColumn("__rank", best).where("__rank = 1").drop("__rank")


def eigengaps(values: DataFrame, keys: list[str]) -> DataFrame:
    """Differences to the next larger eigenvalue (keys, k, value): k counts from 0."""
    window = Window.partitionBy(*keys).orderBy("k")
    return values.withColumn("gap", F.lead("value").over(window) - F.col("value")).where("gap is not null")
