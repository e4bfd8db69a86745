"""Histogram sort: documents into shards of near-equal bytes by exact counts below candidate key boundaries.

The sort key of a row is a fixed-width string of hexadecimal digits: the 64-bit hash of its text and two hashes of all its
columns.  Rounds of one map-side-combined aggregation count the exact bytes and rows under cells of equal key prefixes;
only cells that hold an unmet boundary of a shard are probed deeper.  So every boundary becomes a row's rank in key order.

For the exchange, keys are cut into cells of a task's share or less, again by counts: a cell that is too large gets a longer
prefix.  Their counts say at which rank each cell starts; a marker row carries that rank through the one exchange to the task
that sorts the cell, where rank, shard and slot follow.  No task or driver ever holds a shard, or a group of copies.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate
from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import quoted, text_of, without, written

#: Hexadecimal digits of a key, of those that the first round probes, and that each later round adds.
WIDTH, FIRST_DIGITS, MORE_DIGITS = 48, 3, 2
#: Bytes that a task sorts, tasks for each shard at least, and tasks at most (then they take more bytes).
TASK_BYTES, TASKS_PER_SHARD, MAX_TASKS = 64 << 20, 4, 1 << 20
#: Copies of one row that a task makes at once.
COPIES = 100_000


def byte_size(text: str | Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 1."""
    return (F.octet_length(text_of(text)) + 1).cast("long")


def _hex64(value: Column) -> Column:
    return F.lpad(F.hex(value), 16, "0")


def sort_key(df: DataFrame, text_col: str) -> Column:
    """Text hash, then two hashes of every column (maps and variants as text)."""
    plain = lambda kind: "map<" not in kind and kind != "variant"
    columns = [F.col(quoted(c)) if plain(kind) else F.col(quoted(c)).cast("string") for c, kind in df.dtypes]
    return F.concat(_hex64(F.xxhash64(text_of(F.col(quoted(text_col))))), _hex64(F.xxhash64(F.lit(1), *columns)), _hex64(F.xxhash64(F.lit(2), *columns)))


def _shared_digits(low: str, high: str) -> int:
    return next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), len(low))


def find_boundaries(keys: DataFrame, n_shards: int, tolerance: float) -> tuple[list[int], int]:
    """The rank of each shard's first row but the first one's, in key order of ``keys`` (key, size); and the number of rounds.

    A boundary misses by ``tolerance`` of a shard's bytes at most, or by less than a row.  Only cells around a boundary reach the
    driver: at most ``16 ** FIRST_DIGITS`` in the first round and ``n_shards * 16 ** MORE_DIGITS`` in each later one.
    """
    depth, rounds, total = FIRST_DIGITS, 0, None
    done: dict[int, int] = {}
    open_cells: dict[str, tuple[int, int, list[int]]] = {"": (0, 0, list(range(1, n_shards)))}  # prefix -> bytes and rows below, boundaries inside
    while open_cells:
        parent_len = len(next(iter(open_cells)))
        scope = keys if not parent_len else keys.where(F.substring("key", 1, parent_len).isin(list(open_cells)))
        found = scope.groupBy(F.substring("key", 1, depth).alias("cell")).agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        by_parent: dict[str, list] = {}
        for r in found.collect():
            by_parent.setdefault(r["cell"][:parent_len], []).append(r)
        rounds += 1
        if total is None:
            total = sum(r["bytes"] for r in by_parent[""])
        next_cells: dict[str, tuple[int, int, list[int]]] = {}
        next_depth = WIDTH
        for parent, (bytes_below, rows_below, wanted) in open_cells.items():
            cells = sorted(by_parent[parent], key=lambda r: r["cell"])
            bytes_at = list(accumulate((r["bytes"] for r in cells), initial=bytes_below))
            rows_at = list(accumulate((r["rows"] for r in cells), initial=rows_below))
            for i in wanted:
                target = total * i / n_shards
                at = min(max(bisect_right(bytes_at, target) - 1, 0), len(cells) - 1)
                below, above, cell = bytes_at[at], bytes_at[at + 1], cells[at]
                if min(target - below, above - target) <= tolerance * total / n_shards or cell["rows"] == 1:
                    done[i] = rows_at[at + (above - target < target - below)]
                elif cell["low"] == cell["high"]:  # copies of one row, all of one size
                    done[i] = rows_at[at] + round((target - below) * cell["rows"] / cell["bytes"])
                else:
                    next_cells.setdefault(cell["cell"], (below, rows_at[at], []))[2].append(i)
                    next_depth = min(next_depth, _shared_digits(cell["low"], cell["high"]) + MORE_DIGITS)
        open_cells, depth = next_cells, min(max(next_depth, depth + 1), WIDTH)
    return [done[i] for i in sorted(done)], rounds


def _cells(keyed: DataFrame, first: int, deeper: list[DataFrame]) -> DataFrame:
    """``keyed`` plus ``cell``: the first digits of the key, as many as its last entry in the tables (cell, digits) says.

    A table has a row for each cell above a task's share, so at most ``MAX_TASKS`` of them, and is broadcast.
    """
    out = keyed.withColumn("cell", F.substring("key", 1, first))
    for table in deeper:
        more = F.coalesce(F.expr("substring(key, 1, digits)"), F.col("cell"))
        out = out.join(F.broadcast(table), "cell", "left").withColumn("cell", more).drop("digits")
    return out


def histogram_shards(
    docs: DataFrame, n_shards: int = 16, text_col: str = "text", tolerance: float = 1e-4, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """All columns of ``docs`` plus ``size``, ``shard`` and ``slot`` (gapless from 0 in each shard, in key order).

    ``tolerance`` is the share of a shard's bytes by which a boundary may miss; ``task_bytes`` is what a task sorts.  Equal
    texts have adjacent keys; a group larger than its share of the bytes runs across a boundary, and through several tasks.

    Null texts count as empty (size 1).  Rows that agree in every column are interchangeable; very many of them are counted
    and made again, so they need no task of their own.  A very long text is a row like others, and a boundary misses by half of it
    at most.  Input columns named size, shard or slot (in any case) are replaced, also where one of them holds the text.
    An empty table gives no rows.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    names = without(docs, "size", "shard", "slot").columns
    numbered = [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)]
    keyed = docs.select(*numbered, byte_size(F.col(quoted(text_col))).alias("size"), sort_key(docs, text_col).alias("key"))
    keys = written(keyed.select("key", "size"), "shard-keys")
    total, n_rows = keys.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not n_rows:
        return docs.select(*[F.col(quoted(c)) for c in names], F.lit(0).cast("long").alias("size"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).limit(0)
    boundaries, _ = find_boundaries(keys, n_shards, tolerance)

    # Cells of a task's share at most; what is too large is cut again, but for rows that are all alike.
    n_tasks = min(max(-(-total // task_bytes), TASKS_PER_SHARD * n_shards), MAX_TASKS)
    share = total / n_tasks
    first, deeper = max(1, ceil(log(n_tasks, 16))), []
    while True:
        sums = [F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")]
        cells = written(_cells(keys, first, deeper).groupBy("cell").agg(*sums), "shard-cells")
        large = cells.where((F.col("bytes") > share) & (F.col("rows") > 1) & (F.length("cell") < WIDTH))
        alike = F.size(F.filter(F.sequence(F.lit(1), F.lit(WIDTH)), lambda i: F.substr("low", F.lit(1), i) == F.substr("high", F.lit(1), i)))
        digits = F.least(F.lit(WIDTH), alike + F.ceil(F.log(16.0, 4 * F.col("bytes") / share)).cast("int"))
        large = large.select("cell", digits.alias("digits"))
        if large.isEmpty():
            break
        deeper.append(large)
    solid = (F.col("bytes") > share) & (F.col("rows") > 1) & (F.length("cell") == WIDTH)
    cells = cells.select("cell", "rows", solid.alias("solid"))

    # The first rank of each cell: sums of the groups by first digits on the driver, sums inside a group by a window.
    group = F.substring("cell", 1, min(first, FIRST_DIGITS))
    sums = sorted((r["g"], r["n"]) for r in cells.groupBy(group.alias("g")).agg(F.sum("rows").alias("n")).collect())
    spark = docs.sparkSession
    bases = spark.createDataFrame(list(zip((g for g, _ in sums), accumulate((n for _, n in sums), initial=0))), "g string, base long")
    upto = Window.partitionBy("g").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.withColumn("g", group).join(F.broadcast(bases), "g").withColumn("start", F.col("base") + F.coalesce(F.sum("rows").over(upto), F.lit(0)))
    starts = written(starts.select("cell", "start", "rows", "solid"), "shard-starts")

    # Cells of the usual length go to tasks in key order, which their hashes fill evenly; longer ones, parts of a large group, to any.
    in_order = F.floor(F.conv("cell", 16, 10).cast("double") * n_tasks / 16**first)
    task = F.when(F.length("cell") == first, in_order).otherwise(F.pmod(F.xxhash64("cell"), F.lit(n_tasks))).cast("int")
    rows = _cells(keyed, first, deeper).select("cell", "key", F.struct(*[f"c{i}" for i in range(len(names))]).alias("row"), "size", F.lit(None).cast("long").alias("start"))
    copies = starts.where("solid").select("cell", "start").collect() if deeper else []  # each has more than a task's share
    if copies:
        several = rows.where(F.col("cell").isin([c["cell"] for c in copies]))
        rows = rows.where(~F.col("cell").isin([c["cell"] for c in copies]))
    markers = starts.where("not solid").select("cell", F.lit("").alias("key"), F.lit(None).cast(rows.schema["row"].dataType).alias("row"), F.lit(None).cast("long").alias("size"), "start")
    sent = rows.unionByName(markers).withColumn("task", task).repartitionById(n_tasks, F.col("task"))
    in_cell = Window.partitionBy("task", "cell").orderBy("key")
    ranked = sent.withColumn("rank", F.first("start").over(in_cell) + F.row_number().over(in_cell) - 2).where("start is null").select("row", "size", "rank")
    if copies:
        counted = several.groupBy("cell").agg(F.first("row").alias("row"), F.first("size").alias("size"), F.count(F.lit(1)).alias("n"))
        counted = counted.join(F.broadcast(spark.createDataFrame([(c["cell"], c["start"]) for c in copies], "cell string, first long")), "cell")
        blocks = counted.select("row", "size", "first", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))).alias("block")).repartition(n_tasks)
        each = F.explode(F.sequence(F.col("block"), F.least(F.col("block") + COPIES, F.col("n")) - 1))
        ranked = ranked.unionByName(blocks.select("row", "size", "first", each.alias("i")).select("row", "size", (F.col("first") + F.col("i")).alias("rank")))
    shard = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in boundaries]), lambda b: b <= F.col("rank"))) if boundaries else F.lit(0)
    begins = F.array(*[F.lit(b).cast("long") for b in (0, *boundaries)])
    placed = ranked.withColumn("shard", shard)
    return placed.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)], "size", "shard", (F.col("rank") - F.get(begins, F.col("shard"))).alias("slot"))
