"""Operators over ordered rows: hysteresis, merging, splitting, windows and smoothing.

Every function takes and returns DataFrames keyed by ``keys``; there is no window over a whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-6


def hysteresis_segments(
    probs: DataFrame, keys: list[str], hop: float = 0.01, onset: float = 0.9, offset: float = 0.5,
    pad_onset: float = 0.0, pad_offset: float = 0.0, min_speech: float = 0.0, min_silence: float = 0.6,
) -> DataFrame:
    """Speech intervals (keys, seg_idx, start, end) of a series (keys, frame_idx, p).

    An interval opens at ``onset``, goes on while ``p >= offset``, and closes after ``min_silence`` below.  Where onset is at
    least offset, intervals are islands of frames above offset; else whether a frame counts depends on the state, and each
    series is folded.
    """
    bounds = _islands(probs, keys, hop, onset, offset, min_silence) if onset >= offset else _folded(probs, keys, hop, onset, offset, min_silence)
    start = F.greatest(F.col("first") * F.lit(hop) - F.lit(pad_onset), F.lit(0.0))
    timed = bounds.select(*keys, "first", start.alias("start"), ((F.col("last") + 1) * F.lit(hop) + F.lit(pad_offset)).alias("end"))
    kept = timed.where(F.col("end") - F.col("start") >= min_speech)
    order = Window.partitionBy(*keys).orderBy("first")
    return kept.select(*keys, (F.row_number().over(order) - 1).cast("long").alias("seg_idx"), "start", "end")


def _islands(probs: DataFrame, keys: list[str], hop: float, onset: float, offset: float, min_silence: float) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy("frame_idx")
    quiet = F.col("frame_idx") - 1 - F.lag("frame_idx").over(order)
    above = probs.where(F.col("p") >= offset)
    opened = above.withColumn("__new", F.coalesce((quiet >= 1) & (quiet * F.lit(hop) >= min_silence), F.lit(True)).cast("int"))
    numbered = opened.withColumn("__island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.min(F.when(F.col("p") >= onset, F.col("frame_idx")))
    return numbered.groupBy(*keys, "__island").agg(first.alias("first"), F.max("frame_idx").alias("last")).where("first is not null").drop("__island")


def _folded(probs: DataFrame, keys: list[str], hop: float, onset: float, offset: float, min_silence: float) -> DataFrame:
    span = "struct<first:bigint,last:bigint>"
    none = F.lit(None).cast("long")

    def state(first: Column, last: Column, done: Column) -> Column:
        return F.struct(first.alias("first"), last.alias("last"), done.alias("done"))

    def step(acc: Column, frame: Column) -> Column:
        i, p = frame["i"], frame["p"]
        closed = F.concat(acc["done"], F.array(F.struct(acc["first"].alias("first"), acc["last"].alias("last"))))
        return (
            F.when(acc["first"].isNull(), F.when(p >= onset, state(i, i, acc["done"])).otherwise(state(none, none, acc["done"])))
            .when(p >= offset, state(acc["first"], i, acc["done"]))
            .when((i - acc["last"]) * F.lit(hop) >= min_silence, state(none, none, closed))
            .otherwise(state(acc["first"], acc["last"], acc["done"]))
        )

    series = F.array_sort(F.collect_list(F.struct(F.col("frame_idx").cast("long").alias("i"), F.col("p").cast("double").alias("p"))))
    gathered = probs.groupBy(*keys).agg(series.alias("__series"))
    end = lambda acc: F.when(acc["first"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(F.struct(acc["first"].alias("first"), acc["last"].alias("last")))))
    folded = F.aggregate("__series", state(none, none, F.array().cast(f"array<{span}>")), step, end)
    return gathered.select(*keys, F.explode(folded).alias("__span")).select(*keys, "__span.first", "__span.last")


def merge_adjacent(segments: DataFrame, keys: list[str], label: str, gap: float = 0.0, order: str = "seg_idx", extra: dict[str, Column] | None = None) -> DataFrame:
    """Runs of equal labels in order of start are one interval while each begins within ``gap`` of the furthest end so far.

    Null and blank labels never merge.  ``extra`` names further aggregates of the merged rows.
    """
    by_start = Window.partitionBy(*keys).orderBy("start", order)
    before = F.lag(label).over(by_start)
    same = F.coalesce((F.col(label) == before) & (F.trim(F.col(label)) != ""), F.lit(False))
    runs = segments.withColumn("__turn", (~same).cast("int"))
    runs = runs.withColumn("__run", F.sum("__turn").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    in_run = Window.partitionBy(*keys, "__run").orderBy("start", order)
    reach = F.max("end").over(in_run.rowsBetween(Window.unboundedPreceding, -1))
    apart = runs.withColumn("__new", F.coalesce(F.col("start") > reach + gap + EPS, F.lit(True)).cast("int"))
    islands = apart.withColumn("__island", F.sum("__new").over(in_run.rowsBetween(Window.unboundedPreceding, 0)))
    merged = islands.groupBy(*keys, "__run", "__island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.first(label).alias(label), F.count(F.lit(1)).alias("n_merged"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )
    numbered = Window.partitionBy(*keys).orderBy("__run", "__island")
    return merged.withColumn("seg_idx", (F.row_number().over(numbered) - 1).cast("long")).drop("__run", "__island")


def split_at_resets(rows: DataFrame, keys: list[str], time: str, order: str) -> DataFrame:
    """``rows`` plus ``block`` (from 0), which goes up where time decreases; equal times stay together."""
    window = Window.partitionBy(*keys).orderBy(order)
    reset = F.coalesce((F.col(time) < F.lag(time).over(window)).cast("int"), F.lit(0))
    return rows.withColumn("__reset", reset).withColumn("block", F.sum("__reset").over(window.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("__reset")


def number_blocks(rows: DataFrame, keys: list[str], min_rows: int, id_format: str = "participant_%02d") -> DataFrame:
    """Blocks of at least ``min_rows`` rows, renumbered without gaps from 1 as ``participant``."""
    rows = rows.dropna(subset=keys)
    sized = rows.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys, "block"))).where(F.col("__n") >= min_rows)
    number = F.dense_rank().over(Window.partitionBy(*keys).orderBy("block"))
    return sized.withColumn("participant", F.format_string(id_format, number)).drop("__n")


def subsegments(segments: DataFrame, keys: list[str], win: float, shift: float) -> DataFrame:
    """Windows of ``win`` seconds every ``shift`` seconds of each segment, and one more at its end if that is not covered.

    Segments no longer than a window are kept whole; those without duration are dropped.
    """
    if shift <= 0 or win <= 0:
        raise ValueError("win and shift must be positive")
    length = F.col("end") - F.col("start")
    steps = F.floor((length - win + EPS) / shift).cast("int")
    starts = F.transform(F.sequence(F.lit(0), steps), lambda k: F.col("start") + k * F.lit(shift))
    windows = F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(s + F.lit(win), F.col("end")).alias("end")))
    covered = F.get(windows, F.size(windows) - 1)["end"]
    tail = F.array(F.struct(F.greatest(F.col("start"), F.col("end") - F.lit(win)).alias("start"), F.col("end").alias("end")))
    whole = F.array(F.struct(F.col("start").alias("start"), F.col("end").alias("end")))
    cut = F.when(length <= win, whole).otherwise(F.when(covered < F.col("end") - EPS, F.concat(windows, tail)).otherwise(windows))
    exploded = segments.where(length > 0).select(*keys, "seg_idx", F.posexplode(cut).alias("__pos", "__w"))
    order = Window.partitionBy(*keys).orderBy("seg_idx", "__pos")
    return exploded.select(*keys, "seg_idx", (F.row_number().over(order) - 1).cast("long").alias("sub_idx"), F.col("__w.start").alias("start"), F.col("__w.end").alias("end"))


def moving_average(rows: DataFrame, keys: list[str], value: str, order: str, half: str, name: str) -> DataFrame:
    """Mean over ``half`` rows before and after, cut at the ends; ``half`` is a column, constant in each group, 0 copies.

    ``order`` must count rows without gaps.  A frame cannot be a column, so the order is scaled to make it one.
    """
    by = ", ".join(f"`{k}`" for k in keys)
    mean = F.expr(f"avg(`{value}`) OVER (PARTITION BY {by} ORDER BY `{order}` / CAST(greatest(`{half}`, 1) AS DOUBLE) RANGE BETWEEN 1.000001D PRECEDING AND 1.000001D FOLLOWING)")
    return rows.withColumn(name, F.when(F.col(half) <= 0, F.col(value).cast("double")).otherwise(mean))


def absolute_speed(rows: DataFrame, keys: list[str], value: str, order: str, dt: Column, name: str) -> DataFrame:
    """Absolute change from the row before per ``dt`` (1e-6 at least); the first row has 0."""
    window = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn(name, F.coalesce(F.abs(F.col(value) - F.lag(value).over(window)) / F.greatest(dt, F.lit(1e-6)), F.lit(0.0)))


def overlap_average(windows: DataFrame, keys: list[str], size: int, n_frames: DataFrame) -> DataFrame:
    """Mean over the window scores (keys, win_idx, p) that cover each frame, one row per frame; uncovered: 0.

    ``n_frames`` has keys and n_frames.  Window i covers frames i to i + size - 1.
    """
    spread = windows.select(*keys, F.explode(F.sequence(F.col("win_idx"), F.col("win_idx") + size - 1)).alias("frame_idx"), "p")
    means = spread.groupBy(*keys, "frame_idx").agg(F.avg("p").alias("p"))
    frames = n_frames.where("n_frames > 0").select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_frames").cast("long") - 1)).alias("frame_idx"))
    return frames.join(means, [*keys, "frame_idx"], "left").select(*keys, "frame_idx", F.coalesce("p", F.lit(0.0)).alias("p"))


def jump_of(size: int, overlap: float, shift: int = 1) -> int:
    """Windows to go on by so that windows of ``size`` + 1 frames overlap by the given share."""
    return max(1, round(round((size + 1) * (1 - overlap)) / shift))


def overlap_smooth(windows: DataFrame, keys: list[str], size: int, overlap: float, method: str, n_frames: DataFrame, shift: int = 1) -> DataFrame:
    """Every so many window scores spread over ``size`` + 1 frames; mean or upper median per frame, gaps take the last value."""
    if method not in ("mean", "median"):
        raise ValueError("method must be mean or median")
    chosen = windows.where(F.col("win_idx") % jump_of(size, overlap, shift) == 0)
    spread = chosen.select(*keys, F.explode(F.sequence(F.col("win_idx") * shift, F.col("win_idx") * shift + size)).alias("frame_idx"), "p")
    ordered = F.sort_array(F.collect_list("p"))
    value = F.avg("p") if method == "mean" else F.get(ordered, F.floor(F.size(ordered) / 2).cast("int"))
    values = spread.groupBy(*keys, "frame_idx").agg(value.alias("p"))
    frames = n_frames.where("n_frames > 0").select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_frames").cast("long") - 1)).alias("frame_idx"))
    upto = Window.partitionBy(*keys).orderBy("frame_idx").rowsBetween(Window.unboundedPreceding, 0)
    return frames.join(values, [*keys, "frame_idx"], "left").select(*keys, "frame_idx", F.coalesce(F.last("p", ignorenulls=True).over(upto), F.lit(0.0)).alias("p"))


def scale_windows(subs: DataFrame, keys: list[str], windows: tuple[float, ...], shifts: tuple[float, ...], hop: float = 0.01) -> DataFrame:
    """The embedding windows of each sub-segment (first, n_frames) at every scale, in frames from its first.

    A sub-segment shorter than a window has one padded window; else there are only full windows.
    """
    scales = F.array(*[F.struct(F.lit(i).alias("scale"), F.lit(max(1, round(w / hop))).alias("win"), F.lit(max(1, round(s / hop))).alias("shift")) for i, (w, s) in enumerate(zip(windows, shifts))])
    at = subs.select(*keys, "sub_idx", "first", "n_frames", F.explode(scales).alias("s")).select(*keys, "sub_idx", "first", "n_frames", "s.*")
    last = F.greatest(F.col("n_frames") - F.col("win"), F.lit(0))
    offsets = F.sequence(F.lit(0).cast("long"), last.cast("long"), F.col("shift").cast("long"))
    return at.select(*keys, "sub_idx", "scale", "win", F.explode(offsets).alias("offset"), (F.col("n_frames") < F.col("win")).alias("padded"))
