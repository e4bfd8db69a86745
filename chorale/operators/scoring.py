"""Ranking of participants per segment, softmax scores, the speaker x participant matrix, and the assignment fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block of the assignment fold.
FOLD_BLOCK = 256


def top_three(scores: DataFrame, by: list[str], item: str, ordinal: str, value: str) -> DataFrame:
    """One row per group with the three best items and their values (null where there are fewer); ties by ordinal."""
    ranked = scores.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(value), F.asc(ordinal)))).where(F.col("__rank") <= 3)
    pick = lambda c, n: F.max(F.when(F.col("__rank") == n, F.col(c)))
    return ranked.groupBy(*by).agg(
        pick(item, 1).alias("best_pid"), pick(value, 1).alias("best_val"), pick(item, 2).alias("top2_pid"),
        pick(value, 2).alias("top2_val"), pick(item, 3).alias("top3_pid"), pick(value, 3).alias("top3_val"),
    )


def is_ambiguous(best: Column, second: Column, best_min: float, margin: float) -> Column:
    return (best < best_min) | F.coalesce(best < margin * second, F.lit(False))


def softmax(scores: DataFrame, by: list[str], value: str, temperature: float, name: str = "prob") -> DataFrame:
    whole = Window.partitionBy(*by)
    weighted = scores.withColumn("__e", F.exp((F.col(value) - F.max(value).over(whole)) / max(temperature, 1e-6)))
    return weighted.withColumn(name, F.col("__e") / (F.sum("__e").over(whole) + 1e-12)).drop("__e")


def log_scores(probs: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of duration times ln(probability) for every (speaker, participant) of ``pairs``; absent ones have 0."""
    sums = probs.groupBy(*keys, "speaker", "participant").agg(F.sum(F.col("dur") * F.log(F.col("prob") + 1e-12)).alias("log_score"))
    return pairs.join(sums, [*keys, "speaker", "participant"], "left").withColumn("log_score", F.coalesce("log_score", F.lit(0.0)))


def global_map(scores: DataFrame, keys: list[str]) -> DataFrame:
    """The participant with the highest log score of each speaker; ties go to the lower ordinal ``pid_ord``."""
    best = F.max_by("participant", F.struct(F.col("log_score"), -F.col("pid_ord")))
    return scores.groupBy(*keys, "speaker").agg(best.alias("global_pid"))


def score_matrix(scores: DataFrame, keys: list[str], participants: list[str]) -> DataFrame:
    """Wide form for a sink: one row per speaker, one column per participant."""
    return scores.groupBy(*keys, "speaker").pivot("participant", participants).agg(F.first("log_score"))


def first_choice(use_global_map: bool, local_margin: float, override: float = 1.6) -> Column:
    """The participant before stickiness, from ambiguous, best_*, top2_*, global_pid, dur and amb_limit."""
    if not use_global_map:
        return F.col("best_pid")
    second = F.coalesce("top2_val", F.lit(0.0))
    ratio = F.when(F.col("top2_pid").isNotNull(), F.col("best_val") / (second + 1e-9)).otherwise(F.lit(0.0))
    close = (ratio > 0) & (ratio <= local_margin)
    local = F.col("ambiguous") & (close | (F.col("dur") > F.col("amb_limit")))
    clear = (second > 0) & (F.col("best_val") >= override * second)
    return F.when(local | clear, F.col("best_pid")).otherwise(F.coalesce("global_pid", "best_pid"))


def sticky_assign(rows: DataFrame, keys: list[str], stick_ratio: float) -> DataFrame:
    """Rows (keys, seg_idx, choice, ambiguous, best_*, top2_*) plus ``participant``.

    In order of seg_idx, an ambiguous row keeps the previous participant if that one's value here reaches
    ``stick_ratio`` of the best, and a row without scores keeps it in any case.  The only true fold: one array per recording, folded inside Catalyst.
    """
    second = F.coalesce("top2_val", F.lit(0.0))
    item = F.struct(
        F.col("seg_idx").alias("seg_idx"), F.col("choice").alias("choice"), F.col("ambiguous").alias("amb"), F.col("best_pid").alias("best_pid"),
        F.col("best_val").cast("double").alias("best"), F.when(second > 0, F.col("top2_pid")).alias("second_pid"), second.cast("double").alias("second"),
    )
    gathered = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("__items"))

    def step(acc: Column, x: Column) -> Column:
        held = F.when(acc["prev"] == x["best_pid"], x["best"]).when(acc["prev"] == x["second_pid"], x["second"]).otherwise(F.lit(0.0))
        stays = (x["amb"] & acc["prev"].isNotNull() & (held >= F.lit(stick_ratio) * x["best"])) | x["best_pid"].isNull()
        chosen = F.when(stays, acc["prev"]).otherwise(x["choice"])
        return F.struct(chosen.alias("prev"), F.concat(acc["out"], F.array(F.struct(x["seg_idx"].alias("seg_idx"), chosen.alias("participant")))).alias("out"))

    out_type = f"array<struct<seg_idx:{rows.schema['seg_idx'].dataType.simpleString()},participant:string>>"
    none = F.array().cast(out_type)

    def block_step(acc: Column, block: Column) -> Column:
        # An array that grows is copied each time, so a block's results are one element of the outer array.
        done = F.aggregate(block, F.struct(acc["prev"].alias("prev"), none.alias("out")), step)
        return F.get(F.transform(F.array(done), lambda d: F.struct(d["prev"].alias("prev"), F.concat(acc["out"], F.array(d["out"])).alias("out"))), F.lit(0))

    numbers = F.sequence(F.lit(0), F.floor((F.size("__items") - 1) / FOLD_BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda b: F.slice("__items", b * FOLD_BLOCK + 1, F.lit(FOLD_BLOCK)))
    first = F.struct(F.lit(None).cast("string").alias("prev"), F.array().cast(f"array<{out_type}>").alias("out"))
    chosen = gathered.select(*keys, F.explode(F.flatten(F.aggregate(blocks, first, block_step, lambda acc: acc["out"]))).alias("__c"))
    return rows.join(chosen.select(*keys, "__c.seg_idx", "__c.participant"), [*keys, "seg_idx"])


def active_participants(activity: DataFrame, keys: list[str], min_mean: float = 0.0, max_count: int = 0) -> DataFrame:
    """(keys, participant, pid_ord): all by name, or the most active ones by activity if a limit is set.

    ``activity`` has keys, participant and spd_mean.  A limit that leaves nothing of a recording leaves all of it.
    """
    by_name = F.row_number().over(Window.partitionBy(*keys).orderBy("participant")) - 1
    named = activity.withColumn("pid_ord", by_name)
    if min_mean <= 0 and max_count <= 0:
        return named.select(*keys, "participant", "pid_ord")
    passes = F.col("spd_mean") >= min_mean
    by_activity = Window.partitionBy(*keys).orderBy(F.desc(passes.cast("int")), F.desc("spd_mean"), "participant")
    ranked = named.withColumn("__rank", F.row_number().over(by_activity) - 1).withColumn("__any", F.max(passes.cast("int")).over(Window.partitionBy(*keys)))
    kept = passes if max_count <= 0 else passes & (F.col("__rank") < max_count)
    return ranked.where(kept | (F.col("__any") == 0)).select(*keys, "participant", F.when(F.col("__any") == 1, F.col("__rank")).otherwise(F.col("pid_ord")).alias("pid_ord"))
