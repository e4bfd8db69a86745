"""Alignment: which participant's mouth moves while a speaker speaks.

All tables are keyed by recording, so any number of recordings run in one plan; the only heavy exchange is the band join
of samples and segments.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import AlignOptions
from ..functions.scalars import adaptive_limit, clamp_between, clamp_to, combined_score
from ..functions.stats import nearest_rank, upper_median
from ..operators import scoring
from ..operators.intervals import interval_profile, samples_in_intervals
from ..operators.ordered import absolute_speed, merge_adjacent, moving_average
from ..staging import staged

KEY = ["recording_id"]
#: Seconds of a bucket of the band join.
BUCKET = 5.0


@dataclass
class Alignment:
    participants: DataFrame
    segment_scores: DataFrame
    score_matrix: DataFrame
    global_map: DataFrame
    assigned: DataFrame
    aligned: DataFrame


def mouth_activity(samples: DataFrame, smooth_ms: float) -> tuple[DataFrame, DataFrame]:
    """Samples (recording_id, participant, i, t, mouth, mouth_open) plus spd, the normalised mouth speed; and a row per participant."""
    by = [*KEY, "participant"]
    order = Window.partitionBy(*by).orderBy("i")
    stepped = samples.withColumn("__dt", (F.col("t") - F.lag("t").over(order)).cast("float"))
    clock = stepped.groupBy(*by).agg(upper_median(F.col("__dt"), 0.04).alias("dt"), F.avg("mouth").alias("mean_raw"))
    clock = clock.withColumn("dt", F.when(F.col("dt") > 0, F.col("dt")).otherwise(F.lit(0.04)))
    clock = clock.withColumn("window", F.greatest(F.lit(1), F.rint(F.lit(smooth_ms / 1000.0) / F.col("dt")).cast("int")))
    rows = stepped.drop("__dt").join(clock, by).withColumn("half", F.when(F.col("window") <= 1, F.lit(0)).otherwise(F.floor(F.col("window") / 2).cast("int")))
    smooth = staged(moving_average(rows, by, "mouth", "i", "half", "smooth"))
    ranks = smooth.groupBy(*by).agg(nearest_rank(F.col("smooth"), 10).alias("p10"), nearest_rank(F.col("smooth"), 90).alias("p90"))
    scaled = smooth.join(ranks, by).withColumn("norm", clamp_between(F.col("smooth"), F.col("p10"), F.col("p90")))
    speeds = staged(absolute_speed(scaled, by, "norm", "i", F.col("dt"), "speed"))
    tops = speeds.groupBy(*by).agg(nearest_rank(F.col("speed"), 95).alias("spd_p95"))
    done = speeds.join(tops, by).withColumn("spd", clamp_to(F.col("speed"), F.col("spd_p95")))
    summary = done.groupBy(*by).agg(
        *[F.first(c).alias(c) for c in ("dt", "window", "p10", "p90", "mean_raw")],
        F.avg("smooth").alias("mean_smooth"), F.avg("norm").alias("mean_norm"), F.first("spd_p95").alias("spd_p95"), F.avg("spd").alias("spd_mean"),
    )
    return done.select(*by, "i", "t", "mouth_open", "spd"), summary


def segment_scores(segments: DataFrame, activity: DataFrame, kept: DataFrame) -> DataFrame:
    """The combined score of every kept participant in every segment (recording_id, seg_idx, start, end, dur, speaker)."""
    everyone = segments.join(kept, KEY)
    by = [*KEY, "seg_idx", "participant"]
    pairs = samples_in_intervals(segments, activity.join(kept, [*KEY, "participant"], "left_semi"), KEY, BUCKET)
    profile = interval_profile(pairs, by, "spd", "mouth_open", ["i"], "dur")
    joined = everyone.join(profile, by, "left").na.fill(0.0, ["spd_mean", "spd_std", "open_mean", "rate"])
    return joined.withColumn("combined", combined_score(F.col("spd_mean"), F.col("spd_std"), F.col("open_mean"), F.col("rate")))


def align(segments: DataFrame, samples: DataFrame, options: AlignOptions = AlignOptions()) -> Alignment:
    """Segments (recording_id, seg_idx, start, end, speaker) and samples (recording_id, participant, i, t, mouth, mouth_open)."""
    activity, summary = mouth_activity(samples, options.smooth_ms)
    summary = staged(summary)
    kept = staged(scoring.active_participants(summary, KEY, options.min_spd_mean, options.max_participants))
    flagged = summary.join(kept.select(*KEY, "participant", F.lit(True).alias("kept")), [*KEY, "participant"], "left").withColumn("kept", F.coalesce("kept", F.lit(False)))

    covered = segments.groupBy(*KEY).agg(adaptive_limit(options.amb_global_max_sec, options.amb_global_max_ratio, F.min("start"), F.max("end")).alias("amb_limit"))
    shifted = segments.withColumns({"start": F.col("start") + F.lit(options.av_offset), "end": F.col("end") + F.lit(options.av_offset)})
    timed = shifted.withColumn("dur", F.col("end") - F.col("start")).where(F.col("dur") >= options.min_seg)
    scores = staged(segment_scores(timed, activity, kept))

    by = [*KEY, "seg_idx"]
    top = scoring.top_three(scores, by, "participant", "pid_ord", "combined")
    # A recording without participants has no scores: its segments are ambiguous, with a reason.
    ambiguous = F.coalesce(scoring.is_ambiguous(F.col("best_val"), F.col("top2_val"), options.best_min, options.margin_ratio), F.lit(True))
    every = timed.join(top, by, "left").withColumns({"ambiguous": ambiguous, "reason": F.when(F.col("best_pid").isNull(), F.lit("missing_debug_row"))})
    debug = every.where("best_pid is not null").drop("reason")
    probs = scoring.softmax(scores, by, "combined", options.softmax_temp)
    # Speakers whose segments are all too short still have a row of zeros.
    pairs = segments.select(*KEY, "speaker").distinct().join(kept, KEY)
    matrix = staged(scoring.log_scores(probs, pairs, KEY))
    mapped = scoring.global_map(matrix, KEY)

    ready = every.join(mapped, [*KEY, "speaker"], "left").join(covered, KEY).withColumn("choice", scoring.first_choice(options.use_global_map, options.amb_local_margin))
    assigned = scoring.sticky_assign(staged(ready), KEY, options.stick_ratio)
    first = lambda c: F.min_by(c, F.struct("start", "seg_idx"))
    extra = {"ambiguous": F.bool_or("ambiguous")} | {c: first(c) for c in ("speaker", "reason", "best_pid", "best_val", "top2_pid", "top2_val", "global_pid")}
    aligned = merge_adjacent(assigned, KEY, "participant", options.merge_gap, extra=extra)
    return Alignment(flagged, debug, matrix, mapped, assigned, aligned)
