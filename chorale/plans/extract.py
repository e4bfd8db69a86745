"""Face tables: from spreadsheet rows to one block of samples per participant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ExtractOptions
from ..functions.scalars import FACE_COLUMNS, clock_seconds, lenient_float, mouth_flag, mouth_score, resolved_column
from ..operators.ordered import number_blocks, split_at_resets
from ..sources.tables import read_workbook


def face_frames(rows: DataFrame) -> DataFrame:
    """Workbook rows (recording_id, row_idx, cells) as typed frames; rows without a time are dropped.

    Each row's headers say which column is meant, so workbooks with different headers can be read together.
    """
    headers = F.map_keys("cells")
    cell = {k: F.coalesce(F.try_element_at("cells", resolved_column(headers, names)), F.lit("")) for k, names in FACE_COLUMNS.items()}
    units = {k: lenient_float(cell[k]).alias(k) for k in ("au10", "au12", "au25", "au26")}
    typed = rows.where(F.trim(cell["time"]) != "").select(
        "recording_id", "row_idx", clock_seconds(cell["time"]).alias("time_sec"), lenient_float(cell["quality"]).alias("quality"),
        mouth_flag(cell["mouth"]).alias("mouth_open"), *units.values(),
    )
    return typed.withColumn("mouth_score_raw", mouth_score(**{k: F.col(k) for k in units}).cast("float"))


def participant_blocks(frames: DataFrame, options: ExtractOptions = ExtractOptions()) -> DataFrame:
    """Frames of sufficient quality, split where time goes back, in blocks of enough rows; numbered as participants."""
    kept = frames if options.keep_all else frames.where(F.col("quality") >= options.quality_threshold)
    blocks = split_at_resets(kept, ["recording_id"], "time_sec", "row_idx")
    return number_blocks(blocks, ["recording_id"], options.min_block_rows, options.id_format).drop("block")


def participants_summary(blocks: DataFrame, keys: list[str] = ["recording_id"]) -> DataFrame:  # noqa: B006
    return blocks.groupBy(*keys, F.col("participant").alias("participant_block")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("time_sec").alias("t_min"), F.max("time_sec").alias("t_max"), F.avg("quality").alias("mean_quality")
    )


def extract(spark: SparkSession, path: str, options: ExtractOptions = ExtractOptions()) -> tuple[DataFrame, DataFrame]:
    """Participant blocks and their summary of the workbooks at a path."""
    blocks = participant_blocks(face_frames(read_workbook(spark, path, options.sheet)), options)
    return blocks, participants_summary(blocks)
