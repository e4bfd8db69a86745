"""Diarization: recordings to segments of who spoke when.

Decoding, features and speech scores share one task per recording; segments are relational; embeddings are computed where the
audio is read, and clusters per recording, in parallel over recordings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FRAME_HOP, DiarizeOptions
from ..functions.scalars import speaker_label
from ..operators.clustering import cluster_labels
from ..operators.ordered import hysteresis_segments, merge_adjacent, subsegments
from ..schemas import EMBEDDING, VAD_PROB
from ..shipping import ship
from ..sources.audio import decode_wav, log_mel
from ..sources.models import Embedder, EnergyVad, PooledEmbedder, VadScorer, embed_scales, sliding_speech
from ..staging import staged

KEY = ["recording_id"]
#: Sub-segments up to this many (24 bytes each) are broadcast to the recordings; more are joined by a shuffle.
BROADCAST_SPANS = 1_000_000


def speech_probabilities(recordings: DataFrame, scorer: VadScorer | None = None, options: DiarizeOptions = DiarizeOptions()) -> DataFrame:
    """(recording_id, frame_idx, p) of recordings (recording_id, content)."""
    ship(recordings.sparkSession)
    scorer = scorer or EnergyVad()
    window, shift = round(options.vad_window / FRAME_HOP), max(1, round(options.vad_shift / FRAME_HOP))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["recording_id"], pdf["content"]):
                p = sliding_speech(log_mel(decode_wav(content)), scorer, window, shift, options.smoothing, options.overlap)
                yield pd.DataFrame({"recording_id": name, "frame_idx": np.arange(len(p)), "p": p.astype(float)})

    return recordings.select("recording_id", "content").mapInPandas(work, VAD_PROB)


def embeddings(recordings: DataFrame, subs: DataFrame, embedder: Embedder | None = None, options: DiarizeOptions = DiarizeOptions()) -> DataFrame:
    """(recording_id, sub_idx, vec); sub-segments without frames have none."""
    ship(recordings.sparkSession)
    embedder = embedder or PooledEmbedder()
    frames = lambda seconds: tuple(max(1, round(s / FRAME_HOP)) for s in seconds)
    windows, shifts, weights = frames(options.windows), frames(options.shifts), options.weights

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content, parts in zip(pdf["recording_id"], pdf["content"], pdf["parts"]):
                mel = log_mel(decode_wav(content), normalise=True)
                rows = []
                for part in parts:
                    first, last = max(0, int(np.floor(part["start"] / FRAME_HOP))), min(len(mel), int(np.ceil(part["end"] / FRAME_HOP)))
                    if last > first:
                        rows.append((name, part["sub_idx"], embed_scales(mel[first:last], embedder, windows, shifts, weights).astype(float)))
                yield pd.DataFrame(rows, columns=["recording_id", "sub_idx", "vec"])

    # The spans go to the audio, which is never shuffled while they fit a broadcast.
    spans = staged(subs.groupBy("recording_id").agg(F.array_sort(F.collect_list(F.struct("sub_idx", "start", "end"))).alias("parts")))
    if (spans.agg(F.sum(F.size("parts"))).first()[0] or 0) <= BROADCAST_SPANS:
        spans = F.broadcast(spans)
    return recordings.select("recording_id", "content").join(spans, "recording_id").mapInPandas(work, EMBEDDING)


def diarize(recordings: DataFrame, scorer: VadScorer | None = None, embedder: Embedder | None = None, options: DiarizeOptions = DiarizeOptions(), probs: DataFrame | None = None) -> DataFrame:
    """(recording_id, seg_idx, start, end, speaker) of recordings (recording_id, content); ``probs`` if they are known."""
    probs = speech_probabilities(recordings, scorer, options) if probs is None else probs
    spoken = hysteresis_segments(
        probs, KEY, FRAME_HOP, options.onset, options.offset, options.pad_onset, options.pad_offset, options.min_speech, options.min_silence
    )
    subs = staged(subsegments(spoken, KEY, options.subseg_win, options.subseg_shift))
    vectors = embeddings(recordings, subs, embedder, options)
    labels = cluster_labels(vectors, "recording_id", "sub_idx", "vec", options.clustering, options.threshold, options.max_speakers)
    return label_segments(subs, labels, options)


def label_segments(subs: DataFrame, labels: DataFrame, options: DiarizeOptions = DiarizeOptions()) -> DataFrame:
    """Sub-segments with their labels, merged and held to the least duration."""
    named = subs.join(labels, [*KEY, "sub_idx"]).select(*KEY, F.col("sub_idx").alias("seg_idx"), "start", "end", speaker_label(F.col("label")).alias("speaker"))
    merged = merge_adjacent(named, KEY, "speaker", options.merge_gap).select(*KEY, "seg_idx", "start", "end", "speaker")
    return merged.where(F.col("end") - F.col("start") >= options.min_seg) if options.min_seg > 0 else merged


def diagnostics(probs: DataFrame, segments: DataFrame) -> DataFrame:
    """Per recording: frames, least, greatest and mean probability, segments, and the last end."""
    scores = probs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_frames"), F.min("p").alias("p_min"), F.max("p").alias("p_max"), F.avg("p").alias("p_mean"))
    ends = segments.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_segments"), F.max("end").alias("last_end"))
    return scores.join(ends, KEY, "left").na.fill(0, ["n_segments"]).na.fill(0.0, ["last_end"])
