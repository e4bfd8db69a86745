"""Streaming form of hysteresis segmentation: an extension, with event-time state per recording.

Frames arrive in order of frame_idx within a recording.  The state of a recording is one small record; a segment is
emitted when it closes; with ``idle_ms``, an open one also when its recording has been idle for so long.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..shipping import ship

OUTPUT = "recording_id string, start double, end double"
STATE = "first long, last long"


def hysteresis_stream(
    frames: DataFrame, hop: float = 0.01, onset: float = 0.9, offset: float = 0.5, min_speech: float = 0.0, min_silence: float = 0.6, idle_ms: int | None = None
) -> DataFrame:
    """Segments of a stream (recording_id string, frame_idx long, p double), in append mode."""

    ship(frames.sparkSession)

    def timed(key: str, first: int, last: int) -> list[tuple]:
        return [(key, first * hop, (last + 1) * hop)] if (last + 1 - first) * hop >= min_speech else []

    def work(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last = state.get if state.exists else (-1, -1)
        out: list[tuple] = []
        if state.hasTimedOut:
            if first >= 0:
                out = timed(key[0], first, last)
            state.remove()
        else:
            rows = pd.concat(list(batches)).sort_values("frame_idx")
            for i, p in zip(rows["frame_idx"].tolist(), rows["p"].tolist()):
                if first < 0:
                    if p >= onset:
                        first = last = i
                elif p >= offset:
                    last = i
                elif (i - last) * hop >= min_silence:
                    out += timed(key[0], first, last)
                    first = last = -1
            state.update((first, last))
            if idle_ms is not None:
                state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame(out, columns=["recording_id", "start", "end"])

    return frames.groupBy("recording_id").applyInPandasWithState(work, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout)
