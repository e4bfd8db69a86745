"""Options of the three workflows, their presets, and parsing of option texts."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

# Windows, shifts (seconds) and weights of the embedding scales.
DEFAULT_WINDOWS = (3.0, 2.5, 2.0, 1.5, 1.0, 0.5)
DEFAULT_SHIFTS = (1.5, 1.25, 1.0, 0.75, 0.5, 0.25)
FRAME_HOP = 0.01
SAMPLE_RATE = 16_000


def scale_lists(windows, shifts, weights) -> tuple[tuple[float, ...], tuple[float, ...], tuple[float, ...]]:
    """One shift stands for all windows; other wrong numbers of shifts are an error, of weights give ones."""
    windows, shifts, weights = tuple(windows), tuple(shifts), tuple(weights)
    if not windows or min(windows) <= 0:
        raise ValueError("windows must be positive")
    if len(shifts) == 1:
        shifts *= len(windows)
    if len(shifts) != len(windows):
        raise ValueError("there must be one shift, or one for each window")
    if min(shifts) <= 0:
        raise ValueError("shifts must be positive")
    return windows, shifts, weights if len(weights) == len(windows) else (1.0,) * len(windows)


# The defaults of the options of the three workflows, and the presets below.

@dataclass(frozen=True)
class DiarizeOptions:
    onset: float = 0.9
    offset: float = 0.5
    min_silence: float = 0.6
    min_speech: float = 0.0
    pad_onset: float = 0.0
    pad_offset: float = 0.0
    smoothing: str = "none"
    overlap: float = 0.5
    vad_window: float = 0.63
    vad_shift: float = 0.01
    windows: tuple[float, ...] = DEFAULT_WINDOWS
    shifts: tuple[float, ...] = DEFAULT_SHIFTS
    weights: tuple[float, ...] = field(default=(1.0,) * 6)
    subseg_win: float = 1.5
    subseg_shift: float = 0.75
    merge_gap: float = 0.0
    min_seg: float = 0.0
    clustering: str = "agglomerative"
    threshold: float = 0.3
    max_speakers: int = 8

    def __post_init__(self):
        if self.smoothing not in ("none", "mean", "median"):
            raise ValueError("smoothing must be none, mean or median")
        if self.clustering not in ("agglomerative", "spectral"):
            raise ValueError("clustering must be agglomerative or spectral")
        if self.subseg_shift <= 0:
            raise ValueError("subseg_shift must be positive")
        windows, shifts, weights = scale_lists(self.windows, self.shifts, self.weights)
        object.__setattr__(self, "windows", windows)
        object.__setattr__(self, "shifts", shifts)
        object.__setattr__(self, "weights", weights)


@dataclass(frozen=True)
class ExtractOptions:
    sheet: str | None = None
    quality_threshold: float = 0.7
    keep_all: bool = False
    min_block_rows: int = 200
    id_format: str = "participant_%02d"


@dataclass(frozen=True)
class AlignOptions:
    min_seg: float = 0.6
    av_offset: float = 0.0
    smooth_ms: float = 240.0
    margin_ratio: float = 1.08
    best_min: float = 0.06
    stick_ratio: float = 0.92
    use_global_map: bool = True
    amb_global_max_sec: float = -1.0
    amb_global_max_ratio: float = 0.05
    amb_local_margin: float = 1.01
    softmax_temp: float = 0.08
    merge_gap: float = 0.0
    max_participants: int = 0
    min_spd_mean: float = 0.0


#: What the command line uses where a flag is not given.
CLI_ALIGN = replace(AlignOptions(), min_seg=0.4, margin_ratio=1.12, use_global_map=False)

PRESETS = {
    "batch": DiarizeOptions(onset=0.8, offset=0.4, min_silence=0.3, clustering="spectral", merge_gap=0.25, min_seg=1.0, subseg_win=2.0, subseg_shift=1.0),
    "subset": DiarizeOptions(onset=0.95, offset=0.75, min_silence=0.6, min_speech=0.2, merge_gap=0.25, min_seg=1.0, subseg_win=4.0, subseg_shift=4.0),
    "subset_bp": DiarizeOptions(onset=0.95, offset=0.8, min_silence=0.6, min_speech=0.2, merge_gap=0.6, min_seg=1.0, subseg_win=6.0, subseg_shift=6.0),
}


def parse_float(text: str | None, fallback: float) -> float:
    """A number with a decimal point, else the fallback."""
    try:
        return float(text)
    except (TypeError, ValueError):
        return fallback


def parse_floats(text: str | None, fallback: tuple[float, ...]) -> tuple[float, ...]:
    """Numbers between semicolons or, without any, commas, and blanks; others are dropped, none at all is the fallback."""
    parts = re.split(r"[;\s]+" if ";" in (text or "") else r"[,\s]+", text or "")
    numbers = []
    for part in parts:
        try:
            numbers.append(float(part))
        except ValueError:
            pass
    return tuple(numbers) or fallback
