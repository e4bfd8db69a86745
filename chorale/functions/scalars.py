"""Scalar expressions: parsing, scores, clamps and vectors, all as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted headers of the face table, in order of priority.
FACE_COLUMNS = {
    "time": ("Video Time", "Time"),
    "quality": ("Quality",),
    "mouth": ("Mouth",),
    "au10": ("Action Unit 10 - Upper Lip Raiser", "Action Unit 10", "AU10", "Upper Lip Raiser"),
    "au12": ("Action Unit 12 - Lip Corner Puller", "Action Unit 12", "AU12", "Lip Corner Puller"),
    "au25": ("Action Unit 25 - Lips Part", "Action Unit 25", "AU25", "Lips Part"),
    "au26": ("Action Unit 26 - Jaw Drop", "Action Unit 26", "AU26", "Jaw Drop"),
}
# Weights of the action units in the mouth score.
MOUTH_WEIGHTS = {"au25": 0.45, "au26": 0.35, "au10": 0.15, "au12": 0.05}


def resolved_column(headers: Column, candidates: Sequence[str]) -> Column:
    """The header (of an array of them) that a candidate names: first by trimmed name, then ignoring case; else an error."""
    pick = lambda name, fit: F.get(F.filter(headers, lambda h: fit(h) == name), F.lit(0))
    exact = [pick(name, F.trim) for name in candidates]
    loose = [pick(name.lower(), F.lower) for name in candidates]
    return F.coalesce(*exact, *loose, F.raise_error(F.lit(f"no column called {' or '.join(candidates)}")).cast("string"))


def lenient_float(text: Column) -> Column:
    """A float, or 0 where the text is none (also NaN and infinity: they are not numbers in the input formats)."""
    value = F.trim(text).try_cast("float")
    return F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), F.lit(0.0)).otherwise(value).cast("float")


def clock_seconds(text: Column) -> Column:
    """``H:M:S.fff`` in seconds (float); what follows the point is a whole number of milliseconds, however many digits it has."""
    pattern = r"^\s*([0-9]+):([0-9]+):([0-9]+)[.]([0-9]+)\s*$"
    part = lambda n: F.regexp_extract(text, pattern, n).cast("double")
    seconds = part(1) * 3600.0 + part(2) * 60.0 + part(3) + part(4) / 1000.0
    return F.when(text.rlike(pattern), seconds).otherwise(F.raise_error(F.concat(F.lit("no time of the form H:M:S.fff: "), text))).cast("float")


def mouth_flag(text: Column) -> Column:
    return F.when(F.lower(F.trim(text)) == "open", F.lit(1)).otherwise(F.lit(0))


def mouth_score(**units: Column) -> Column:
    return sum((F.lit(w) * units[name].cast("double") for name, w in MOUTH_WEIGHTS.items()), F.lit(0.0))


def clamp01(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def clamp_between(value: Column, low: Column, high: Column) -> Column:
    """0 at ``low`` and 1 at ``high``; a range of at most 1e-6 counts as 1."""
    span = high - low
    return clamp01((value - low) / F.when(span > 1e-6, span).otherwise(F.lit(1.0)))


def clamp_to(value: Column, top: Column) -> Column:
    return clamp01(value / (top + 1e-6))


def combined_score(mean: Column, std: Column, open_mean: Column, rate: Column) -> Column:
    return (mean + 0.5 * std) * (0.85 + 0.15 * open_mean) + 0.02 * F.least(rate, F.lit(2.0))


def frame_range(start: Column, end: Column, n_frames: Column, hop: float) -> tuple[Column, Column]:
    """First frame and end frame of an interval, clamped to the recording."""
    return F.greatest(F.floor(start / hop), F.lit(0)), F.least(F.ceil(end / hop), n_frames)


def speech_probability(silence_logit: Column, speech_logit: Column) -> Column:
    """Softmax of two logits, second class."""
    return 1.0 / (1.0 + F.exp(silence_logit - speech_logit))


def speaker_label(label: Column) -> Column:
    return F.concat(F.lit("speaker_"), label.cast("string"))


def dot(a: Column, b: Column, size: int | None = None) -> Column:
    """The inner product; of arrays of a known size as a compiled sum, of others by a fold."""
    if size is not None:
        return sum((F.get(a, i).cast("double") * F.get(b, i).cast("double") for i in map(F.lit, range(size))), F.lit(0.0))
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def unit_vector(v: Column, eps: float = 1e-10) -> Column:
    """The vector over its length plus ``eps``; without ``eps`` a vector without length stays as it is."""
    length = F.sqrt(dot(v, v))
    # In an array of one, the length is found once and not for every element.
    divisor = length + eps if eps else F.when(length == 0, F.lit(1.0)).otherwise(length)
    return F.get(F.transform(F.array(divisor), lambda n: F.transform(v, lambda x: x.cast("double") / n)), F.lit(0))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 minus the cosine; 1 where a vector has no length."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, 1.0 - dot(a, b) / norm).otherwise(F.lit(1.0))


def adaptive_limit(seconds: float, ratio: float, first: Column, last: Column) -> Column:
    """``seconds`` if positive, else a share of the covered time held between 5 and 30."""
    if seconds > 0:
        return F.lit(float(seconds))
    covered = F.greatest(F.coalesce(last - first, F.lit(0.0)), F.lit(0.0))
    return F.greatest(F.lit(5.0), F.least(F.lit(30.0), covered * ratio))
