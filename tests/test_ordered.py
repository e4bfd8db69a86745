"""Ordered operators against hand-made results and against plain folds on random input."""

import random

import pytest
from pyspark.sql import functions as F

from chorale.operators import ordered, scoring

KEY = ["recording_id"]


def fold_segments(p, hop, onset, offset, min_silence):
    out, first, last = [], None, None
    for i, x in enumerate(p):
        if first is None:
            if x >= onset:
                first = last = i
        elif x >= offset:
            last = i
        elif (i - last) * hop >= min_silence:
            out.append((first, last))
            first = None
    return out + ([(first, last)] if first is not None else [])


def series(spark, many):
    return spark.createDataFrame([(r, i, float(x)) for r, p in enumerate(many) for i, x in enumerate(p)], "recording_id int, frame_idx long, p double")


def segments_of(df):
    found = {}
    for r in df.orderBy("recording_id", "seg_idx").collect():
        found.setdefault(r["recording_id"], []).append((round(r["start"], 6), round(r["end"], 6)))
    return found


P = [0, 0.9, 0.6, 0.4, 0.4, 0.4, 0.6, 0.95]


@pytest.mark.parametrize("silence,expected", [(0.03, [(0.01, 0.03), (0.07, 0.08)]), (0.05, [(0.01, 0.08)])])
def test_hysteresis_fixture(spark, silence, expected):
    assert segments_of(ordered.hysteresis_segments(series(spark, [P]), KEY, 0.01, 0.9, 0.5, min_silence=silence))[0] == expected


@pytest.mark.parametrize("onset,offset", [(0.7, 0.3), (0.5, 0.5), (0.3, 0.7)])
@pytest.mark.parametrize("silence", [0.0, -1.0, 0.02, 0.05])
def test_hysteresis_equals_a_fold(spark, onset, offset, silence):
    rng = random.Random(f"{onset}{silence}")
    many = [[rng.choice([0, 0.3, 0.4, 0.5, 0.7, 0.9]) for _ in range(rng.randrange(1, 40))] for _ in range(60)]
    got = segments_of(ordered.hysteresis_segments(series(spark, many), KEY, 0.01, onset, offset, min_silence=silence))
    for r, p in enumerate(many):
        assert got.get(r, []) == [(round(a * 0.01, 6), round((b + 1) * 0.01, 6)) for a, b in fold_segments(p, 0.01, onset, offset, silence)]


def test_hysteresis_pads_and_filters(spark):
    got = ordered.hysteresis_segments(series(spark, [P]), KEY, 0.01, 0.9, 0.5, 0.02, 0.1, 0.13, 0.03)
    assert segments_of(got)[0] == [(0.0, 0.13), (0.05, 0.18)] or segments_of(got)[0] == [(0.05, 0.18)]


def intervals(spark, many):
    return spark.createDataFrame([(r, i, *s) for r, xs in enumerate(many) for i, s in enumerate(xs)], "recording_id int, seg_idx long, start double, end double, speaker string")


def fold_merge(rows, gap):
    out = []
    for _, s, e, who in sorted(((i, *r) for i, r in enumerate(rows)), key=lambda x: (x[1], x[0])):
        if out and who is not None and who.strip() and out[-1][2] == who and s <= out[-1][1] + gap + 1e-6:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e, who])
    return [tuple(x) for x in out]


def merged(df):
    found = {}
    for r in df.orderBy("recording_id", "seg_idx").collect():
        found.setdefault(r["recording_id"], []).append((r["start"], r["end"], r["speaker"]))
    return found


def test_merge_fixture(spark):
    rows = [(0.0, 1.0, "a"), (1.2, 2.0, "a"), (1.9, 3.0, "b"), (3.1, 4.0, "a")]
    assert merged(ordered.merge_adjacent(intervals(spark, [rows]), KEY, "speaker", 0.25))[0] == [(0, 2, "a"), (1.9, 3, "b"), (3.1, 4, "a")]


@pytest.mark.parametrize("gap", [0.0, 0.5, -0.5])
def test_merge_equals_a_fold(spark, gap):
    rng = random.Random(gap)
    many = []
    for _ in range(60):
        many.append([(s := rng.randrange(20) / 2, s + rng.randrange(6) / 2, rng.choice(["a", "b", None, " "])) for _ in range(rng.randrange(1, 12))])
    got = merged(ordered.merge_adjacent(intervals(spark, many), KEY, "speaker", gap))
    assert all(got[r] == fold_merge(rows, gap) for r, rows in enumerate(many))


def test_split_and_number(spark):
    df = spark.createDataFrame([(0, i, float(t)) for i, t in enumerate([0, 1, 1, 2, 0, 1])], "recording_id int, row_idx long, t double")
    blocks = ordered.split_at_resets(df, KEY, "t", "row_idx")
    assert [r["block"] for r in blocks.orderBy("row_idx").collect()] == [0, 0, 0, 0, 1, 1]
    named = ordered.number_blocks(blocks, KEY, 3)
    assert {r["participant"] for r in named.collect()} == {"participant_01"} and named.count() == 4


@pytest.mark.parametrize(
    "span,win,shift,expected",
    [((0, 5), 2, 1.5, [(0, 2), (1.5, 3.5), (3, 5)]), ((0, 4.2), 2, 2, [(0, 2), (2, 4), (2.2, 4.2)]), ((1, 2), 2, 1, [(1, 2)]), ((3, 3), 2, 1, [])],
)
def test_subsegments(spark, span, win, shift, expected):
    df = spark.createDataFrame([(0, 0, float(span[0]), float(span[1]))], "recording_id int, seg_idx long, start double, end double")
    got = [(round(r["start"], 6), round(r["end"], 6)) for r in ordered.subsegments(df, KEY, win, shift).orderBy("sub_idx").collect()]
    assert got == [(float(a), float(b)) for a, b in expected]


def test_subsegments_refuse_no_shift(spark):
    with pytest.raises(ValueError):
        ordered.subsegments(None, KEY, 1.0, 0.0)


@pytest.mark.parametrize("half,expected", [(1, [1.5, 2, 3, 3.5]), (0, [1, 2, 3, 4]), (9, [2.5] * 4)])
def test_moving_average(spark, half, expected):
    df = spark.createDataFrame([(0, i, float(i + 1), half) for i in range(4)], "recording_id int, i long, x double, h int")
    assert [r["y"] for r in ordered.moving_average(df, KEY, "x", "i", "h", "y").orderBy("i").collect()] == expected


def test_speed(spark):
    df = spark.createDataFrame([(0, i, x) for i, x in enumerate([1.0, 3.0, 2.0])], "recording_id int, i long, x double")
    assert [r["v"] for r in ordered.absolute_speed(df, KEY, "x", "i", F.lit(0.5), "v").orderBy("i").collect()] == [0, 4, 2]


def test_overlap_average_and_smoothing(spark):
    windows = spark.createDataFrame([(0, i, float(i)) for i in range(3)], "recording_id int, win_idx long, p double")
    lengths = spark.createDataFrame([(0, 6)], "recording_id int, n_frames long")
    mean = [r["p"] for r in ordered.overlap_average(windows, KEY, 3, lengths).orderBy("frame_idx").collect()]
    assert mean == [0, 0.5, 1, 1.5, 2, 0]
    jump = ordered.jump_of(2, 0.5)
    smooth = [r["p"] for r in ordered.overlap_smooth(windows, KEY, 2, 0.5, "median", lengths).orderBy("frame_idx").collect()]
    covering = [[float(i) for i in range(0, 3, jump) if i <= f < i + 3] for f in range(6)]
    expected, last = [], 0.0
    for values in covering:
        last = sorted(values)[len(values) // 2] if values else last
        expected.append(last)
    assert smooth == expected
    with pytest.raises(ValueError):
        ordered.overlap_smooth(windows, KEY, 2, 0.5, "mode", lengths)


def test_scale_windows(spark):
    df = spark.createDataFrame([(0, 0, 0, 10), (0, 1, 5, 2)], "recording_id int, sub_idx long, first long, n_frames long")
    got = [(r["sub_idx"], r["offset"], r["padded"]) for r in ordered.scale_windows(df, KEY, (0.04,), (0.03,)).orderBy("sub_idx", "offset").collect()]
    assert got == [(0, 0, False), (0, 3, False), (0, 6, False), (1, 0, True)]


def test_sticky_equals_a_fold(spark):
    rng = random.Random(5)
    rows, expected = [], {}
    for rec in range(40):
        prev = None
        for i in range(rng.randrange(1, 15)):
            best, second = rng.choice([0.0, 0.2, 0.5]), rng.choice([None, 0.0, 0.19, 0.46])
            bp, sp = rng.sample(["x", "y", "z"], 2)
            row = (rec, i, rng.choice(["x", "y", "z"]), rng.random() < 0.6, bp, best, None if second is None else sp, second)
            rows.append(row)
            held = best if prev == bp else second if prev == row[6] and second else 0.0
            prev = prev if row[3] and prev is not None and held >= 0.92 * best else row[2]
            expected[rec, i] = prev
    df = spark.createDataFrame(rows, "recording_id int, seg_idx long, choice string, ambiguous boolean, best_pid string, best_val double, top2_pid string, top2_val double")
    got = {(r["recording_id"], r["seg_idx"]): r["participant"] for r in scoring.sticky_assign(df, KEY, 0.92).collect()}
    assert got == expected
