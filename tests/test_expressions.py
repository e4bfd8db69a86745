"""Scalars, statistics, intervals, scores and vectors on small inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chorale.config import DEFAULT_WINDOWS, PRESETS, DiarizeOptions, parse_floats, scale_lists
from chorale.functions import scalars, stats
from chorale.operators import intervals, scoring, vectors


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_parsing(spark):
    assert one(spark, scalars.lenient_float(F.lit(" 1.5 "))) == 1.5
    assert one(spark, scalars.lenient_float(F.lit("n/a"))) == 0
    assert one(spark, scalars.lenient_float(F.lit("NaN"))) == 0
    assert one(spark, scalars.clock_seconds(F.lit("01:02:03.250"))) == 3723.25
    with pytest.raises(Exception, match="H:M:S"):
        one(spark, scalars.clock_seconds(F.lit("3 s")))
    assert one(spark, scalars.mouth_flag(F.lit(" Open"))) == 1
    assert one(spark, scalars.clock_seconds(F.lit(" 0:00:02.5 "))) == pytest.approx(2.005)
    resolved = lambda headers, *names: one(spark, scalars.resolved_column(F.array(*map(F.lit, headers)), names))
    assert resolved([" Quality ", "AU10"], "Quality") == " Quality " and resolved(["quality"], "Quality") == "quality"
    assert resolved(["time", "Video Time"], "Video Time", "Time") == "Video Time" and resolved(["time"], "Video Time", "Time") == "time"
    with pytest.raises(Exception, match="no column"):
        resolved(["b"], "a")


def test_options():
    assert parse_floats("1; 2;x", (9.0,)) == (1.0, 2.0)
    assert parse_floats("1, 2 3", (9.0,)) == (1.0, 2.0, 3.0)
    assert parse_floats("", (9.0,)) == (9.0,)
    assert scale_lists((1, 2), (3,), (1,)) == ((1, 2), (3, 3), (1.0, 1.0))
    with pytest.raises(ValueError):
        scale_lists((1, 2, 3), (1, 2), ())
    assert DiarizeOptions(windows=(1.0,), shifts=(0.5,)).weights == (1.0,)
    assert PRESETS["batch"].windows == DEFAULT_WINDOWS
    with pytest.raises(ValueError):
        DiarizeOptions(smoothing="mode")


def test_order_statistics(spark):
    rows = spark.createDataFrame([(0, float(i)) for i in range(1, 7)], "g int, x double")
    assert rows.groupBy("g").agg(stats.nearest_rank(F.col("x"), 50).alias("p")).first()["p"] == 3
    assert stats.ranked_percentiles(rows, ["g"], "x", {"p": 50}).first()["p"] == 3
    four = rows.where("x <= 4")
    assert four.groupBy("g").agg(stats.upper_median(F.col("x")).alias("m")).first()["m"] == 3
    assert rows.where("x > 9").groupBy().agg(stats.upper_median(F.col("x"), 0.04).alias("m")).first()["m"] == 0.04
    many = spark.createDataFrame([(i % 3, float(i * 7 % 11)) for i in range(200)], "g int, x double")
    large = spark.range(60_000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.rand(1)).alias("x")).cache()
    for p in (0, 10, 50, 99.9):
        a = {r["g"]: r["v"] for r in stats.ranked_percentiles(large, ["g"], "x", {"v": p}).collect()}
        b = {r["g"]: r["v"] for r in large.groupBy("g").agg(stats.nearest_rank(F.col("x"), p).alias("v")).collect()}
        assert a == b
    for p in (0, 10, 37, 95, 100):
        a = {r["g"]: r["v"] for r in stats.ranked_percentiles(many, ["g"], "x", {"v": p, "w": 50}).collect()}
        b = {r["g"]: r["v"] for r in many.groupBy("g").agg(stats.nearest_rank(F.col("x"), p).alias("v")).collect()}
        assert a == b


def test_band_join_is_inclusive_and_complete(spark):
    seg = spark.createDataFrame([("r", i, i * 1.5, i * 1.5 + 2.0, 2.0) for i in range(8)], "recording_id string, seg_idx long, start double, end double, dur double")
    smp = spark.createDataFrame([("r", "p", i, i * 0.25, float(i % 3), float(i % 2)) for i in range(60)], "recording_id string, participant string, i long, t float, x double, o double")
    pairs = intervals.samples_in_intervals(seg, smp, ["recording_id"], 0.7)
    expected = {(s, i) for s in range(8) for i in range(60) if s * 1.5 <= i * 0.25 <= s * 1.5 + 2}
    assert {(r["seg_idx"], r["i"]) for r in pairs.collect()} == expected and pairs.count() == len(expected)
    found = intervals.interval_stats(pairs, ["seg_idx"], "x", "x").where("seg_idx = 0").first()
    xs = [i % 3 for i in range(9)]
    mean = sum(xs) / 9
    assert found["x_mean"] == pytest.approx(mean) and found["x_std"] == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in xs) / 9))
    assert intervals.oscillation_rate(pairs, ["seg_idx"], "o", ["i"], "dur").where("seg_idx = 0").first()["rate"] == 4.0
    two = intervals.interval_stats(pairs.where("i < 2"), ["seg_idx"], "x", "x").first()
    assert (two["x_mean"], two["x_std"]) == (0, 0)


def test_ranking_and_softmax(spark):
    df = spark.createDataFrame([(0, "b", 1, 0.5), (0, "a", 0, 0.5), (1, "a", 0, 0.1)], "seg_idx int, participant string, pid_ord int, v double")
    top = {r["seg_idx"]: r for r in scoring.top_three(df, ["seg_idx"], "participant", "pid_ord", "v").collect()}
    assert (top[0]["best_pid"], top[0]["top2_pid"], top[0]["top3_pid"], top[1]["top2_pid"]) == ("a", "b", None, None)
    probs = scoring.softmax(df, ["seg_idx"], "v", 0.08).collect()
    assert sum(r["prob"] for r in probs if r["seg_idx"] == 0) == pytest.approx(1)


def test_activity_limit_falls_back_to_all(spark):
    df = spark.createDataFrame([("r", "a", 0.1), ("r", "b", 0.3), ("r", "c", 0.2)], "recording_id string, participant string, spd_mean double")
    order = lambda d: [(r["participant"], r["pid_ord"]) for r in d.orderBy("pid_ord").collect()]
    key = ["recording_id"]
    assert order(scoring.active_participants(df, key)) == [("a", 0), ("b", 1), ("c", 2)]
    assert order(scoring.active_participants(df, key, 0.15)) == [("b", 0), ("c", 1)]
    assert order(scoring.active_participants(df, key, 0.0, 1)) == [("b", 0)]
    assert order(scoring.active_participants(df, key, 0.9)) == [("a", 0), ("b", 1), ("c", 2)]


def test_vectors(spark):
    df = spark.createDataFrame([("r", 0, [1.0, 0.0], 0), ("r", 1, [0.0, 2.0], 1), ("r", 2, [3.0, 0.1], 0)], "recording_id string, sub_idx long, vec array<double>, label int")
    w = {(r["i"], r["j"]): r["w"] for r in vectors.cosine_affinity(df, ["recording_id"]).collect()}
    assert w[0, 0] == 1 and w[0, 1] == 0 and w[0, 2] > 0.9
    same = df.where("sub_idx = 0")
    assert [r["w"] for r in vectors.cosine_affinity(same, ["recording_id"]).collect()] == [1.0]
    graph = vectors.neighbour_graph(vectors.cosine_affinity(df, ["recording_id"]), ["recording_id"], 2)
    deg = {r["i"]: r["degree"] for r in vectors.degrees(graph, ["recording_id"]).collect()}
    assert deg == {0: 1.0, 1: 0.5, 2: 1.5}
    assert sum(r["w"] for r in vectors.laplacian(graph, ["recording_id"]).collect()) == 0
    mean = vectors.vector_mean(df, ["recording_id"]).first()["vec"]
    assert mean == pytest.approx([4 / 3, 2.1 / 3])
    zero = vectors.vector_mean(df.withColumn("w", F.lit(0.0)), ["recording_id"], weight="w").first()["vec"]
    assert zero == [0, 0]
    assert vectors.silhouette(df, ["recording_id"], "sub_idx", "label").first()["silhouette"] > 0.9
    assert vectors.silhouette(same, ["recording_id"], "sub_idx", "label").first()["silhouette"] == -1
    assert one(spark, scalars.cosine_distance(F.array(F.lit(0.0)), F.array(F.lit(1.0)))) == 1
    assert one(spark, scalars.speech_probability(F.lit(0.0), F.lit(0.0))) == 0.5


@pytest.mark.parametrize("block", [256, 7])
def test_sticky_assignment_is_a_fold(spark, monkeypatch, block):
    import random

    monkeypatch.setattr(scoring, "FOLD_BLOCK", block)
    rng, rows = random.Random(0), []
    for r in range(3):
        for i in range(60):
            best, second = rng.sample("abc", 2)
            value = rng.random()
            rows.append((r, i, rng.choice([best, "c"]), rng.random() < 0.6, best, value, second, value * rng.random()) if rng.random() < 0.9 else (r, i, None, True, None, None, None, None))
    df = spark.createDataFrame(rows, "r int, seg_idx long, choice string, ambiguous boolean, best_pid string, best_val double, top2_pid string, top2_val double")
    got = {(x["r"], x["seg_idx"]): x["participant"] for x in scoring.sticky_assign(df, ["r"], 0.6).collect()}
    for r in range(3):
        held = None
        for _, i, choice, ambiguous, best, value, second, other in (x for x in rows if x[0] == r):
            if best is not None:
                here = value if held == best else other if held == second and other > 0 else 0.0
                held = held if ambiguous and held is not None and here >= 0.6 * value else choice
            assert got[r, i] == held


def test_nearest_vectors_make_no_rows_of_pairs(spark, monkeypatch):
    """Blocks of three, copies whose ties go to the lowest ids: as all pairs have it."""
    monkeypatch.setattr(vectors, "BLOCK", 3)
    rng = np.random.default_rng(0)
    base = rng.normal(size=(6, 4))
    rows = [(f"r{n % 2}", n, base[n * 7 % 6].tolist()) for n in range(40)]
    df = spark.createDataFrame(rows, "recording_id string, sub_idx long, vec array<double>")
    every = vectors.cosine_affinity(df, ["recording_id"])
    want = vectors.nearest(every.withColumn("w", F.round("w", 9)), ["recording_id"], 5)
    got = vectors.nearest_vectors(df, ["recording_id"], 5)
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 200 and every.count() == 800
    some = vectors.cosine_affinity(df, ["recording_id"], rows=F.col("sub_idx") % 10 == 0)
    assert sorted(some.withColumn("w", F.round("w", 9)).collect()) == sorted(every.where("i % 10 = 0").withColumn("w", F.round("w", 9)).collect())
