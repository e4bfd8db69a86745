"""Sources, sinks and the three workflows on files that the tests write."""

import io
import json
import os
import wave
import zipfile

import numpy as np
import pytest

from chorale import cli, queries, staging
from chorale.config import AlignOptions, DiarizeOptions, ExtractOptions
from chorale.plans.align import align
from chorale.plans.diarize import diagnostics, diarize, speech_probabilities
from chorale.plans.extract import extract
from chorale.sources import audio, models, sinks, tables

RATE = 16_000
DATA = "/root/testdata/sf0.001"


def wav(samples, rate=RATE, channels=1, width=2):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        scaled = np.round(np.asarray(samples) * ((1 << (8 * width - 1)) - 1)).astype(np.int64)
        if width == 3:
            raw = b"".join(int(v).to_bytes(3, "little", signed=True) for v in scaled.ravel())
        elif width == 1:
            raw = (scaled + 128).astype(np.uint8).tobytes()
        else:
            raw = scaled.astype(f"<i{width}").tobytes()
        w.writeframes(raw)
    return out.getvalue()


def tone(seconds, low, high, seed):
    """Noise in a band, as one voice."""
    n = int(seconds * RATE)
    spectrum = np.fft.rfft(np.random.default_rng(seed).normal(size=n))
    f = np.fft.rfftfreq(n, 1 / RATE)
    spectrum[(f < low) | (f > high)] = 0
    x = np.fft.irfft(spectrum, n)
    return 0.3 * x / np.abs(x).max()


def talk():
    quiet = np.zeros(RATE)
    return np.concatenate([quiet, tone(2, 200, 900, 1), quiet, tone(2, 3000, 6000, 2), quiet, tone(2, 200, 900, 3), quiet])


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_wav_widths_and_stereo(width):
    x = np.linspace(-0.5, 0.5, 101)
    assert audio.decode_wav(wav(x, width=width)) == pytest.approx(x, abs=0.02)
    both = np.stack([x, np.zeros(101)], 1)
    assert audio.decode_wav(wav(both, channels=2, width=width)) == pytest.approx(x / 2, abs=0.02)


def test_resampling_keeps_a_tone():
    t = np.arange(8000) / 8000
    y = audio.decode_wav(wav(0.5 * np.sin(2 * np.pi * 440 * t), rate=8000))
    assert len(y) == RATE
    assert y[100:-100] == pytest.approx(0.5 * np.sin(2 * np.pi * 440 * np.arange(RATE) / RATE)[100:-100], abs=0.01)
    with pytest.raises(ValueError):
        audio.decode_wav(wav(np.zeros((10, 3)), channels=3))


def test_mel_shapes():
    assert audio.log_mel(np.zeros(10)).shape == (0, 80)
    mel = audio.log_mel(tone(1, 200, 900, 0), normalise=True)
    assert mel.shape == (98, 80) and abs(mel.mean(0)).max() < 1e-4


def test_sliding_speech_by_brute_force():
    class Means:
        def speech(self, windows):
            return windows.mean(1)

    mel = np.random.default_rng(0).random((20, 4)).astype(np.float32)
    plain = models.sliding_speech(mel, Means(), 5)
    assert plain == pytest.approx(mel.mean(1))  # every window says the same of a frame
    assert (models.sliding_speech(mel[:4], Means(), 5) == 0).all()

    class Single:
        def speech(self, windows):
            return windows.mean((1, 2))[:, None]

    single = models.sliding_speech(mel, Single(), 5)
    expected = [np.mean([mel[i : i + 5].mean() for i in range(16) if i <= f < i + 5]) for f in range(20)]
    assert single == pytest.approx(np.array(expected))
    for how in ("mean", "median"):
        assert len(models.sliding_speech(mel, Single(), 5, smoothing=how)) == 20


def test_mel_by_plain_sums():
    x = audio.decode_wav(wav(tone(0.1, 200, 3000, 4)))
    mel = audio.log_mel(x, dither=0.0)
    assert mel.shape == (8, 80)
    top = 2595 * np.log10(1 + 8000 / 700)
    edges = [700 * (10 ** (k * top / 81 / 2595) - 1) for k in range(82)]
    for f in (0, 5):
        frame = [x[160 * f + i] * (0.5 - 0.5 * np.cos(2 * np.pi * i / 400)) for i in range(400)]
        power = [abs(sum(v * np.exp(-2j * np.pi * k * i / 512) for i, v in enumerate(frame))) ** 2 for k in range(257)]
        for band in (0, 7, 40, 79):
            low, mid, high = edges[band : band + 3]
            total = sum(p * max(0, min((k * 31.25 - low) / (mid - low), (high - k * 31.25) / (high - mid))) for k, p in enumerate(power))
            assert mel[f, band] == pytest.approx(np.log10(max(total, 1e-9)), abs=1e-3)


@pytest.mark.parametrize("smoothing", ["none", "mean", "median"])
def test_scores_of_tables_and_of_arrays_agree(spark, smoothing):
    """The form for tables (with SQL of its own) and the one that runs beside the model."""
    from chorale.operators import ordered

    class Single:
        def speech(self, windows):
            return windows.mean((1, 2))[:, None]

    mel = np.random.default_rng(5).random((90, 3)).astype(np.float32)
    beside = models.sliding_speech(mel, Single(), 7, smoothing=smoothing, overlap=0.5)
    windows = spark.createDataFrame([("r", i, float(mel[i : i + 7].mean())) for i in range(84)], "recording_id string, win_idx long, p double")
    lengths = spark.createDataFrame([("r", 90)], "recording_id string, n_frames long")
    table = ordered.overlap_average(windows, ["recording_id"], 7, lengths) if smoothing == "none" else ordered.overlap_smooth(windows, ["recording_id"], 7, 0.5, smoothing, lengths)
    assert [r["p"] for r in table.orderBy("frame_idx").collect()] == pytest.approx(beside, abs=1e-6)


def test_windows_of_tables_and_of_arrays_agree(spark):
    from chorale.operators import ordered

    class Seen:
        def embed(self, windows):
            seen.append([(int(w[0, 0]), w.shape[1]) for w in windows])
            return windows.mean(2)

    for n in (3, 10, 17):
        seen, mel = [], np.repeat(np.arange(n, dtype=float)[:, None], 2, 1)
        models.embed_scales(mel, Seen(), (8, 4), (3, 2), (1.0, 1.0))
        subs = spark.createDataFrame([("r", 0, 0, n)], "recording_id string, sub_idx long, first long, n_frames long")
        rows = ordered.scale_windows(subs, ["recording_id"], (0.08, 0.04), (0.03, 0.02)).orderBy("scale", "offset").collect()
        assert [(r["offset"], r["win"]) for r in rows] == [w for scale in seen for w in scale]


def test_model_outputs_are_checked():
    assert models.speech_of_logits(np.zeros((3, 2))).tolist() == [0.5] * 3
    assert models.speech_of_logits(np.zeros((1, 3, 2))).shape == (3,)
    for shape in ((3, 3), (2, 3, 2), (3,)):
        with pytest.raises(ValueError):
            models.speech_of_logits(np.zeros(shape))
    mel = np.ones((3, 4))
    assert models.embed_scales(mel, models.PooledEmbedder(), (5, 2), (1, 1), (0.0, 0.0)).shape == (8,)


def test_diarize_end_to_end(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(wav(talk()))
    (tmp_path / "b.WAV").write_bytes(wav(np.zeros(2 * RATE)))
    (tmp_path / "note.txt").write_text("x")
    with pytest.raises(ValueError):
        audio.list_recordings(spark, str(tmp_path / "note.txt"))
    recordings = audio.list_recordings(spark, str(tmp_path))
    assert audio.list_recordings(spark, str(tmp_path), limit=1).count() == 1
    assert audio.decoded(recordings).count() == 2 and audio.mel_frames(recordings).where("recording_id = 'a'").count() == 998
    options = DiarizeOptions(onset=0.6, offset=0.4, min_silence=0.3, merge_gap=0.25, threshold=0.5)
    rows = diarize(recordings, options=options).orderBy("start").collect()
    assert [r["recording_id"] for r in rows] == ["a"] * 3
    assert [round(r["start"]) for r in rows] == [1, 4, 7] and [round(r["end"]) for r in rows] == [3, 6, 9]
    assert rows[0]["speaker"] == rows[2]["speaker"] != rows[1]["speaker"]
    probs = speech_probabilities(recordings, options=options)
    seen = {r["recording_id"]: r for r in diagnostics(probs, diarize(recordings, options=options)).collect()}
    assert seen["b"]["n_segments"] == 0 and seen["a"]["n_segments"] == 3


def test_segment_files(spark, tmp_path):
    (tmp_path / "x_segments.json").write_text(json.dumps([{"start": 2.0, "end": 3.0, "speaker": "s"}, {"start": 0.0, "end": 1.0, "speaker": "t"}]))
    (tmp_path / "y_segments.json").write_text("null")
    got = tables.read_segments(spark, str(tmp_path)).orderBy("seg_idx").collect()
    assert [(r["recording_id"], r["seg_idx"], r["speaker"]) for r in got] == [("x", 0, "s"), ("x", 1, "t")]
    texts = sinks.segments_json(tables.read_segments(spark, str(tmp_path)))
    paths = sinks.write_texts(texts, lambda r: sinks.output_path(str(tmp_path / "out"), r["recording_id"], is_dir=True))
    assert json.loads(open(paths[0]).read())[0] == {"start": 2.0, "end": 3.0, "speaker": "s"}
    assert sinks.output_path("a/b.json", "r") == "a/b.json" and sinks.output_path("a/", "r", "tag") == "a/tag_segments.json"


def test_files_are_written_by_tasks(spark, tmp_path, monkeypatch):
    texts = spark.range(40).selectExpr("concat('r ', id) AS recording_id", "concat('old ', id) AS json")
    name = lambda r: f"{r['recording_id']}/x.json"
    monkeypatch.setattr(sinks, "tasks_folder", lambda *_: None)  # as where executors have disks of their own
    assert sinks.write_files(texts, str(tmp_path), name) == 40 and (tmp_path / "r 7" / ".x.json.crc").exists()
    monkeypatch.undo()
    monkeypatch.setattr(sinks, "write_bytes", None)
    assert sinks.write_files(texts.selectExpr("recording_id", "replace(json, 'old', 'new') AS json"), f"{tmp_path}/", name) == 40
    assert {(r[0], r[1]) for r in spark.read.text(str(tmp_path), recursiveFileLookup=True).groupBy("value").count().collect()} == {(f"new {i}", 1) for i in range(40)}
    assert sinks.write_files(texts.where("json = ''"), str(tmp_path), name) == 0


def test_tasks_write_only_what_the_driver_sees(spark, tmp_path, monkeypatch):
    inside = f"{staging.shared_folder(spark)}/x"
    assert staging.tasks_folder(spark, str(tmp_path)) == staging.tasks_folder(spark, f"file://{tmp_path}") == str(tmp_path)
    monkeypatch.setattr(staging, "on_one_machine", lambda _: False)
    assert staging.tasks_folder(spark, str(tmp_path)) is None and inside.endswith(staging.tasks_folder(spark, inside))


def test_wav_files_without_the_driver(spark, monkeypatch):
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables")
    monkeypatch.setattr(sinks, "write_bytes", None)
    assert queries.wav_files(spark, DATA).count() > 0


def test_participant_files_without_the_driver(spark, monkeypatch):
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables")
    monkeypatch.setattr(sinks, "write_bytes", None)
    assert queries.participant_files(spark, DATA).count() > 0


def test_many_participant_files_need_few_tasks(spark, tmp_path):
    for k in range(200):
        (tmp_path / f"r{k % 3}").mkdir(exist_ok=True)
        (tmp_path / f"r{k % 3}" / f"participant_{k}.csv").write_text(f"time_sec,mouth_score_raw,mouth_open\n{k},1,0\n\n{k + 1},2,1\n" if k else "")
    found = tables.read_participants(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = {(r["recording_id"], r["participant"], r["i"], r["t"]) for r in found.collect()}
    assert got == {(f"r{k % 3}", f"participant_{k}", i, k + i) for k in range(1, 200) for i in range(2)}


def test_only_the_first_recordings_are_opened(spark, tmp_path):
    for n, name in enumerate(("b.wav", "a b%.wav", "c.wav")):
        (tmp_path / name).write_bytes(wav(np.zeros(RATE * (1 + 9 * (n == 2)))))
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100000")
    try:
        assert [r["recording_id"] for r in audio.list_recordings(spark, str(tmp_path), limit=2).orderBy("path").collect()] == ["a b%", "b"]
        assert audio.list_recordings(spark, str(tmp_path), limit=0).count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_csv_text():
    assert sinks.csv_text([]) == ""
    assert sinks.csv_text([{"a": 1, "b": 'x"y'}, {"c": "1,2"}]) == 'a,b,c\n1,"x""y",\n,,"1,2"\n'


def test_participant_files(spark, tmp_path):
    (tmp_path / "participant_01.csv").write_text("time_sec, mouth_score_raw,mouth_open,extra\n0.0,1.5,1,z\n0.04,x,0\n0.08,2\n")
    (tmp_path / "participant_debug.csv").write_text("a,b\n1,2\n")
    rows = tables.read_participants(spark, str(tmp_path)).orderBy("i").collect()
    assert [(r["participant"], r["i"], r["mouth"], r["mouth_open"]) for r in rows] == [("participant_01", 0, 1.5, 1), ("participant_01", 1, 0, 0), ("participant_01", 2, 2, 0)]
    (tmp_path / "participant_02.csv").write_text("time_sec\n1\n")
    with pytest.raises(Exception, match="no column"):
        tables.read_participants(spark, str(tmp_path)).collect()


def clock(t):
    return f"00:{int(t) // 60:02d}:{int(t) % 60:02d}.{int(round(t * 1000)) % 1000:03d}"


def test_extract_end_to_end(spark, tmp_path):
    header = ["Video Time", None, "Quality", "Mouth", "AU10", "AU12", "AU25", "AU26"]
    rows = [header]
    for n in (5, 4, 2):
        rows += [[clock(i * 0.5), "note", 0.9, "Open" if i % 2 else "closed", 0.1, 0.2, "n/a", 1.0] for i in range(n)]
    rows[2][2] = 0.1  # below the quality threshold
    rows.append([None, None, 1.0])
    (tmp_path / "face.xlsx").write_bytes(tables.workbook_bytes(rows))
    blocks, summary = extract(spark, str(tmp_path), ExtractOptions(min_block_rows=3))
    got = {r["participant_block"]: r for r in summary.collect()}
    assert {k: r["n_rows"] for k, r in got.items()} == {"participant_01": 4, "participant_02": 4}
    assert got["participant_01"]["t_max"] == 2.0
    assert blocks.first()["mouth_score_raw"] == pytest.approx(0.35 + 0.015 + 0.01)
    with pytest.raises(ValueError):
        list(tables.read_sheet(tables.workbook_bytes(rows), "Other"))


def test_workbooks_with_other_headers(spark, tmp_path):
    first = [["Video Time", "Time", "Quality", "Mouth", "AU10", "AU12", "AU25", "AU26"]] + [[clock(i * 0.5), "9:9:9.000", 0.9, "Open", 0, 0, 1.0, 0] for i in range(4)]
    first.append([None, "0:00:05.000", 0.9, "Open", 0, 0, 1.0, 0])  # blank where the preferred column is
    second = [["time", "QUALITY", "Mouth", "Action Unit 10", "AU12", "Lips Part", "Jaw Drop"]] + [[clock(i * 0.5), 0.9, "closed", 0, 0, 2.0, 0] for i in range(3)]
    (tmp_path / "a.xlsx").write_bytes(tables.workbook_bytes(first))
    (tmp_path / "b.xlsx").write_bytes(tables.workbook_bytes(second))
    blocks, summary = extract(spark, str(tmp_path), ExtractOptions(min_block_rows=2))
    assert {r["recording_id"]: (r["n_rows"], r["t_max"]) for r in summary.collect()} == {"a": (4, 1.5), "b": (3, 1.0)}
    assert {r["recording_id"]: round(r["mouth_score_raw"], 4) for r in blocks.collect()} == {"a": 0.45, "b": 0.9}


def test_extracted_participants_are_aligned(spark, tmp_path):
    """Workbooks to participant files to aligned segments on the command line, for two recordings with the same participant names."""
    for n, rec in enumerate(("x y", "z")):
        rows = [["Time", "Quality", "Mouth", "AU10", "AU12", "AU25", "AU26"]]
        for k in range(2):
            for i in range(300):
                active = int(i * 0.04 // 3) % 2 == (k + n) % 2
                rows.append([clock(i * 0.04), 0.9, "Open" if active and i % 3 else "closed", 0, 0, float(1 + np.sin(i * 1.3)) if active else 0.0, 0])
        (tmp_path / "books").mkdir(exist_ok=True)
        (tmp_path / "books" / f"{rec}.xlsx").write_bytes(tables.workbook_bytes(rows))
        (tmp_path / "said").mkdir(exist_ok=True)
        (tmp_path / "said" / f"{rec}_segments.json").write_text(json.dumps([{"start": 3.0 * i, "end": 3.0 * i + 3, "speaker": f"speaker_{i % 2}"} for i in range(4)]))
    people, out = str(tmp_path / "people"), tmp_path / "aligned"
    cli.main(["extract", "--workbooks", str(tmp_path / "books"), "--out", people])
    cli.main(["align", "--segments", str(tmp_path / "said"), "--participants-dir", people, "--out", str(out), "--use-global-map", "--smooth-ms", "0"])
    for n, rec in enumerate(("x y", "z")):
        got = json.loads((out / rec / "aligned_segments.json").read_text())
        assert [r["participant"] for r in got] == [f"participant_0{1 + (i + n) % 2}" for i in range(4)]
        assert set(json.loads((out / rec / "speaker_to_participant.json").read_text())) == {"speaker_0", "speaker_1"}
    found = tables.read_participants(spark, people).groupBy("recording_id", "participant").count().collect()
    assert {(r[0], r[1], r[2]) for r in found} == {(rec, f"participant_0{k}", 300) for rec in ("x y", "z") for k in (1, 2)}


def test_segments_without_participants(spark):
    segments = spark.createDataFrame([("q", 0, 0.0, 5.0, "speaker_0"), ("r", 0, 0.0, 5.0, "speaker_0")], "recording_id string, seg_idx long, start double, end double, speaker string")
    got = {r["recording_id"]: r for r in align(segments, face_samples(spark), AlignOptions(smooth_ms=0.0)).aligned.collect()}
    assert got["q"]["participant"] is None and got["q"]["ambiguous"] and got["q"]["reason"] == "missing_debug_row"
    assert got["r"]["participant"] == "a" and got["r"]["reason"] is None


def face_samples(spark, rec="r"):
    """Participant a's mouth moves in even five-second spans, b's in odd ones."""
    rows = []
    for k, who in enumerate("ab"):
        for i in range(1000):
            t = i * 0.04
            active = int(t // 5) % 2 == k
            rows.append((rec, who, i, t, float(np.sin(i * 1.3)) if active else 0.0, float(active and i % 3 > 0)))
    return spark.createDataFrame(rows, "recording_id string, participant string, i long, t float, mouth float, mouth_open float")


def test_align_end_to_end(spark):
    spans = [("r", n, n * 5.0, n * 5.0 + 5, f"speaker_{n % 2}") for n in range(8)] + [("r", 8, 50.0, 50.1, "speaker_2")]
    segments = spark.createDataFrame(spans, "recording_id string, seg_idx long, start double, end double, speaker string")
    result = align(segments, face_samples(spark), AlignOptions(smooth_ms=0.0, merge_gap=0.1))
    mapped = {r["speaker"]: r["global_pid"] for r in result.global_map.collect()}
    assert mapped["speaker_0"] == "a" and mapped["speaker_1"] == "b" and mapped["speaker_2"] == "a"  # no usable segment: the first participant
    got = [(r["participant"], r["start"]) for r in result.aligned.orderBy("seg_idx").collect()]
    assert got == [("ab"[n % 2], n * 5.0) for n in range(8)]
    debug = {r["participant"]: r for r in result.participants.collect()}
    assert all(r["kept"] and abs(r["dt"] - 0.04) < 1e-4 for r in debug.values())
    assert result.segment_scores.count() == 8


def test_align_without_segments(spark):
    none = spark.createDataFrame([], "recording_id string, seg_idx long, start double, end double, speaker string")
    assert align(none, face_samples(spark)).aligned.count() == 0


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.wav").write_bytes(wav(talk()))
    out = tmp_path / "out"
    cli.main(["diarize", "--audio", str(tmp_path / "in"), "--out", str(out), "--onset", "0.6", "--offset", "0.4", "--threshold", "0.5", "--windows", "1.0;0.5", "--shifts", "0.5", "--copy-out", str(tmp_path / "copy")])
    assert len(json.loads((out / "a_segments.json").read_text())) == 3
    assert (tmp_path / "copy" / "a_segments.json").read_text() == (out / "a_segments.json").read_text()
    assert "a: 998 frames" in capsys.readouterr().out
    people = tmp_path / "people"
    people.mkdir()
    for who, g in face_samples(spark).toPandas().groupby("participant"):
        lines = ["time_sec,mouth_score_raw,mouth_open"] + [f"{t:.4f},{m},{o}" for t, m, o in zip(g["t"], g["mouth"], g["mouth_open"])]
        (people / f"participant_{who}.csv").write_text("\n".join(lines) + "\n")
    cli.main(["align", "--segments", str(out / "a_segments.json"), "--participants-dir", str(people), "--out", str(tmp_path / "aligned"), "--use-global-map"])
    found = json.loads((tmp_path / "aligned" / "aligned_segments.json").read_text())
    assert found and set(found[0]) >= {"start", "end", "speaker", "participant", "ambiguous"}
    args = cli.parser().parse_args(["diarize", "--audio", "x", "--out", "y", "--preset", "subset", "--min-seg", "2"])
    options = cli.options_from(args, cli.PRESETS[args.preset])
    assert options.min_seg == 2 and options.onset == 0.95 and options.windows == DiarizeOptions().windows


def message(*fields) -> bytes:
    """Fields (number, value) in the wire format of protocol buffers: integers, bytes, texts and lists of packed integers."""

    def number(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    out = b""
    for field, value in fields:
        if isinstance(value, int):
            out += number(field << 3) + number(value)
        else:
            raw = value.encode() if isinstance(value, str) else b"".join(map(number, value)) if isinstance(value, list) else value
            out += number(field << 3 | 2) + number(len(raw)) + raw
    return out


def onnx_model(nodes, output, shape, batch) -> bytes:
    """A model with the inputs audio_signal and length; a dimension is a number or a name."""
    dim = lambda d: (1, message((1, d) if isinstance(d, int) else (2, d)))
    tensor = lambda name, kind, dims: message((1, name), (2, message((1, message((1, kind), (2, message(*map(dim, dims))))))))

    def node(op, inputs, result, ints=(), flags=()):
        attributes = [(5, message((1, k), *[(8, v) for v in vs], (20, 7))) for k, vs in ints] + [(5, message((1, k), (3, v), (20, 2))) for k, v in flags]
        return message(*[(1, x) for x in inputs], (2, result), (4, op), *attributes)

    graph = message(*[(1, node(*n)) for n in nodes], (2, "g"), (11, tensor("audio_signal", 1, (batch, 80, "frames"))), (11, tensor("length", 7, (batch,))), (12, tensor(output, 1, shape)))
    return message((1, 7), (7, graph), (8, message((1, ""), (2, 13))))


@pytest.mark.parametrize("batch", ["batch", 1])
def test_onnx_models_run(spark, tmp_path, batch):
    pytest.importorskip("onnxruntime")
    # The mean of the bands and its negative as logits; the mean of the frames as the vector.
    vad = [("ReduceMean", ["audio_signal"], "m", [("axes", [1])], [("keepdims", 1)]), ("Transpose", ["m"], "x", [("perm", [0, 2, 1])]), ("Neg", ["x"], "y"), ("Concat", ["y", "x"], "logits", (), [("axis", 2)])]
    spk = [("ReduceMean", ["audio_signal"], "vec", [("axes", [2])], [("keepdims", 0)])]
    (tmp_path / f"vad{batch}.onnx").write_bytes(onnx_model(vad, "logits", (batch, "frames", 2), batch))
    (tmp_path / f"spk{batch}.onnx").write_bytes(onnx_model(spk, "vec", (batch, 80), batch))
    windows = np.random.default_rng(0).normal(size=(5, 80, 7)).astype(np.float32)
    scorer, embedder = models.OnnxVad(str(tmp_path / f"vad{batch}.onnx")), models.OnnxEmbedder(str(tmp_path / f"spk{batch}.onnx"))
    assert scorer.speech(windows) == pytest.approx(1 / (1 + np.exp(-2 * windows.mean(1))), abs=1e-5)
    assert embedder.embed(windows) == pytest.approx(windows.mean(2), abs=1e-5)
    assert [i[0] for i in models.describe_model(scorer.path)] == ["audio_signal", "length"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.wav").write_bytes(wav(talk()))
    shipped = models.OnnxVad(models.distribute(spark, scorer.path)), models.OnnxEmbedder(models.distribute(spark, embedder.path))
    recordings = audio.list_recordings(spark, str(tmp_path / "in"))
    options = DiarizeOptions(onset=0.3, offset=0.2, min_silence=0.3, vad_window=0.1, subseg_win=1.0, subseg_shift=1.0)
    p = [r["p"] for r in speech_probabilities(recordings, shipped[0], options).orderBy("frame_idx").collect()]
    mel = audio.log_mel(audio.decode_wav(wav(talk())))
    assert len(p) == len(mel) and p[50] == pytest.approx(1 / (1 + np.exp(-2 * mel[41:60].mean())), abs=0.05)
    found = diarize(recordings, *shipped, DiarizeOptions(onset=1e-6, offset=1e-6, min_silence=0.3, vad_window=0.1, subseg_win=1.0, subseg_shift=1.0, threshold=0.0)).collect()
    assert found


def test_streaming_equals_batch(spark, tmp_path):
    from chorale.operators.ordered import hysteresis_segments
    from chorale.streaming.sessions import hysteresis_stream

    rng = np.random.default_rng(0)
    rows = [(r, i, float(p)) for r in "xy" for i, p in enumerate(rng.random(200))]
    schema = "recording_id string, frame_idx long, p double"
    for part in range(4):
        spark.createDataFrame([r for r in rows if part * 50 <= r[1] < part * 50 + 50], schema).coalesce(1).write.parquet(str(tmp_path / f"in/part={part}"))
    batch = hysteresis_segments(spark.createDataFrame(rows, schema), ["recording_id"], onset=0.9, offset=0.6, min_silence=0.03)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    q = hysteresis_stream(stream, onset=0.9, offset=0.6, min_silence=0.03).writeStream.format("memory").queryName("spoken").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    try:
        assert q.awaitTermination(90)
        streamed = {(r["recording_id"], round(r["start"], 6), round(r["end"], 6)) for r in spark.table("spoken").collect()}
    finally:
        q.stop()
    whole = {(r["recording_id"], round(r["start"], 6), round(r["end"], 6)) for r in batch.collect()}
    assert streamed <= whole and len(whole - streamed) <= 2  # the last of a recording may still be open


def _one_at_a_time(size):
    """Files that fail where more than a few of them are held at once."""
    alive = [0]

    class Held(bytes):
        def __del__(self):
            alive[0] -= 1

    def make(_):
        alive[0] += 1
        if alive[0] > 3:
            raise MemoryError("files of many rows at once")
        return Held(queries.wav_bytes(np.zeros(size)))

    return make


def test_recordings_are_made_one_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(queries, "_wav_of", _one_at_a_time(800))
    found = queries.wav_scan(spark, DATA).collect()
    assert len(found) > 4 and {r.n_samples for r in found} == {800}
    assert {r.n_frames for r in queries.vad_model(spark, DATA).collect()} == {r.n_frames for r in queries.mel_features(spark, DATA).collect()} == {3}
