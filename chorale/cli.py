"""Command line: ``python -m chorale.cli diarize|extract|align --help``."""

from __future__ import annotations

import argparse
from dataclasses import fields, replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import CLI_ALIGN, PRESETS, DiarizeOptions, ExtractOptions, parse_floats
from .sources.audio import ANY_WAV


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="chorale")
    modes = top.add_subparsers(dest="mode", required=True)
    d = modes.add_parser("diarize", help="WAV files to segments")
    d.add_argument("--audio", required=True, help="a WAV file or a folder of them")
    d.add_argument("--out", required=True)
    d.add_argument("--vad", help="ONNX file of the speech model")
    d.add_argument("--spk", help="ONNX file of the speaker model")
    d.add_argument("--preset", choices=sorted(PRESETS))
    d.add_argument("--limit", type=int)
    d.add_argument("--pattern", default=ANY_WAV)
    d.add_argument("--copy-out", help="a folder for a second copy of the segment files")
    e = modes.add_parser("extract", help="face-table workbooks to participant tables")
    e.add_argument("--workbooks", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--keep-all", action="store_true")
    a = modes.add_parser("align", help="segments and participant tables to aligned segments")
    a.add_argument("--segments", required=True)
    a.add_argument("--participants-dir", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--use-global-map", action="store_true")
    for sub, options in ((d, DiarizeOptions()), (e, ExtractOptions()), (a, CLI_ALIGN)):
        for f in fields(options):
            value = getattr(options, f.name)
            if isinstance(value, bool):
                continue
            kind = str if value is None or isinstance(value, (str, tuple)) else type(value)
            sub.add_argument("--" + f.name.replace("_", "-"), type=kind)
    return top


def options_from(args: argparse.Namespace, base):
    """``base`` with the flags that were given; lists are numbers between commas or semicolons."""
    given = {}
    for f in fields(base):
        value = getattr(args, f.name, None)
        if value is None or value is False:
            continue
        given[f.name] = parse_floats(value, getattr(base, f.name)) if isinstance(getattr(base, f.name), tuple) else value
    return replace(base, **given)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"chorale {args.mode}").getOrCreate()
    from .sources import sinks

    if args.mode == "diarize":
        from .plans.diarize import diagnostics, diarize, speech_probabilities
        from .sources.audio import list_recordings
        from .sources.models import OnnxEmbedder, OnnxVad, distribute
        from .staging import staged

        options = options_from(args, PRESETS[args.preset] if args.preset else DiarizeOptions())
        recordings, scorer, embedder = list_recordings(spark, args.audio, args.pattern, args.limit), None, None
        if args.vad:
            scorer = OnnxVad(distribute(spark, args.vad))
        if args.spk:
            embedder = OnnxEmbedder(distribute(spark, args.spk))
        probs = staged(speech_probabilities(recordings, scorer, options))
        found = staged(diarize(recordings, scorer, embedder, options, probs))
        single = args.out.endswith(".json")
        sinks.write_texts(sinks.segments_json(found), lambda row: sinks.output_path(args.out, row["recording_id"], is_dir=not single))
        if not single:
            sinks.write_csv(sinks.run_summary(found).orderBy("file").coalesce(1), f"{args.out.rstrip('/')}/run_summary")
        if args.copy_out:
            sinks.write_texts(sinks.segments_json(found), lambda row: sinks.output_path(args.copy_out, row["recording_id"], is_dir=True))
        for row in diagnostics(probs, found).orderBy("recording_id").toLocalIterator():
            print(
                f"{row['recording_id']}: {row['n_frames']} frames, p {row['p_min']:.3f} to {row['p_max']:.3f}, mean {row['p_mean']:.3f}; "
                f"{row['n_segments']} segments, the last ends at {row['last_end']:.2f} s"
            )
    elif args.mode == "extract":
        from .plans.extract import extract

        blocks, summary = extract(spark, args.workbooks, options_from(args, ExtractOptions()))
        out = args.out.rstrip("/")
        sinks.write_files(sinks.participant_csv(blocks), out, lambda row: f"{row['recording_id']}/{row['participant']}.csv", "csv")
        sinks.write_csv(summary, f"{out}/participants_summary")
    else:
        from .operators.scoring import score_matrix
        from .plans.align import align
        from .sources.tables import read_participants, read_segments

        segments, samples = read_segments(spark, args.segments), read_participants(spark, args.participants_dir)
        first = [r[0] for r in segments.select("recording_id").distinct().limit(2).collect()]
        if len(first) < 2 and samples.select("recording_id").distinct().limit(2).count() < 2:
            # One recording: the tables are its own, whatever their folder is called.
            samples = samples.withColumn("recording_id", F.lit(first[0] if first else ""))
        result = align(segments, samples, options_from(args, CLI_ALIGN))
        out = args.out.rstrip("/")
        folder = lambda row: out if len(first) < 2 else f"{out}/{row['recording_id']}"
        sinks.write_csv(result.participants, f"{out}/participant_debug")
        sinks.write_csv(result.segment_scores, f"{out}/segment_vvad_debug")
        # One name for each column of the wide form; the long form has no such bound.
        names = sorted(r[0] for r in result.score_matrix.select("participant").distinct().collect())
        sinks.write_csv(score_matrix(result.score_matrix, ["recording_id"], names), f"{out}/score_matrix")
        sinks.write_texts(sinks.map_json(result.global_map, "speaker", "global_pid"), lambda row: f"{folder(row)}/speaker_to_participant.json")
        shown = ("start", "end", "speaker", "participant", "ambiguous", "reason", "best_pid", "best_val", "top2_pid", "top2_val", "global_pid")
        sinks.write_texts(sinks.segments_json(result.aligned, shown), lambda row: f"{folder(row)}/aligned_segments.json")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
