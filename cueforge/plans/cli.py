"""The pipelines over single files: python -m cueforge.plans.cli correct|fix|compare|transcribe ..."""

from __future__ import annotations

import argparse
import importlib
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import NOISE
from ..operators.providers import MODELS, HttpCorrector, segments, with_clips, with_replies
from ..operators.quality import change_summary, run_summary, with_flags
from ..sources.sinks import flag_report, render_corrected, render_original_index
from ..sources.srt import parse_cues, read_files, text_only
from . import pipelines

KEY = "CUEFORGE_API_KEY"
ONE = "file"
#: The wording of the run summary and of the score report.
SUMMARY = "Segments processed: {total}\nAvg confidence: {avg_confidence:.2%}\nFlagged for review: {flagged} ({rate})\nNo reference match: {no_ref}"
SCORE = "Normalized Levenshtein distance: {distance:.4f}\nSimilarity: {similarity:.4f} ({percent:.1f}%)"
SCORED_FILE = "File {k}: {name} ({size} chars)"


def api_key(args: argparse.Namespace, folder: str = ".") -> str | None:
    """The key given, else of the environment, else of a .env file (lines NAME=value, quotes and 'export' taken off)."""
    if args.api_key or os.environ.get(KEY):
        return args.api_key or os.environ[KEY]
    path = Path(folder, ".env")
    for line in path.read_text(encoding="utf-8").splitlines() if path.is_file() else []:
        name, found, value = line.strip().removeprefix("export ").partition("=")
        if found and name.strip() == KEY:
            return value.strip().strip("\"'") or None
    return None


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cueforge")
    sub = p.add_subparsers(dest="command", required=True)
    model = argparse.ArgumentParser(add_help=False)
    model.add_argument("--replies", help="recorded replies as JSON lines: ordinal, raw, error")
    model.add_argument("--url", help="chat completions address")
    model.add_argument("--model", default="", help="name of the model at that address")
    model.add_argument("--api-key", help=f"default: ${KEY}")
    c = sub.add_parser("correct", parents=[model], help="align, hear again, correct, flag")
    for name in ("noisy", "reference", "output"):
        c.add_argument(f"--{name}", required=True)
    c.add_argument("--flagged", help="default: the output with .flagged.txt for its suffix")
    c.add_argument("--video")
    c.add_argument("--provider", help="module:function that makes a transcriber")
    c.add_argument("--no-whisper", action="store_true")
    c.add_argument("--no-llm", action="store_true")
    c.add_argument("--batch-delay", type=float, default=0.3)
    c.add_argument("--intermediate")
    f = sub.add_parser("fix", parents=[model], help="fix characters that sound alike")
    f.add_argument("input")
    for name in ("reference", "output"):
        f.add_argument(f"--{name}", required=True)
    f.add_argument("--delay", type=float, default=0.3)
    f.add_argument("--ref-count", type=int, default=5)
    f.add_argument("--noise", default=NOISE, help="pattern of reference lines to leave out")
    d = sub.add_parser("compare", help="edit-distance score of two files' texts")
    d.add_argument("files", nargs=2)
    t = sub.add_parser("transcribe", help="a medium's speech as SRT")
    t.add_argument("video")
    t.add_argument("--provider", required=True, help="module:function that makes a transcriber of a model size")
    t.add_argument("--model", choices=MODELS, default="medium")
    t.add_argument("--output")
    return p


def cues(spark: SparkSession, path: str) -> DataFrame:
    return parse_cues(read_files(spark, path).withColumn("file_id", F.lit(ONE)))


def made(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def content(rendered: DataFrame) -> str:
    row = rendered.first()  # one file has one row
    return row["content"] if row else ""


def replies(spark: SparkSession, args: argparse.Namespace, requests: DataFrame, delay: float) -> DataFrame | None:
    if args.replies:
        return spark.read.schema("ordinal int, raw string, error string").json(args.replies).withColumn("file_id", F.lit(ONE))
    key = api_key(args)
    if not key or not args.url:
        return None
    return with_replies(requests, lambda: HttpCorrector(args.url, args.model, key, delay=delay), calls_at_once=1).cache()


def correct(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = pipelines.aligned(cues(spark, args.noisy), cues(spark, args.reference))
    if args.video and args.provider and not args.no_whisper:
        rows = pipelines.heard(rows, with_clips(pipelines.transcription_requests(rows, F.lit(args.video)), made(args.provider)).cache())
    else:
        # a medium without a model leaves the second transcription empty
        rows = pipelines.heard(rows, missing_model=bool(args.video and not args.no_whisper))
    if args.intermediate:
        Path(args.intermediate).write_text(rows.orderBy("ordinal").agg(F.to_json(F.array_agg(F.struct(*rows.columns)))).first()[0] or "[]", encoding="utf-8")
    got = None if args.no_llm else replies(spark, args, pipelines.correction_requests(rows), args.batch_delay)
    out = with_flags(pipelines.corrected(rows, got, skip=args.no_llm)).cache()
    Path(args.output).write_text(content(render_corrected(out)), encoding="utf-8")
    if report := content(flag_report(out)):
        Path(args.flagged or str(Path(args.output).with_suffix("")) + ".flagged.txt").write_text(report, encoding="utf-8")
    s = run_summary(out).first()
    rate = "-" if s["flag_rate"] is None else f"{s['flag_rate']:.0%}"
    print(SUMMARY.format(**s.asDict(), rate=rate))


def fix(spark: SparkSession, args: argparse.Namespace) -> None:
    if not args.replies and not (args.url and api_key(args)):
        sys.exit("Error: recorded replies, or an address and an API key, are needed")
    rows = pipelines.prepared(cues(spark, args.input), cues(spark, args.reference), args.ref_count, noise=args.noise)
    out = pipelines.fixed(rows, replies(spark, args, pipelines.fix_requests(rows), args.delay)).cache()
    Path(args.output).write_text(content(render_original_index(out, "new")), encoding="utf-8")
    for r in out.orderBy("ordinal").select("ordinal", "text", "new", "changed").toLocalIterator():
        print(f"[{r['ordinal']}] {r['text']} " + (f"→ {r['new']}" if r["changed"] else "(unchanged)"))
    s = change_summary(out, "text", "new").first()
    print(f"{s['changed']}/{s['total']} segments corrected")


def compare(spark: SparkSession, args: argparse.Namespace) -> None:
    one, two = (text_only(read_files(spark, p)).select(F.lit(p).alias(f"file{k}"), F.col("text").alias(f"text{k}"), F.lit(1).alias("one")) for k, p in enumerate(args.files, 1))
    r = pipelines.compare(one.join(two, "one")).first()
    for k in (1, 2):
        print(SCORED_FILE.format(k=k, name=r[f"file{k}"], size=r[f"len{k}"]))
    print(SCORE.format(distance=r["distance"], similarity=r["similarity"], percent=r["similarity"] * 100))


def transcribe(spark: SparkSession, args: argparse.Namespace) -> None:
    if not Path(args.video).exists():
        sys.exit(f"Error: file not found: {args.video}")
    media = spark.createDataFrame([(ONE, args.video)], "file_id string, media string")
    began = time.monotonic()
    out = Path(args.output or media.select(pipelines.output_path("media")).first()[0])
    out.write_text(content(pipelines.transcribed(segments(media, made(args.provider), args.model))), encoding="utf-8")
    print(f"{out} written in {time.monotonic() - began:.1f} s")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("cueforge").getOrCreate()
    {"correct": correct, "fix": fix, "compare": compare, "transcribe": transcribe}[args.command](spark, args)


if __name__ == "__main__":
    main()
