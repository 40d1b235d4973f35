"""Pipelines end to end with recorded and offline models."""

import pytest
from pyspark.sql import functions as F

from cueforge.operators.providers import ClipTranscriber, HttpCorrector, clip_command, segments, with_clips, with_replies
from cueforge.plans import pipelines
from cueforge.sources.sinks import render_corrected
from cueforge.sources.srt import parse_cues, text_only


def srt(lines):
    clock = lambda s: f"00:00:{s:02d},000"
    return "\n".join(f"{k}\n{clock(a)} --> {clock(b)}\n{t}\n" for k, (a, b, t) in enumerate(lines, 1))


NOISY = srt([(0, 2, "他說是鐘很好"), (10, 12, "問花級開始"), (20, 22, "他在"), (40, 42, "沒有")])
REFS = srt([(0, 2, "它說時中很好"), (10, 12, "問花紙開始"), (23, 24, "它在")])
GOLD = srt([(0, 2, "它說時中很好"), (10, 12, "問花紙開始"), (20, 22, "它在"), (40, 42, "沒有")])


def files(spark, text, name="f"):
    return spark.createDataFrame([(name, text)], "file_id string, value string")


def test_fix_scores_higher_than_the_noisy_track(spark):
    noisy, refs = parse_cues(files(spark, NOISY)), parse_cues(files(spark, REFS))
    replies = spark.createDataFrame([("f", k, '[{"wrong": "是鐘", "correct": "時中"}]' if k == 1 else "[]", None) for k in range(1, 5)], "file_id string, ordinal int, raw string, error string")
    out = pipelines.fix(noisy, refs, replies)
    assert {r["ordinal"]: r["new"] for r in out.collect()} == {1: "它說時中很好", 2: "問花紙開始", 3: "它在", 4: "沒有"}
    from cueforge.sources.sinks import render_original_index

    fixed = render_original_index(out, "new").withColumnRenamed("content", "value")
    tracks = text_only(files(spark, NOISY, "noisy").unionByName(fixed.select(F.lit("fixed").alias("file_id"), "value")))
    gold = text_only(files(spark, GOLD, "gold"))
    pairs = tracks.select(F.col("file_id").alias("file1"), F.col("text").alias("text1")).join(gold.select(F.col("file_id").alias("file2"), F.col("text").alias("text2")), F.col("file2") == "gold")
    score = {r["file1"]: r["similarity"] for r in pipelines.compare(pairs).collect()}
    assert score["fixed"] == 1.0 > score["noisy"]


def test_correct_and_its_skips(spark):
    noisy, refs = parse_cues(files(spark, NOISY)), parse_cues(files(spark, REFS))
    second = spark.createDataFrame([("f", 1, "second"), ("f", 2, "")], "file_id string, ordinal int, whisper string")
    skipped = {r["ordinal"]: r["corrected"] for r in pipelines.correct(noisy, refs, second, skip_model=True).collect()}
    assert skipped == {1: "second", 2: "問花級開始", 3: "他在", 4: "沒有"}
    no_key = pipelines.correct(noisy, refs, second)
    assert {r["corrected"] for r in no_key.collect()} == {""}
    assert "second" not in render_corrected(no_key).first()["content"]
    replies = spark.createDataFrame([("f", 1, '{"corrected": "它說", "confidence": 0.9}', None), ("f", 2, None, "down")], "file_id string, ordinal int, raw string, error string")
    got = {r["ordinal"]: r for r in pipelines.correct(noisy, refs, replies=replies).collect()}
    assert got[1]["corrected"] == "它說" and not got[1]["flagged"] and got[2]["flag_reason"] == "API error: down" and got[2]["confidence"] == 0.0
    assert got[3]["corrected"] == "他在" and got[3]["confidence"] == 0.7 and got[1]["ref"] == "它說時中很好"


class Echo:
    def complete(self, messages):
        if "是鐘" in messages[1]["content"].split("\n")[0]:
            raise RuntimeError("no")
        return "[]"


def test_providers(spark, tmp_path):
    noisy, refs = parse_cues(files(spark, NOISY)), parse_cues(files(spark, REFS))
    rows = pipelines.prepared(noisy, refs)
    replies = with_replies(pipelines.fix_requests(rows), Echo, calls_at_once=2)
    got = {r["ordinal"]: (r["raw"], r["error"]) for r in replies.collect()}
    assert got[1] == (None, "no") and got[2] == ("[]", None) and len(got) == 4
    asked = pipelines.transcription_requests(pipelines.aligned(noisy, refs), F.lit("/media/a b.mp4"))
    make = lambda: ClipTranscriber(lambda wav, hint: f" {hint} " if hint != "沒有" else 1 / 0, extract=lambda *a: None)
    clips = {r["ordinal"]: r["whisper"] for r in with_clips(asked, make).collect()}
    assert clips == {1: "它說時中很好", 2: "問花紙開始", 3: "他在", 4: "沒有"}
    media = spark.createDataFrame([("m", "/media/x.mp4")], "file_id string, media string")
    whole = lambda model: ClipTranscriber(None, lambda path: [{"start": 0, "end": 1.5, "text": f" {model} "}])
    out = pipelines.transcribed(segments(media, whole, "tiny")).first()
    assert out["content"] == "1\n00:00:00,000 --> 00:00:01,500\ntiny\n"
    with pytest.raises(ValueError):
        segments(media, whole, "huge")
    with pytest.raises(ValueError):
        HttpCorrector("http://localhost", "m", "")
    assert clip_command("a;b.mp4", 1500, 2750, "o.wav")[3:8] == ["1.500", "-i", "a;b.mp4", "-t", "1.250"]
    assert media.select(pipelines.output_path("media")).first()[0] == "/media/x.srt"
