"""Scans and sinks of cue files."""

from cueforge.functions.times import parsed_time, srt_time, srt_time_of_seconds
from cueforge.plans.queries import ODD_FILE
from cueforge.sources.sinks import changes, flag_report, render_corrected, render_numbered, render_original_index, write_intermediate, write_rendered
from cueforge.sources.srt import parse_cues, read_cues, text_only
from cueforge.streaming.cues import stream_cues

FILES = "file_id string, value string"


def parse(spark, text):
    return [tuple(r)[1:] for r in parse_cues(spark.createDataFrame([("f", text)], FILES)).orderBy("ordinal").collect()]


def test_odd_file(spark):
    assert parse(spark, ODD_FILE) == [(1, 1, 1000, 2500, "First line second line"), (2, 2, 3000, 4000, " lean text"), (3, 6, 11000, 12000, ""), (4, 10, 3600007, 3599000, "1984")]


def test_blocks(spark):
    time = "00:00:01,000 --> 00:00:02,000"
    assert parse(spark, "") == [] and parse(spark, " \n\n ") == []
    assert parse(spark, f"1\n{time}\na\n \nb\n\n2\n{time}\nc") == [(1, 1, 1000, 2000, "a   b"), (2, 2, 1000, 2000, "c")]
    assert parse(spark, f"1\r{time}\r　a　\r\r\r3\r{time}\rb") == [(1, 1, 1000, 2000, "a"), (2, 3, 1000, 2000, "b")]
    assert parse(spark, f"1.5\n{time}\na") == [] and parse(spark, "1\n0:00:01,000 --> 00:00:02,000\na") == []
    assert parse(spark, f" -3 \n{time} X1:0\na <i>b</i> c < d") == [(1, -3, 1000, 2000, "a b c < d")]


def test_text_only(spark):
    text = "﻿1\n00:00:01,000 --> 00:00:02,000\n<i>a</i>\n\n2\n00:00:01.000 --> 00:00:02.000\n1984\n  b  \n"
    got = text_only(spark.createDataFrame([("f", text), ("g", ""), ("h", None)], FILES)).collect()
    assert [r["text"] for r in got] == ["﻿1 <i>a</i> 00:00:01.000 --> 00:00:02.000 b", "", None]


def test_times(spark):
    row = spark.createDataFrame([(360_000_007, 4.35)], "ms long, s double").select(srt_time("ms"), srt_time_of_seconds("s"), parsed_time(srt_time("ms")), srt_time_of_seconds("ms")).first()
    assert row[0] == "100:00:00,007" and row[1] == "00:00:04,349" and row[2] is None


def rows(spark):
    return spark.createDataFrame(
        [("f", 2, 7, 2000, 3000, "noisy b", "", "r", True, "why"), ("f", 1, 9, 0, 1000, "noisy a", "good a", "", False, ""), ("g", 1, 1, 0, 1, "x", "x", "", False, "")],
        "file_id string, ordinal int, index long, start_ms long, end_ms long, noisy string, corrected string, ref string, flagged boolean, flag_reason string",
    )


def test_renderings(spark):
    df = rows(spark)
    first = {r["file_id"]: r["content"] for r in render_corrected(df).collect()}
    assert first["f"] == "1\n00:00:00,000 --> 00:00:01,000\ngood a\n\n2\n00:00:02,000 --> 00:00:03,000\nnoisy b\n"
    own = {r["file_id"]: r["content"] for r in render_original_index(df, "noisy").collect()}
    assert own["f"].startswith("9\n") and "\n\n7\n" in own["f"]
    report = flag_report(df).collect()
    assert [tuple(r) for r in report] == [("f", "2\n00:00:02,000 --> 00:00:03,000\n[FLAG: why]\nCORRECTED: noisy b\nORIGINAL:  noisy b\nREFERENCE: r\n")]
    assert {(r["file_id"], r["ordinal"]): r["changed"] for r in changes(df).collect()} == {("f", 1): True, ("f", 2): True, ("g", 1): False}


def test_written_files_scan_the_same(spark, tmp_path):
    df = rows(spark)
    write_rendered(render_numbered(df, "noisy"), str(tmp_path / "out"))
    write_rendered(flag_report(df.filter("file_id = 'g'")), str(tmp_path / "none"))
    got = read_cues(spark, str(tmp_path / "out" / "file_id=f"))
    assert [tuple(r)[1:] for r in got.orderBy("ordinal").collect()] == [(1, 1, 0, 1000, "noisy a"), (2, 2, 2000, 3000, "noisy b")]
    text = next((tmp_path / "out" / "file_id=g").glob("*.txt")).read_bytes()
    assert text == b"1\n00:00:00,000 --> 00:00:00,001\nx\n"
    assert not list((tmp_path / "none").glob("file_id=*"))
    write_intermediate(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 3


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.srt").write_text(ODD_FILE)
    (folder / "b.srt").write_text("1\n00:00:01,000 --> 00:00:02,000\nx\n")
    query = stream_cues(spark, str(folder)).writeStream.format("memory").queryName("cues").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.table("cues").count() == 5
