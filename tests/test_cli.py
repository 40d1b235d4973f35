"""The command line over small files."""

import json
import sys

import pytest

from cueforge.plans.cli import main

from .test_pipelines import GOLD, NOISY, REFS


@pytest.fixture
def files(tmp_path):
    for name, text in (("noisy", NOISY), ("refs", REFS), ("gold", GOLD)):
        (tmp_path / f"{name}.srt").write_text(text, encoding="utf-8")
    return tmp_path


def test_fix_and_compare(spark, files, capsys):
    (files / "replies.json").write_text(json.dumps({"ordinal": 1, "raw": '[{"wrong": "是鐘", "correct": "時中"}]'}, ensure_ascii=False))
    main(["fix", str(files / "noisy.srt"), "--reference", str(files / "refs.srt"), "--output", str(files / "out.srt"), "--replies", str(files / "replies.json")], spark)
    assert (files / "out.srt").read_text(encoding="utf-8") == GOLD
    assert "3/4 segments corrected" in capsys.readouterr().out
    main(["compare", str(files / "noisy.srt"), str(files / "gold.srt")], spark)
    out = capsys.readouterr().out
    assert "Similarity: 0." in out and "chars)" in out


def test_correct(spark, files, capsys):
    base = ["correct", "--noisy", str(files / "noisy.srt"), "--reference", str(files / "refs.srt"), "--output", str(files / "c.srt")]
    main([*base, "--no-llm", "--intermediate", str(files / "i.json")], spark)
    assert (files / "c.srt").read_text(encoding="utf-8") == NOISY and not (files / "c.flagged.txt").exists()
    assert [r["ordinal"] for r in json.loads((files / "i.json").read_text())] == [1, 2, 3, 4]
    (files / "r.json").write_text('{"ordinal": 2, "raw": null, "error": "down"}\n')
    main([*base, "--replies", str(files / "r.json")], spark)
    assert "[FLAG: API error: down]" in (files / "c.flagged.txt").read_text(encoding="utf-8")
    assert "Flagged for review: 1 (25%)" in capsys.readouterr().out


def test_errors(spark, files, monkeypatch):
    monkeypatch.delenv("CUEFORGE_API_KEY", raising=False)
    with pytest.raises(SystemExit):
        main(["fix", "absent.srt", "--reference", "x", "--output", "y"], spark)
    with pytest.raises(SystemExit):
        main(["transcribe", str(files / "absent.mp4"), "--provider", "x:y"], spark)
    with pytest.raises(SystemExit):
        main(["compare", "one"], spark)


def test_transcribe(spark, files, monkeypatch):
    (files / "provider_for_test.py").write_text("from cueforge.operators.providers import ClipTranscriber\ndef make(model):\n    return ClipTranscriber(None, lambda p: [{'start': 0, 'end': 1, 'text': model}])\n")
    monkeypatch.syspath_prepend(str(files))
    spark.sparkContext.addPyFile(str(files / "provider_for_test.py"))
    (files / "v.mp4").write_bytes(b"")
    main(["transcribe", str(files / "v.mp4"), "--provider", "provider_for_test:make", "--model", "tiny"], spark)
    assert (files / "v.srt").read_text() == "1\n00:00:00,000 --> 00:00:01,000\ntiny\n"
    sys.modules.pop("provider_for_test", None)
