"""Model replies: strict JSON with fallbacks, and fixes applied to texts.

Replies are a table to join, not calls to make. Decoding follows the JSON grammar to the last character, which
the built-in readers don't (they take trailing text, wrap single objects and turn numbers into strings), so it runs on
Arrow batches; everything else is column functions.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.strings import col, replace_first, strip, without_fences, without_reasoning
from .phonetic import Readings, is_homophone, syllable_map

CORRECTION = "corrected string, confidence double, notes string, status string, error string, number string"
FIXES = "array<struct<wrong:string,correct:string,wrong_bad:boolean,correct_bad:boolean>>"
LOW_CONFIDENCE = 0.75
TEXT_CONFIDENCE = 0.7


def _text(v) -> str | None:
    return v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)


def _correction(raw: str | None) -> dict:
    """status: json, text (not JSON: use the reply itself) or error (JSON that isn't a correction). number: a low confidence as text."""
    none = {"corrected": None, "confidence": None, "notes": None, "status": "text", "error": None, "number": None}
    try:
        got = json.loads(raw or "")
    except ValueError:
        return none
    try:
        # a missing key has a default, an explicit null confidence has not
        corrected = got["corrected"] if "corrected" in got else "\0"
        confidence = float(got.get("confidence", 1.0))
        # the number is written for flagged rows alone, rounded as binary floating point is
        number = f"{confidence:.2f}" if confidence < LOW_CONFIDENCE else None
        return {"corrected": _text(corrected), "confidence": confidence, "notes": _text(got.get("notes", "")), "status": "json", "error": None, "number": number}
    except Exception as e:
        return none | {"status": "error", "error": str(e)}


def _corrections(raw: Column) -> Column:
    @F.pandas_udf(CORRECTION)
    def run(raw: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_correction(r) for r in raw], columns=["corrected", "confidence", "notes", "status", "error", "number"])

    return run.asNondeterministic()(raw)


def parse_correction(raw: Column | str, noisy: Column | str, call_error: Column | None = None) -> Column:
    """struct<corrected, confidence, flagged, flag_reason> of a reply that should be a correction object.

    No JSON: the reply itself (noisy if it is empty), confidence 0.7, no flag. JSON of another form, or a call_error:
    noisy, 0, flagged with the error. Confidence under 0.75: flagged with the notes or the number.
    """
    raw, noisy = without_fences(strip(F.coalesce(col(raw), F.lit("")))), col(noisy)

    def read(p: Column) -> Column:
        failed = p["status"] == "error"
        error = p["error"]
        if call_error is not None:
            error, failed = F.coalesce(call_error, error), call_error.isNotNull() | failed
        low = (p["status"] == "json") & (p["confidence"] < LOW_CONFIDENCE)
        said = F.when(p["notes"].isNotNull() & (p["notes"] != ""), p["notes"]).otherwise(F.concat(F.lit("Low confidence ("), p["number"], F.lit(")")))
        return F.struct(
            F.when(failed, noisy).when(p["status"] == "text", F.when(raw != "", raw).otherwise(noisy)).when(p["corrected"] == "\0", noisy).otherwise(p["corrected"]).alias("corrected"),
            F.when(failed, 0.0).when(p["status"] == "text", TEXT_CONFIDENCE).otherwise(p["confidence"]).alias("confidence"),
            (failed | low).alias("flagged"),
            F.when(failed, F.concat(F.lit("API error: "), error)).when(low, said).otherwise("").alias("flag_reason"),
        )

    # by way of a list of one: a UDF's result that is named in many places of an expression is made anew for each
    return F.transform(F.array(_corrections(raw)), read)[0]


def _fix_list(raw: str | None) -> list[dict]:
    try:
        got = json.loads(raw or "")
    except ValueError:
        return []
    out = []
    for f in got if isinstance(got, list) else []:
        if isinstance(f, dict) and (w := f.get("wrong", "")) and (c := f.get("correct", "")):
            out.append({"wrong": _text(w), "correct": _text(c), "wrong_bad": not isinstance(w, str), "correct_bad": not isinstance(c, (str, list, dict))})
    return out


def _fix_lists(raw: Column) -> Column:
    @F.pandas_udf(FIXES)
    def run(raw: pd.Series) -> pd.Series:
        return pd.Series([_fix_list(r) for r in raw])

    # as in alignment.align_subs
    return run.asNondeterministic()(raw)


def parse_fixes(raw: Column | str) -> Column:
    """FIXES of a reply that should be a list of {wrong, correct}: what is no list is empty, what is no object is left out,
    and so are objects with an empty value. The bad marks tell values that are no text."""
    return _fix_lists(without_fences(without_reasoning(F.coalesce(col(raw), F.lit("")))))


def _heard(fixes: Column, syllables: Column | Readings | None) -> Column:
    """fixes with ok: whether the two texts sound alike. With Readings on Arrow batches, else by column functions."""
    if isinstance(syllables, Readings):

        @F.pandas_udf(FIXES[:-2] + ",ok:boolean>>")
        def run(fixes: pd.Series) -> pd.Series:
            return pd.Series([None if own is None else [{**f, "ok": syllables.alike(f["wrong"], f["correct"])} for f in own] for own in fixes])

        return run.asNondeterministic()(fixes)
    table = syllable_map() if syllables is None else syllables
    return F.transform(fixes, lambda f: F.struct(f["wrong"].alias("wrong"), f["correct"].alias("correct"), f["wrong_bad"].alias("wrong_bad"), f["correct_bad"].alias("correct_bad"), is_homophone(f["wrong"], f["correct"], table).alias("ok")))


def apply_fixes(text: Column | str, fixes: Column | str, syllables: Column | Readings | None = None) -> Column:
    """struct<text, failed>: a left fold over the fixes, each against what the ones before made.

    A fix counts if its wrong text is there, is as long as the correct one, and sounds like it; the leftmost place changes.
    failed tells that a value that is no text was met, for which the whole cue goes back.
    """
    checked = _heard(col(fixes), syllables)
    state = lambda t, failed: F.struct(t.alias("text"), failed.alias("failed"))

    def step(s: Column, f: Column) -> Column:
        there = F.position(f["wrong"], s["text"]) > 0
        bad = f["wrong_bad"] | (there & f["correct_bad"])
        use = ~bad & there & f["ok"]
        return F.when(s["failed"], s).otherwise(state(F.when(use, replace_first(s["text"], f["wrong"], f["correct"])).otherwise(s["text"]), bad))

    return F.aggregate(checked, state(col(text), F.lit(False)), step)


def rejected_fixes(text: Column | str, fixes: Column | str, syllables: Column | Readings | None = None) -> Column:
    """The fixes whose wrong text is in text, with equal lengths, that don't sound alike."""
    t = col(text)
    return F.filter(_heard(col(fixes), syllables), lambda f: (F.position(f["wrong"], t) > 0) & (F.length(f["wrong"]) == F.length(f["correct"])) & ~f["ok"])
