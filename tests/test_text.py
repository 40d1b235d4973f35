"""Strings, phonetics, alignment, replies, flags and prompts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cueforge.functions.numbers import fixed
from cueforge.functions.strings import apply_substitutions, cleaned, first_of, latin_runs, normalise_pairs, normalized_levenshtein, strip, without_fences, without_reasoning
from cueforge.operators.alignment import edit_steps, similar, substitutions
from cueforge.operators.context import with_context
from cueforge.operators.filters import clean_refs
from cueforge.operators.phonetic import is_homophone, similar_syllables
from cueforge.operators.prompts import hint, messages
from cueforge.operators.quality import run_summary, with_flags
from cueforge.operators.replies import apply_fixes, parse_correction, parse_fixes, rejected_fixes


def value(spark, *cols):
    row = spark.range(1).select(*cols).first()
    return row[0] if len(cols) == 1 else tuple(row)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_strings(spark):
    s = lambda x: strip(F.lit(x))
    assert value(spark, s(" \t　a b\x1c "), s("　"), s("")) == ("a b", "", "")
    assert value(spark, cleaned(F.lit("他 說，。、！？「」…⋯-（）()：,!?\"~　好"))) == "他說,!?\"~好"
    assert value(spark, first_of(F.lit(""), F.lit(None).cast("string"), F.lit("x"), F.lit("y")), first_of(F.lit(""), F.lit(""))) == ("x", "")
    assert value(spark, latin_runs(F.lit("ab abc 好DEFg1hij"))) == ["abc", "DEFg", "hij"]
    assert value(spark, without_fences(F.lit("```json\n{}\n```")), without_fences(F.lit("x"))) == ("{}", "x")
    assert value(spark, without_reasoning(F.lit("<think>a\nb</think> x <think>c</think>"))) == "x"


def test_distance(spark):
    d = lambda a, b: normalized_levenshtein(F.lit(a), F.lit(b))
    assert value(spark, d("", ""), d("a", ""), d("", "a"), d("時中😀", "是鐘😀"), d("abc", "abd")) == (0.0, 1.0, 1.0, 2 / 3, 1 / 3)


def test_exact_rounding(spark):
    assert value(spark, fixed(F.lit(0.25), 1), fixed(F.lit(0.35), 1), fixed(F.lit(2.55), 1), fixed(F.lit(0.125), 0, percent=True)) == ("0.2", "0.3", "2.5", "12%")


def test_substitution_fold(spark):
    subs = lambda *p: F.array(*[F.struct(F.lit(a).alias("wrong"), F.lit(b).alias("correct")) for a, b in p])
    a = lambda t, *p: apply_substitutions(F.lit(t), subs(*p))
    assert value(spark, a("aab", ("a", "x"), ("a", "y")), a("ab", ("a", "b"), ("b", "c")), a("ab", ("z", "q")), a("", ("a", "b"))) == ("xyb", "cb", "ab", "")


def test_pairs(spark):
    n = lambda t, r: normalise_pairs(F.lit(t), F.lit(r))
    assert value(spark, n("他和他", "它"), n("他", "他它"), n("它", "他"), n("他它", "它")) == ("它和它", "他", "他", "它它")


def test_similarity_of_syllables(spark):
    some = "zhang zang jang chang cang ang an n l lin nin er e ei yi wu wo ge ke".split()
    got = spark.createDataFrame([(a, b) for a in some for b in some], "a string, b string").select("a", "b", similar_syllables("a", "b").alias("s")).collect()
    assert all(r["s"] == similar(r["a"], r["b"]) for r in got)
    pairs = {(r["a"], r["b"]): r["s"] for r in got}
    assert pairs["zhang", "zang"] and pairs["an", "ang"] and pairs["lin", "nin"] and not pairs["zhang", "an"] and not pairs["ang", "zang"]


def test_homophones(spark):
    h = lambda a, b: is_homophone(F.lit(a), F.lit(b))
    assert value(spark, h("是鐘", "時中"), h("他", "他"), h("他們", "它"), h("山", "文"), h("他ab", "它ab"), h("abc", "abd")) == (True, False, False, False, True, False)


@pytest.mark.parametrize("seed", range(40))
def test_alignment_costs_are_edit_distances(seed):
    rng = random.Random(seed)
    a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(2))
    steps = list(edit_steps(a, b))
    used = [sum(x is not None for x, _ in steps), sum(y is not None for _, y in steps)]
    rest = len(a) - used[0] + len(b) - used[1]  # what is left of one side
    assert sum(x != y for x, y in steps) + rest == levenshtein(a, b)


def test_alignment_rules():
    same = dict(zip("abcd", ["ta", "ta", "shi", "si"]))
    assert substitutions("xxab", "xxba", same) == [{"wrong": "b", "correct": "a"}, {"wrong": "a", "correct": "b"}]
    assert substitutions("axxx", "byyy", same) == [] and substitutions("", "a", same) == [] and substitutions("cxx", "dxx", same) == [{"wrong": "c", "correct": "d"}]


def test_corrections(spark):
    p = lambda raw, err=None: parse_correction(F.lit(raw), F.lit("n"), F.lit(err).cast("string"))
    rows = [tuple(value(spark, p(*x))) for x in [('{"corrected": null}',), ('{"corrected": "a", "confidence": null}',), ("[1]",), ('{"corrected": "a", "confidence": "x"}',), (None, "timeout"), ('{"corrected": "a", "confidence": 0.5, "notes": ""}',)]]
    assert rows[0] == (None, 1.0, False, "") and rows[4] == ("n", 0.0, True, "API error: timeout") and rows[5] == ("a", 0.5, True, "Low confidence (0.50)")
    assert all(r[:3] == ("n", 0.0, True) and r[3].startswith("API error: ") for r in rows[1:4])


def test_a_reply_is_decoded_once(spark):
    rows = spark.createDataFrame([("f", 1, '{"confidence": 0.125}', None)], "file_id string, ordinal int, raw string, error string").withColumn("noisy", F.lit("n"))
    out = rows.select(parse_correction("raw", "noisy", F.col("error")).alias("p")).select("p.*")
    assert tuple(out.first()) == ("n", 0.125, True, "Low confidence (0.12)")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and set(re.findall(r"pythonUDF\d+", plan)) == {"pythonUDF0"}


def test_fixes(spark):
    f = lambda t, raw: apply_fixes(F.lit(t), parse_fixes(F.lit(raw)))
    got = [tuple(value(spark, f(*x))) for x in [("他他", '[{"wrong":"他","correct":"它"},{"wrong":"他","correct":"它"}]'), ("他", '[{"wrong":"他","correct":7}]'), ("x", '[{"wrong":"他","correct":7}]'), ("他", '[{"wrong":true,"correct":"它"}]'), ("他", "nope"), ("他", '[["他","它"], null, {"correct":"它"}]')]]
    assert got == [("它它", False), ("他", True), ("x", False), ("他", True), ("他", False), ("他", False)]
    assert [r["wrong"] for r in value(spark, rejected_fixes(F.lit("辛他"), parse_fixes(F.lit('[{"wrong":"辛","correct":"糟"},{"wrong":"他","correct":"它"}]'))))] == ["辛"]


FLAGS = "file_id string, ordinal int, noisy string, ref string, corrected string, confidence double, flagged boolean, flag_reason string"


def test_flags_and_summary(spark):
    rows = [("f", 1, "十個字十個字十個字十", "r", "三個字", 1.0, False, ""), ("f", 2, "十個字十個字十個字十", "", "兩個", 0.5, True, "low"), ("f", 3, "ab", "", "  ", 1.0, False, ""), ("f", 4, "好", "", "好 abc DEF", 1.0, False, ""), ("f", 5, "四個字啊", "", "十個字十個字十個字十", 1.0, True, "before"), ("f", 6, "", "", "", 1.0, False, "")]
    got = {r["ordinal"]: (r["flagged"], r["flag_reason"]) for r in with_flags(spark.createDataFrame(rows, FLAGS)).collect()}
    assert got == {1: (False, ""), 2: (True, "Length ratio suspicious (0.2x)"), 3: (True, "Empty corrected text"), 4: (True, "Unexpected latin text: ['abc', 'DEF']"), 5: (True, "before"), 6: (True, "Empty corrected text")}
    s = run_summary(with_flags(spark.createDataFrame(rows, FLAGS))).first()
    assert (s["total"], s["flagged"], s["no_ref"], s["with_ref"]) == (6, 5, 5, 1) and abs(s["avg_confidence"] - 5.5 / 6) < 1e-12
    none = run_summary(spark.createDataFrame([], FLAGS)).first()
    assert (none["total"], none["avg_confidence"], none["flag_rate"]) == (0, 0.0, None)


@pytest.mark.parametrize("block", [None, 4, 7, 8192])
def test_context(spark, block):
    rows = [(f, k, f"{f}{k}") for f in "fg" for k in range(1, 21)]
    got = {(r["file_id"], r["ordinal"]): r["context"] for r in with_context(spark.createDataFrame(rows, "file_id string, ordinal int, text string"), block=block).collect()}
    assert len(got) == 40
    for f, k, _ in rows:
        assert got[f, k] == [(">>> " if j == k else "    ") + f"{f}{j}" for j in range(max(1, k - 3), min(20, k + 3) + 1)]


def test_clean_refs(spark):
    texts = ["ok", " ", "x" * 60, "x" * 61, "a!!", "a!!!", "a！！！", "!!！！", "12334", "到站台", None]
    kept = [r["text"] for r in clean_refs(spark.createDataFrame([(t,) for t in texts], "text string")).collect()]
    assert kept == ["ok", "x" * 60, "a!!", "!!！！"]


def test_requests(spark):
    assert value(spark, hint(F.lit(""), F.lit("n" * 300))) == "n" * 224
    got = value(spark, messages("be brief", F.lit("hello")))
    assert [(m["role"], m["content"]) for m in got] == [("system", "be brief"), ("user", "hello")]
