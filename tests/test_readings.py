"""Readings with phrases, small cases of the fix pipeline, provider pacing, the key file, and references out of order."""

import io
import json
import random

import pytest
from pyspark.sql import functions as F

from cueforge.functions.strings import apply_substitutions, normalise_pairs
from cueforge.operators import providers
from cueforge.operators.alignment import align_subs
from cueforge.operators.intervals import align_overlap, first_later
from cueforge.operators.phonetic import SYLLABLES, Readings, is_homophone, phrase_syllables, readings, syllable_map
from cueforge.operators.replies import apply_fixes, parse_correction, parse_fixes, rejected_fixes
from cueforge.plans import cli, pipelines
from cueforge.plans.queries import ODD_FILE
from cueforge.sources.readings import collected, read, read_readings
from cueforge.sources.srt import parse_cues


def test_loaded_readings(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("# table\n行\txing\n銀\tyin\n銀行\tyin hang\n行家\thang jia\n杭\thang\n\nno tab\n家\tjia\n銀\tzyin\n", encoding="utf-8")
    own = read(spark, str(tmp_path / "r.tsv"))
    assert own.of("銀行家行,ab 銀") == ["yin", "hang", "jia", "xing", ",ab ", "yin"] and own.of("行家") == ["hang", "jia"] and own.of("") == []
    read_readings(spark, str(tmp_path / "r.tsv")).write.parquet(str(tmp_path / "r.parquet"))
    assert read(spark, str(tmp_path / "r.parquet")).of("銀行") == ["yin", "hang"]
    with pytest.raises(ValueError):
        collected(read_readings(spark, str(tmp_path / "r.tsv")), most=3)
    # in the phrase 行 sounds like 杭, alone it does not
    rows = spark.createDataFrame([("銀行", "銀杭"), ("行", "杭"), (None, "x"), ("銀行", "銀行")], "w string, c string")
    assert [r[0] for r in rows.select(is_homophone("w", "c", own)).collect()] == [True, False, False, False]
    fixes = spark.createDataFrame([("去銀行", '[{"wrong": "銀行", "correct": "銀杭"}, {"wrong": "去", "correct": "家"}]')], "text string, raw string").withColumn("f", parse_fixes("raw"))
    r = fixes.select(apply_fixes("text", "f", own).alias("a"), rejected_fixes("text", "f", own).alias("b")).first()
    assert r["a"]["text"] == "去銀杭" and not r["a"]["failed"] and [x["wrong"] for x in r["b"]] == ["去"]


def test_readings_are_the_column_functions(spark):
    rng = random.Random(1)
    chars = [*list(SYLLABLES)[:40], "a", " ", "！", "龘", "々"]
    texts = [None, ""] + ["".join(rng.choice(chars) for _ in range(rng.randint(1, 9))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(phrase_syllables("t", Readings(SYLLABLES)).alias("a"), readings("t", syllable_map()).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)
    pairs = [("".join(rng.choice(chars) for _ in range(n)), "".join(rng.choice(chars) for _ in range(n))) for n in (1, 2) for _ in range(300)]
    both = spark.createDataFrame(pairs, "w string, c string").select(is_homophone("w", "c").alias("a"), is_homophone("w", "c", Readings(SYLLABLES)).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in both) and any(r["a"] for r in both)


@pytest.mark.parametrize(
    ("text", "raw", "want", "failed"),
    [("他他是", '[{"wrong": "他", "correct": "它"}]', "它他是", False), ("是鐘", '[{"wrong": "是鐘", "correct": "時中"}, {"wrong": "時", "correct": "是"}]', "是中", False), ("他", '[{"wrong": "山", "correct": "身"}]', "他", False), ("他", '[{"wrong": "他", "correct": "它們"}]', "他", False), ("他", '[{"wrong": 5, "correct": "它"}]', "他", True)],
)
def test_fixes_in_turn(spark, text, raw, want, failed):
    r = spark.createDataFrame([(text, raw)], "text string, raw string").select(apply_fixes("text", parse_fixes("raw")).alias("f")).first()["f"]
    assert (r["text"], r["failed"]) == (want, failed)


@pytest.mark.parametrize(("text", "refs", "subs", "want"), [("是鐘時代", "時中時代", "鐘>中,是>時", "時中時代"), ("他在 那裡", "它在，那裡", "他>它", "它在 那裡"), ("abcdef", "uvwxyz", "", "abcdef"), ("", "它", "", ""), ("新心新", "星心新", "新>星", "星心新")])
def test_aligned_substitutions(spark, text, refs, subs, want):
    r = spark.createDataFrame([(text, refs)], "t string, r string").withColumn("s", align_subs("t", "r")).select("s", apply_substitutions("t", "s").alias("f")).first()
    assert ",".join(f"{x['wrong']}>{x['correct']}" for x in r["s"]) == subs and r["f"] == want


def test_pairs_and_replies(spark):
    rows = spark.createDataFrame([("他在他", "它"), ("它", "他"), ("他", "他它"), ("她", "它")], "t string, r string")
    assert [r[0] for r in rows.select(normalise_pairs("t", "r")).collect()] == ["它在它", "他", "他", "她"]
    raw = ['```json\n{"corrected": "好", "confidence": 0.9}\n```', '{"corrected": "好", "confidence": 0.5}', '{"corrected": "好", "confidence": 0.7499, "notes": "unsure"}', '{"corrected": "好", "confidence": 0.75}', '{"corrected": "好", "confidence": "0.8"}', '{"confidence": 1}', "  ", '{"corrected": "好"} and more']
    got = spark.createDataFrame([(x,) for x in raw], "raw string").select(parse_correction("raw", F.lit("noisy")).alias("p")).select("p.*").collect()
    assert [tuple(r) for r in got] == [("好", 0.9, False, ""), ("好", 0.5, True, "Low confidence (0.50)"), ("好", 0.7499, True, "unsure"), ("好", 0.75, False, ""), ("好", 0.8, False, ""), ("noisy", 1.0, False, ""), ("noisy", 0.7, False, ""), ('{"corrected": "好"} and more', 0.7, False, "")]


def test_a_small_track_is_fixed(spark):
    cue = lambda rows: spark.createDataFrame([("f", k, k, s, e, t) for k, s, e, t in rows], "file_id string, ordinal int, index long, start_ms long, end_ms long, text string")
    cues, refs = cue([(1, 0, 1000, "他說是鐘"), (2, 15000, 16000, "問花級"), (3, 9000, 9500, "他在"), (4, 30000, 31000, "失敗他")]), cue([(1, 0, 900, "它說時中"), (2, 14900, 16100, "問花紙"), (3, 8000, 8900, "它在!!!"), (4, 9600, 9900, "它在")])
    replies = spark.createDataFrame([("f", 1, '[{"wrong": "是鐘", "correct": "時中"}]', None), ("f", 2, "no list", None), ("f", 3, "[]", None), ("f", 4, None, "timeout")], "file_id string, ordinal int, raw string, error string")
    for table in (None, Readings(SYLLABLES)):
        out = pipelines.fix(cues, refs, replies, syllables=table)
        assert {r["ordinal"]: (r["new"], r["changed"]) for r in out.collect()} == {1: ("它說時中", True), 2: ("問花紙", True), 3: ("它在", True), 4: ("失敗他", False)}


def test_odd_file(spark):
    got = parse_cues(spark.createDataFrame([("odd", ODD_FILE)], "file_id string, value string"))
    assert [tuple(r) for r in got.select("ordinal", "index", "start_ms", "end_ms", "text").orderBy("ordinal").collect()] == [(1, 1, 1000, 2500, "First line second line"), (2, 2, 3000, 4000, " lean text"), (3, 6, 11000, 12000, ""), (4, 10, 3600007, 3599000, "1984")]


def test_calls_are_paced_between_not_after(monkeypatch):
    slept, sent = [], []
    monkeypatch.setattr(providers.time, "sleep", slept.append)

    def opened(request, timeout):
        sent.append((request.full_url, json.loads(request.data), request.headers["Authorization"], timeout))
        return io.StringIO(json.dumps({"choices": [{"message": {"content": " [] "}}]}))

    monkeypatch.setattr(providers.urllib.request, "urlopen", opened)
    model = providers.HttpCorrector("http://localhost/x", "m", "k", delay=0.25)
    assert [model.complete([{"role": "user", "content": "a"}]) for _ in range(3)] == ["[]"] * 3 and slept == [0.25, 0.25]
    url, body, key, timeout = sent[0]
    assert (url, key, timeout) == ("http://localhost/x", "Bearer k", 30.0) and body == {"model": "m", "max_tokens": 300, "temperature": 0.0, "messages": [{"role": "user", "content": "a"}]}
    assert providers.HttpCorrector("http://localhost/x", "m", "k", delay=0).complete([]) == "[]" and len(slept) == 2


def test_key_of_the_env_file(tmp_path, monkeypatch):
    monkeypatch.delenv(cli.KEY, raising=False)
    args = cli.parser().parse_args(["fix", "in.srt", "--reference", "r", "--output", "o"])
    assert cli.api_key(args, str(tmp_path)) is None
    (tmp_path / ".env").write_text(f"# keys\nOTHER=1\nexport {cli.KEY} = 'abc'\n")
    assert cli.api_key(args, str(tmp_path)) == "abc"
    monkeypatch.setenv(cli.KEY, "env")
    assert cli.api_key(args, str(tmp_path)) == "env"
    args.api_key = "given"
    assert cli.api_key(args, str(tmp_path)) == "given" and args.ref_count == 5 and args.delay == 0.3


@pytest.mark.parametrize("bin_ms", [50, 60_000])
def test_first_later_reference(spark, bin_ms):
    rng = random.Random(2)
    cues = [(f"f{k % 2}", k, (s := rng.randrange(2000)), s + rng.randrange(-5, 60), "c") for k in range(60)]
    refs = [(f"f{k % 2}", k, (s := rng.randrange(2000)), s + rng.randrange(-5, 60), f"r{k}") for k in range(60)]
    schema = "file_id string, ordinal int, start_ms long, end_ms long, text string"
    a, b = spark.createDataFrame(cues, schema), spark.createDataFrame(refs, schema)
    got = {(r["file_id"], r["ordinal"]): r["stop"] for r in first_later(a, b, bin_ms).collect()}
    want = {c[:2]: min((r[1] for r in refs if r[0] == c[0] and r[3] >= r[2] and r[2] > c[3]), default=None) for c in cues}
    assert got == want
    strict = {(r["file_id"], r["ordinal"]): r["ref"] for r in align_overlap(a, b, strict_order=True).collect()}
    for c in cues:
        texts = []
        for r in refs:
            if r[0] == c[0]:
                if r[3] >= r[2] and r[2] > c[3]:
                    break
                if min(c[3], r[3]) - max(c[2], r[2]) > 0:
                    texts.append(r[4])
        assert strict[c[:2]] == " ".join(texts)


def test_short_intervals_never_meet_in_wide_bins(spark):
    """Candidates of a long file grow with its cues, not with their square; a few very long cues don't change that."""
    from cueforge.operators.intervals import _binned, pairs

    n = 2000
    rows = spark.range(n).select(F.lit("f").alias("file_id"), F.col("id").cast("int").alias("ordinal"), (F.col("id") * 1000).alias("start_ms"), (F.col("id") * 1000 + F.when(F.col("id") % 500 == 7, 5_000_000).otherwise(900)).alias("end_ms"), F.lit("t").alias("text"))
    lo, hi = F.col("start_ms"), F.col("end_ms")
    left = _binned(rows, lo, hi, 10_000, "a", "b").select("ordinal", "at.level", "at.bin", "at.turn")
    right = _binned(rows, lo, hi, 10_000, "ab", "a").select(F.col("ordinal").alias("r"), "at.level", "at.bin", "at.turn")
    assert left.join(right, ["level", "bin", "turn"]).count() < 60 * n
    got = pairs(rows, rows.withColumn("start_ms", lo + 500).withColumn("end_ms", hi + 500))
    long = [k for k in range(n) if k % 500 == 7]
    spans = [(k * 1000, k * 1000 + (5_000_000 if k % 500 == 7 else 900)) for k in range(n)]
    want = sum(min(b, d + 500) - max(a, c + 500) > 0 for k, (a, b) in enumerate(spans) for c, d in (spans if k in long else [spans[j] for j in {*range(max(0, k - 2), min(n, k + 2)), *long}]))
    assert got.count() == want
