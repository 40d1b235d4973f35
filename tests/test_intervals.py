"""Interval joins against brute force."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cueforge.operators.intervals import align_overlap, nearest_refs, overlap_ms, pairs, with_nearest

CUES = "file_id string, ordinal int, start_ms long, end_ms long, text string"


def cues(spark, rows):
    return spark.createDataFrame(rows, CUES)


def overlap(a, b):
    return max(0, min(a[3], b[3]) - max(a[2], b[2]))


def distance(a, b):
    return min(abs(a[2] - b[3]), abs(a[3] - b[2]))


def random_rows(rng, n, longest, kind):
    rows = []
    for k in range(n):
        s = rng.randrange(-500, 60_000)
        length = rng.choice([0, rng.randrange(1, 3000), rng.randrange(1, longest), -rng.randrange(1, 2000)])
        rows.append((rng.choice("fg"), k + 1, s, s + length, f"{kind}{k}"))
    return rows


@pytest.mark.parametrize(("window", "bin_ms", "longest"), [(0, 1000, 5000), (5000, 10_000, 5000), (700, 50, 50_000), (0, 1, 3_000)])
def test_pairs(spark, window, bin_ms, longest):
    rng = random.Random(window + bin_ms)
    a, b = random_rows(rng, 80, longest, "a"), random_rows(rng, 80, longest, "b")
    want = sorted((x[0], x[1], y[1]) for x in a for y in b if x[0] == y[0] and (overlap(x, y) > 0 or window and distance(x, y) <= window))
    got = pairs(cues(spark, a), cues(spark, b), window, bin_ms).select("file_id", "ordinal", "r_ordinal").collect()
    assert sorted(map(tuple, got)) == want


def test_align(spark):
    a = [("f", 1, 0, 1000, "x"), ("f", 2, 1000, 1000, "zero"), ("f", 3, 2000, 1500, "reversed"), ("f", 4, 900, 5000, "y"), ("g", 1, 0, 10, "alone")]
    b = [("f", 1, 500, 1000, "b1"), ("f", 2, 1000, 2000, ""), ("f", 3, 400, 600, "b3"), ("f", 4, 5000, 6000, "touches"), ("h", 1, 0, 10, "other")]
    got = {(r["file_id"], r["ordinal"]): r["ref"] for r in align_overlap(cues(spark, a), cues(spark, b)).collect()}
    assert got == {("f", 1): "b1 b3", ("f", 2): "", ("f", 3): "", ("f", 4): "b1 ", ("g", 1): ""}


def test_align_strict_order_stops_at_the_first_later_reference(spark):
    a = [("f", 1, 0, 1000, "x"), ("f", 2, 3000, 4000, "y")]
    b = [("f", 1, 0, 500, "b1"), ("f", 2, 2000, 3500, "b2"), ("f", 3, 600, 900, "late")]
    loose = {r["ordinal"]: r["ref"] for r in align_overlap(cues(spark, a), cues(spark, b)).collect()}
    strict = {r["ordinal"]: r["ref"] for r in align_overlap(cues(spark, a), cues(spark, b), strict_order=True).collect()}
    assert loose == {1: "b1 late", 2: "b2"} and strict == {1: "b1", 2: "b2"}


@pytest.mark.parametrize("n", [0, 1, 5])
def test_nearest(spark, n):
    rng = random.Random(n)
    a, b = random_rows(rng, 60, 4000, "a"), random_rows(rng, 60, 4000, "b")
    want = {}
    for x in a:
        scored = []
        for y in b:
            if x[0] == y[0]:
                if (o := overlap(x, y)) > 0:
                    scored.append((-o, y[1]))
                elif distance(x, y) <= 5000:
                    scored.append((distance(x, y), y[1]))
        want[x[0], x[1]] = sorted(scored)[:n]
    got = {(r["file_id"], r["ordinal"]): [(m["neg_score"], m["ref_ordinal"]) for m in r["refs"]] for r in with_nearest(cues(spark, a), cues(spark, b), n).collect()}
    assert got == want


def test_nearest_edges(spark):
    a = [("f", 1, 10_000, 11_000, "x")]
    b = [("f", 1, 16_000, 17_000, "5000 off"), ("f", 2, 16_001, 17_000, "5001 off"), ("f", 3, 11_000, 12_000, "touches"), ("f", 4, 9000, 10_000, "touches too")]
    got = [(r["r_ordinal"], r["score"]) for r in nearest_refs(cues(spark, a), cues(spark, b)).orderBy("place").collect()]
    assert got == [(3, 0), (4, 0), (1, -5000)]
    with pytest.raises(ValueError):
        nearest_refs(cues(spark, a), cues(spark, b), n=-1)


def test_empty_tables(spark):
    none, one = cues(spark, []), cues(spark, [("f", 1, 0, 1, "x")])
    assert align_overlap(none, one).count() == 0 and nearest_refs(none, one).count() == 0
    assert align_overlap(one, none).first()["ref"] == "" and with_nearest(one, none).first()["refs"] == []


def test_no_pairwise_plan(spark):
    plan = align_overlap(cues(spark, [("f", 1, 0, 1, "x")]), cues(spark, [("f", 1, 0, 1, "x")]))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-50, 50), st.integers(-50, 50), st.integers(-50, 50), st.integers(-50, 50)), min_size=1, max_size=30))
def test_overlap_is_symmetric_and_bounded(spark, rows):
    df = spark.createDataFrame(rows, "a long, b long, c long, d long")
    got = df.select("*", overlap_ms("a", "b", "c", "d").alias("x"), overlap_ms("c", "d", "a", "b").alias("y"), F.greatest(F.lit(0), F.col("b") - F.col("a")).alias("most")).collect()
    assert all(r["x"] == r["y"] == max(0, min(r["b"], r["d"]) - max(r["a"], r["c"])) and r["x"] <= r["most"] for r in got)
