"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the k least distinct hashes of a text's shingles (five words; a shorter text is one shingle, a text without
words has none). Sketches of parts merge by keeping the k least of both, and estimate resemblance, containment and the
number of distinct shingles. Written as base64 of big-endian 64-bit values, ascending.

Null texts are empty. Two empty sketches have likeness 1, an empty and a filled one 0. Repeated doc_ids follow the hash of
their text, a null doc_id comes last in descending order. Each row gives its row; an empty table none, and a single row is followed by
itself. Very long texts are taken whole. Other columns are not looked at, whatever their names. Rows of one doc_id, or of none, are cut by the
hash of their text, so only equal rows have to stay in one task, which holds two of them at a time.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import HOT, buffers, shuffle_count, slices, span_hashes, text_frame, windows, words

K = 128
WIDTH = 5
SPREAD = 64


def sketches(texts: pa.Array, k: int = K, width: int = WIDTH) -> list[np.ndarray]:
    """A sketch of each text."""
    buf, off = buffers(texts)
    s, e, at = words(buf, off)
    h = span_hashes(buf, s, e)
    wide = windows(h, width)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            own = wide[a : b - width + 1]
        elif b > a:
            own = windows(h[a:b], b - a)
        else:
            own = h[:0]
        out.append(np.unique(own)[:k])
    return out


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = merge(a, b, k)
    shared = np.intersect1d(a, b, assume_unique=True)
    return float((shared <= both[-1]).sum()) / len(both)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    r, n = resemblance(a, b, k), distinct(a, k)
    return min(1.0, r * distinct(merge(a, b, k), k) / n) if n else 1.0


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def decode(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


def fingerprints(df: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """doc_id, fingerprint and estimated distinct shingles of each row."""

    def run(batches):
        for part in slices(batches):
            own = sketches(part.column(1), k, width)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "fingerprint": pa.array([encode(a) for a in own], pa.string()), "n_distinct": pa.array([distinct(a, k) for a in own], pa.float64())})

    return text_frame(df).mapInArrow(run, "doc_id long, fingerprint string, n_distinct double")


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, after: str) -> str:
    n = len(text) // 3
    return text[: len(text) - n] + after[:n] if n else text


def compared(ids: list, texts: list[str], following: list[str], k: int, width: int, own=None, ahead=None) -> pa.RecordBatch:
    """OUT rows of texts against their edits and the texts that follow them."""
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    own = own if own is not None else sketches(pa.array(texts, pa.large_string()), k, width)
    ahead = ahead if ahead is not None else sketches(pa.array(following, pa.large_string()), k, width)
    new = sketches(pa.array(changed, pa.large_string()), k, width)
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        "fingerprint": pa.array([encode(a) for a in own], pa.string()), "edited_fingerprint": pa.array([encode(a) for a in new], pa.string()),
        "near_edited": pa.array([resemblance(a, b, k) for a, b in zip(own, new, strict=True)], pa.float64()),
        "near_next": pa.array([resemblance(a, b, k) for a, b in zip(own, ahead, strict=True)], pa.float64()),
    })


def parted(df: DataFrame, column: str, tie: str, parts: int) -> DataFrame:
    """df with part: a number that grows with column and, within one value, falls with tie; nulls have the least parts.

    Each part is about as large: bounds are quantiles, and a value that more than one in HOT of all rows has, or null, is a part of its own,
    cut into SPREAD by tie. The driver holds these bounds and values (fewer than HOT; those beyond 2**53 are not cut), and a row's part
    depends on nothing but its own values: a task that runs again, or a plan that deals the rows out twice, puts it in the same place.
    """
    from pyspark.ml.feature import Bucketizer  # here, as workers that import this module have no use for it

    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = df.count()
    hot = [r[0] for r in counts.filter(F.col("n") > total / HOT).filter(F.col(column).isNotNull() & (F.abs(column) < 1 << 53)).collect()]
    found = df.approxQuantile(column, [k / parts for k in range(1, parts)], 0.25 / parts) if parts > 1 else []
    splits = [-float("inf"), *sorted({*found, *map(float, hot), *(float(h + 1) for h in hot)}), float("inf")]
    value = df.withColumn("_value", F.coalesce(F.col(column).cast("double"), F.lit(0.0)))
    cut = Bucketizer(splits=splits, inputCol="_value", outputCol="_part").transform(value) if len(splits) > 2 else value.withColumn("_part", F.lit(0.0))
    turn = F.lit(SPREAD - 1) - F.floor((F.col(tie).cast("double") + 2.0**63) / 2.0**64 * SPREAD).cast("long")
    turn = F.greatest(F.lit(0).cast("long"), turn)
    own = F.col(column).isNull() | (F.col(column).isin(hot) if hot else F.lit(False))
    # never null, also to the planner: a filter for it would keep plans from sharing one exchange
    number = F.coalesce(F.when(F.col(column).isNotNull(), F.col("_part").cast("long")), F.lit(-1).cast("long"))
    return cut.withColumn("part", number * SPREAD + F.when(F.coalesce(own, F.lit(True)), turn).otherwise(F.lit(0).cast("long"))).drop("_value", "_part")


def op6(df: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """Each row against its edited text and the next row in descending doc_id (after the last: the first).

    One exchange deals the rows to parts of neighbouring doc_ids; a task pairs each row of a part with the next as it
    streams. Only the last row of a part needs the first row of the next: these boundary rows, two a part, are joined.
    """
    rows = text_frame(df).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("tie", F.xxhash64("text"))
    n = shuffle_count(df.sparkSession)
    dealt = parted(rows, "doc_id", "tie", 4 * n).repartition(n, "part")

    def run(batches):
        held = None
        for batch in slices(batches, 1 << 20):
            ids, texts, parts = (batch.column(i).to_pylist() for i in (0, 1, 3))
            own = sketches(batch.column(1), k, width)
            if held:
                ids, texts, parts, own = ([h, *x] for h, x in zip(held, (ids, texts, parts, own), strict=True))
            held = ids[-1], texts[-1], parts[-1], own[-1]
            at = [i for i in range(len(ids) - 1) if parts[i] == parts[i + 1]]
            if at:
                yield compared([ids[i] for i in at], [texts[i] for i in at], [texts[i + 1] for i in at], k, width, [own[i] for i in at], [own[i + 1] for i in at])

    inner = dealt.sortWithinPartitions("part", F.desc_nulls_last("doc_id"), F.asc("tie")).mapInArrow(run, OUT)

    # a part's first and last row, in the same order: descending doc_id, then ascending tie
    rank = F.struct(F.coalesce(F.col("doc_id"), F.lit(0)).alias("a"), F.expr("-1 - tie").alias("b"))
    row = F.struct("doc_id", "text")
    edges = dealt.groupBy("part").agg(F.max_by(row, rank).alias("head"), F.min_by(row, rank).alias("tail"))
    places = edges.select("part")
    ordered = W.orderBy(F.desc("part"))  # one row a part
    after = places.select("part", F.coalesce(F.lead("part").over(ordered), F.first("part").over(ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("next_part"))
    pairs = edges.select("part", "tail").join(after, "part").join(edges.select(F.col("part").alias("next_part"), "head"), "next_part")

    def last(batches):
        for batch in slices(batches, 1 << 20):
            if batch.num_rows:
                ids, texts, following = (batch.column(i).to_pylist() for i in range(3))
                yield compared(ids, texts, following, k, width)

    outer = pairs.select("tail.doc_id", "tail.text", F.col("head.text").alias("following")).mapInArrow(last, OUT)
    return inner.unionByName(outer)
