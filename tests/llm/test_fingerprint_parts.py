"""Order and parts of operator 6 with hot and missing doc_ids, and its sketches against brute force."""

import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cueforge.llm import common, fingerprint

from .helpers import docs, odd_texts, prose
from .test_operators import WORD


@pytest.mark.parametrize("hot", [3, 1000])
def test_next_documents_of_repeated_ids(spark, hot, monkeypatch):
    monkeypatch.setattr(fingerprint, "HOT", hot)
    rng = random.Random(80)
    texts = [f"{rng.randrange(10**9)} " * rng.randint(1, 9) for _ in range(160)] + ["same text"] * 5
    ids = [rng.choice([7, 7, 7, None, None, k, -k]) for k in range(160)] + [7] * 5
    df = docs(spark, texts, ids)
    tie = {r["text"]: r["h"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(range(len(texts)), key=lambda i: (ids[i] is None, -(ids[i] or 0), tie[texts[i]]))
    want = []
    for at, i in enumerate(order):
        t, nxt = texts[i], texts[order[(at + 1) % len(order)]]
        n = len(t) // 3
        want.append((str(ids[i]), len(t), hashlib.sha256((t[: len(t) - n] + nxt[:n]).encode()).hexdigest()))
    got = [(str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in fingerprint.op6(df).collect()]
    assert sorted(got) == sorted(want)


def test_parts_follow_the_order(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "HOT", 5)
    rng = random.Random(81)
    rows = [(rng.choice([None, 3, 3, 4, 1 << 60, -5, k]), rng.randrange(-(1 << 63), 1 << 63)) for k in range(400)]
    got = fingerprint.parted(spark.createDataFrame(rows, "doc_id long, tie long"), "doc_id", "tie", 6).collect()
    got.sort(key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["tie"]))
    parts = [r["part"] for r in got]
    assert parts == sorted(parts, reverse=True)
    assert len({r["part"] for r in got if r["doc_id"] == 3}) > 10 and len({r["part"] for r in got if r["doc_id"] is None}) > 10


def test_sketches_are_the_least_shingle_hashes():
    texts = [t or "" for t in odd_texts()] + [prose(random.Random(k), 700) for k in range(4)]
    for t, sketch in zip(texts, fingerprint.sketches(pa.array(texts))):
        w = [x.encode() for x in WORD.findall(t)]
        shingles = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
        hashes = []
        for s in shingles:  # each shingle by itself, as the whole of one text
            buf = np.frombuffer(b" ".join(s), np.uint8)
            start, end, _ = common.words(buf, np.array([0, len(buf)]))
            hashes.append(int(common.windows(common.span_hashes(buf, start, end), len(s))[0]))
        want = sorted(set(hashes))[: fingerprint.K]
        assert sketch.tolist() == want
        assert fingerprint.encode(sketch) == base64.b64encode(b"".join(h.to_bytes(8, "big") for h in want)).decode()
        assert fingerprint.decode(fingerprint.encode(sketch)).tolist() == want
