"""The pipeline's stages in turn over a small table."""

import random

import corpus_pipeline
from cueforge.llm import secrets

from .helpers import docs, prose


def test_stages(spark, tmp_path):
    rng = random.Random(20)
    shared = prose(rng, 60, ("the", "and", "tion", "ing"))
    texts = [prose(rng, 90, ("the", "and", "tion", "ing", "er")) for _ in range(30)]
    texts += [texts[0], texts[1] + " " + shared, texts[2] + " " + shared, "1234 ###", None, prose(rng, 70, ("le", "que", "eau", "tion")) + ' token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2"']
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    df, seen = docs(spark, texts, langs=["en"] * 30 + [None] * 6), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        if name != names[-1]:
            assert out.columns == df.columns
        df = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r["doc_id"]: r for r in df.collect()} if name != names[-1] else df.collect()
    assert set(seen["language_id"]) == set(range(33)) | {35}
    assert 30 not in seen["simhash_near_dedup"] and 0 in seen["simhash_near_dedup"]
    kept = seen["substring_dedup"]
    assert all(shared not in (r["text"] or "") for r in kept.values())
    assert kept[5]["text"] == texts[5]
    assert "f33e6108" not in seen["secret_scan"][35]["text"] and "<SECRET>" in seen["secret_scan"][35]["text"]
    assert {r["doc_id"] for r in seen["pack"]} == set(seen["secret_scan"])
    assert secrets.judge(texts[5], secrets.train(), 0.5)[1] == []
