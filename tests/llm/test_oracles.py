"""The training-data queries against their SQL, over a driver table and over odd rows; the pipeline against brute force."""

import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from cueforge.llm import langid, packing, queries, secrets

from .helpers import docs, odd_texts, prose
from .test_operators import repeats_brute
from .test_split_groups import set_components

SF = "/root/testdata/sf0.001"


def rows_of(names, rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in (r[names.index(c)] for c in sorted(names))) for r in rows), key=repr)


def both(spark, folder, name):
    df = queries.QUERIES[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet{'' if folder == SF else '/*.parquet'}')")
    got = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    return rows_of(df.columns, df.collect()), rows_of(names, got.fetchall())


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_matches_sql(spark, name):
    mine, theirs = both(spark, SF, name)
    assert mine == theirs


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_matches_sql_on_odd_rows(spark, tmp_path, name):
    rng = random.Random(70)
    texts = [t for t in odd_texts() if t is None or (len(t) < 50_000 and "\0" not in t)]
    texts += ["a@b.co, x.y@z-1.de 10.0.0.1 and 300.1.1.1 or 4111 1111 1111 1111; +49 (30) 123-4567", "é 1.2.3.4 @a@b.c.d +12345678", prose(rng, 300), "A b A B a b"]
    docs(spark, texts, [3 * k + 1 for k in range(len(texts))]).write.parquet(str(tmp_path / "documents.parquet"))
    mine, theirs = both(spark, str(tmp_path), name)
    assert mine == theirs


def test_pipeline_is_its_stages_by_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(71)
    en, de = ("the", "and", "tion", "ing", "er", "of"), ("der", "und", "ung", "sch", "ein", "ich")
    texts = [prose(rng, rng.randint(60, 160), rng.choice([en, de])) for _ in range(40)]
    langs = ["en" if "the" in t and "sch" not in t else "de" for t in texts]
    shared = prose(rng, 50, en)
    near = texts[3].split()
    near[-2] = "changed"
    texts += [texts[0], " ".join(near), None, "", "123 ... 456", texts[5] + " " + shared, prose(rng, 70, en) + " " + shared, prose(rng, 80, de) + ' token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2" <|endoftext|>']
    langs += [None] * 8
    df = docs(spark, texts, langs=langs)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # language: the trained model's word, text by text
    model = langid.train(spark.read.parquet(str(tmp_path / "documents.parquet")))
    kept = []
    for i, t in enumerate(texts):
        lang, _, doubt = model.predict(pa.array([t], pa.string()))
        if lang[0] != "und" and not doubt[0]:
            kept.append(i)
    assert {42, 43, 44}.isdisjoint(kept) and len(kept) >= 40
    # near copies: the least id of each group of similar sets of shingles
    label = set_components([texts[i] for i in kept])
    kept = [i for place, i in enumerate(kept) if label[place] == place]
    assert 40 not in kept and 41 not in kept
    # repeated passages, then secrets
    own = [texts[i] for i in kept]
    _, left = repeats_brute(own, 35)
    own = [" ".join(w) if len(w) < len(t.split()) else t for t, w in zip(own, left)]
    forest = secrets.train()
    for k, t in enumerate(own):
        for a, b, _ in reversed(secrets.judge(t, forest, 0.5)[1]):
            t = t[:a] + "<SECRET>" + t[b:]
        own[k] = t
    assert sum("<SECRET>" in t for t in own) == 1
    tok = Tokenizer.from_file(packing.tokenizer_path())
    ids = {i: [*tok.encode(t, add_special_tokens=False).ids, 1] for i, t in zip(kept, own)}
    assert {r["doc_id"] for r in got} == set(ids)
    placed = {}
    for r in got:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids[r["doc_id"]]) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        placed[r["sequence_id"] * 2048 + r["offset"]] = r["length"]
    at = 0
    for start in sorted(placed):
        assert start == at
        at += placed[start]
    assert at == sum(map(len, ids.values()))
