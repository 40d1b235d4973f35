"""Large groups dealt out into blocks, and the cases that stages and contracts add to the operators' own tests."""

import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pytest

import corpus_pipeline
from cueforge.llm import common, langid, media, packing, pii, queries, simhash

from .helpers import docs, odd_texts, prose
from .test_operators import base_brute, components_brute, simhash_brute


def rare(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def set_components(texts, least=0.8):
    sh = [{tuple(w[i : i + 5]) for w in [t.split()] for i in range(len(w) - 4)} for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sh[i] & sh[j]) >= least * len(sh[i] | sh[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


def hot_texts():
    """A large group of near copies, documents that share one passage and else nothing, and a chain across both."""
    rng = random.Random(41)
    base = rare(rng, 120).split()
    texts = []
    for _ in range(40):
        w = list(base)
        for at in rng.sample(range(120), rng.choice([1, 1, 2])):
            w[at] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    passage = rare(rng, 60)
    texts += [passage + " " + rare(rng, rng.choice([25, 60])) for _ in range(30)]
    w = list(base)
    for k in range(0, 120, 8):
        w[k] = "c"
        texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize(("rows", "size", "refine"), [(12, 3000, 1), (25, 6000, 0)])
def test_near_copies_in_split_groups(spark, rows, size, refine, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", rows)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", size)
    monkeypatch.setattr(simhash, "SET_BYTES", 0)
    monkeypatch.setattr(simhash, "REFINE", refine)
    monkeypatch.setattr(simhash, "LEADERS", 2)
    texts = hot_texts()
    want = set_components(texts)
    assert len(set(want)) < len(texts) - 40
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_components(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_simhash_in_split_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 8)
    monkeypatch.setattr(simhash, "LEADERS", 2)
    rng = np.random.default_rng(42)
    centre = rng.integers(0, 1 << 63, 3, np.uint64)
    codes = [int(c) for c in centre]
    for c in centre.tolist():
        for _ in range(40):
            x = c
            for b in rng.choice(22, rng.integers(1, 4), replace=False):  # all in the first block of places: hot in the two others
                x ^= 1 << int(b)
            codes.append(x)
    codes = sorted(set(codes))
    edges = simhash.forest(spark.createDataFrame([(x,) for x in codes], "fp long"))
    root = {r["node"]: r["root"] for r in simhash.connected(edges).collect()}
    want = components_brute(codes, codes, 2)
    assert [root.get(x, x) for x in codes] == want and len(set(want)) > 3


def test_hubs_of_many_edges(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FEW", 0)
    edges = [(k, 0) for k in range(1, 3000)] + [(5000 + k, 2999) for k in range(500)]
    got = {r["node"]: r["root"] for r in simhash.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got.values()) == {0} and len(got) == 3499


def estimated_bits(df):
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length()


def test_rounds_do_not_multiply_size_estimates(spark, monkeypatch):
    """Estimates of joins are products; carried from round to round they filled the driver's memory."""
    monkeypatch.setattr(simhash, "FEW", 0)
    names = random.Random(48).sample(range(10**6), 200)
    chain = [(max(a, b), min(a, b)) for a, b in zip(names, names[1:])]
    roots = simhash.connected(spark.createDataFrame(chain, "a long, b long"))
    assert {(r["node"], r["root"]) for r in roots.collect()} == {(x, min(names)) for x in names if x != min(names)}
    assert estimated_bits(roots) <= 64


def test_levels_do_not_multiply_size_estimates(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 12), ("BLOCK_BYTES", 3000), ("SET_BYTES", 0), ("LEADERS", 2), ("FEW", 0)):
        monkeypatch.setattr(simhash, name, value)
    own, placed = simhash.near_groups(docs(spark, hot_texts()), simhash.SIMILARITY, simhash.NEAR_WIDTH)
    assert max(map(estimated_bits, (own, placed))) <= 64


def test_keep_one_keeps_one_row_of_every_group(spark):
    texts = hot_texts()
    want = set_components(texts)
    kept = sorted(r["doc_id"] for r in simhash.keep_one(docs(spark, texts + texts[:20], list(range(len(texts))) + [1000 + k for k in range(20)])).collect())
    assert kept == sorted(set(want))


# --- language stage without labels


def test_without_labels_the_language_stage_keeps_texts(spark):
    texts = ["abc def", None, "", "12 ..", "ünd", "abc def"]
    got = langid.keep_identified(docs(spark, texts, [1, 2, 3, 4, None, 1])).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "None"] and all(r["lang"] is None for r in got)


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 5)
    with pytest.raises(ValueError):
        langid.train(docs(spark, ["a"] * 6, langs=list("abcdef")))


def test_decoding_is_loss_weighted():
    """The prediction is the codeword of least weighted logistic loss, by plain loops."""
    rng = random.Random(43)
    parts = {"a": ["the", "ing"], "b": ["und", "sch"], "c": ["eau", "que"]}
    texts = [prose(rng, 30, parts[x]) for x in parts for _ in range(15)]
    y = [x for x in parts for _ in range(15)]
    model = langid.fit(langid.features(pa.array(texts)), y)
    probe = texts + [prose(rng, 40, parts["a"] + parts["b"]), "und the eau", "zzz"]
    lang, score, doubt = model.predict(pa.array(probe))
    x = langid.features(pa.array(probe))
    for i in range(len(probe)):
        loss = []
        for c in model.codes:
            total = 0.0
            for j, bit in enumerate(c):
                margin = sum(float(a) * float(b) for a, b in zip(x[i], model.weights[:, j]) if a) + float(model.bias[j])
                total += float(model.trust[j]) * float(np.log1p(np.exp(-margin * bit)))
            loss.append(total / float(model.trust.sum()))
        p = np.exp(-(np.array(loss) - min(loss)) * model.scale)
        p /= p.sum()
        order = np.argsort(-p)
        assert model.languages[order[0]] == lang[i] and abs(p[order[0]] - score[i]) < 1e-4
        assert doubt[i] == (p[order[0]] - p[order[1]] < langid.AMBIGUOUS) or abs(p[order[0]] - p[order[1]] - langid.AMBIGUOUS) < 1e-4


# --- ids of the contract's call


def test_query_ids_are_those_of_the_plain_call(spark, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    texts = [*odd_texts(), "a <|endoftext|> b", "<|endoftext|>", "é<|endoftext|><|endoftext|>中", "<|endoftext", "|endoftext|>"]
    docs(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    ids = [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert 50256 in ids[-5]
    rows = queries.op5_pack_tokens(spark, str(tmp_path)).collect()
    total = 0
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(np.array(own[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
        total += r["length"]
    assert total == sum(map(len, ids))
    encoder, rng = packing.Encoder(packing.tokenizer_path(), special=True), random.Random(44)
    for _ in range(400):
        t = "".join(rng.choice(["<|endoftext|>", " ", "a", "the", "<|", "|>", "\n", "ß", "😀"]) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(encoder.ids(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


# --- personal data


def disguise(rng, kind):
    """(disguised text, kind): a base identifier rewritten by one of the rules, from a generator that knows no pattern of the operator."""
    if kind == "email":
        at, dot = rng.choice([(" [at] ", " [dot] "), ("(at)", "(punkt)"), (" <arroba> ", " punto "), (" at ", " dot "), (" arroba ", " punto "), (" arobase ", " point "), (" ät ", " punkt "), ("{ @ }", "."), ("_at_", "_dot_")])
        name = rng.choice(["jane", "joe.b", "k9"]) if at != "_at_" else "jane"
        return f"{name}{at}mail{dot}example{dot}org" if at != "_at_" else "jane_at_mail_dot_org"
    spelled = rng.choice([
        "zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve",
    ]).split()
    say = lambda d: spelled[int(d)] if rng.random() < 0.8 else spelled[int(d)].upper()
    if kind == "phone":
        return rng.choice(["+", "plus "]) + " ".join(say(d) for d in "4930123" + str(rng.randrange(10, 99)))
    if kind == "card":
        return " ".join(map(say, "4111111111111111"))
    return rng.choice([" dot ", " punto ", " punkt ", " point "]).join(["192", "168", "0", str(rng.randrange(1, 255))])


def test_disguises_are_found_where_they_stand():
    rng = random.Random(45)
    filler = ["and", "so", "mm", "weiter", "voilà", "😀", "(x)"]
    for _ in range(1500):
        kind = rng.choice(pii.KINDS)
        what = disguise(rng, kind)
        before = " ".join(rng.choice(filler) for _ in range(rng.randint(0, 4)))
        text = f"{before}; {what}; " + " ".join(rng.choice(filler) for _ in range(rng.randint(0, 4)))
        start = len(before) + 2
        more = pii.added(text, pii.detect(text))
        if kind == "phone" and what.startswith("+"):
            assert (start, start + len(what)) in more[pii.KINDS.index(kind)], text
        else:
            assert more[pii.KINDS.index(kind)] == [(start, start + len(what))], text
        assert pii.detect(text) == base_brute(text)


def test_gate_is_the_transducer(monkeypatch):
    """No rule word, bracket, space or foreign digit is stopped by the gate."""
    rng = random.Random(46)
    bits = [*pii.NUMBERS, "at", "ät", "arroba", "arobase", "dot", "punto", "punkt", "point", "plus", *"()[]{}<>@.+-_ ,", " ", "  ", "\n", "jane", "example", "com", "4", "77", "O", "l", "ſ", "İ", "K", "а", "​"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(1, 14))) for _ in range(6000)]
    gated = [pii.added(t, pii.detect(t)) for t in texts]
    monkeypatch.setattr(pii, "disguised", lambda text: True)
    assert gated == [pii.added(t, pii.detect(t)) for t in texts]
    for word in pii.NUMBERS:
        for odd in (word.replace("s", "ſ"), word.replace("i", "İ"), word.upper()):
            pii.added("+1 " + " ".join([odd] * 9), [[], [], [], []])


@pytest.mark.parametrize("text", ["at this point we go", "look at some point in time", "un point de vue", "el punto de vista", "am punkt vier", "plus tard", "cinq plus six", "eins zwei drei vier", "un deux trois quatre cinq"])
def test_plain_words_of_other_languages_stay(text):
    assert not any(pii.added(text, pii.detect(text)))


def test_long_runs_take_linear_time():
    for text in ("a@b.co" + "\n" * 1_000_000 + "x (at) y dot com", "(" * 200_000 + " " * 300_000 + "@", "one " * 100_000, "a at " + "b-" * 200_000):
        began = time.perf_counter()
        pii.added(text, pii.detect(text))
        assert time.perf_counter() - began < 10


# --- shared settings


def test_shared_folder_is_the_sessions(spark):
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    folder = common.shared_dir(spark)
    assert folder and (not own.isDefined() or spark.conf.get("spark.checkpoint.dir", None) or folder == own.get())


def test_a_sessions_own_batch_bound_stays(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "67108864b")
        common.small_batches(spark.range(1))
        assert spark.conf.get(name) == "67108864b"
        spark.conf.unset(name)
        common.small_batches(spark.range(1))
        assert int(spark.conf.get(name).rstrip("b")) == common.BATCH_BYTES
    finally:
        spark.conf.set(name, before)


# --- the pipeline over odd tables


def run_on(spark, tmp_path, df):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return corpus_pipeline.run(spark, str(tmp_path)).collect()


def test_pipeline_of_an_empty_table(spark, tmp_path):
    assert run_on(spark, tmp_path, docs(spark, [])) == []


def test_pipeline_without_labels_and_with_odd_ids(spark, tmp_path):
    rng = random.Random(47)
    texts = [prose(rng, 60) for _ in range(12)]
    rows = run_on(spark, tmp_path, docs(spark, [*texts, texts[0], None, "", texts[1]], [*range(10), None, 3, 50, 51, None, None]))
    # the copies under other ids go, rows without an id are groups of their own, empty texts have no letter
    assert {r["doc_id"] for r in rows} == {*range(10), None}
    assert sum(r["start"] == 0 for r in rows) == 13


def test_rows_of_one_medium_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(media, "HOT", 4)
    texts = ["same"] * 30 + [f"t{k}" for k in range(10)] + [None] * 12
    got = media.op1(docs(spark, texts)).collect()
    assert len(got) == len(texts) and len({r["payload_sha256"] for r in got}) == 12
    assert len({(r["payload_sha256"], r["feature"]) for r in got}) == 12
