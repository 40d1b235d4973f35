"""Each operator against brute force, over odd rows, repeated ids and empty tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from cueforge.llm import common, fingerprint, katz, langid, media, packing, pieces, pii, secrets, simhash, substring

from .helpers import docs, odd_texts, prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- shared hashing


def test_words_and_windows():
    texts = ["a b", "", " c  d e ", None, "a b c d e f", "éé a b"]
    buf, off = common.buffers(pa.array(texts))
    s, e, at = common.words(buf, off)
    raw = buf.tobytes()
    own = [[raw[x:y].decode() for x, y in zip(s[a:b], e[a:b])] for a, b in zip(at[:-1], at[1:])]
    assert own == [WORD.findall(t or "") for t in texts]
    h = common.span_hashes(buf, s, e)
    flat = [w for d in own for w in d]
    assert len({(w, int(x)) for w, x in zip(flat, h)}) == len(set(flat)) == len(set(h.tolist()))
    for width in range(1, 8):
        got = common.windows(h, width)
        keys = [tuple(flat[i : i + width]) for i in range(len(flat) - width + 1)]
        assert len(got) == len(keys) and len(set(zip(keys, got.tolist()))) == len(set(keys)) == len(set(got.tolist()))
        ok = common.within(len(got), at, width)
        doc = np.repeat(np.arange(len(texts)), np.diff(at))
        assert ok.tolist() == [doc[i] == doc[i + width - 1] for i in range(len(got))]


def test_packed_integers():
    rng = np.random.default_rng(0)
    for top in (1, 255, 256, 1 << 40, (1 << 64) - 1):
        a = rng.integers(0, top, 500, np.uint64, endpoint=True)
        assert (common.widen(common.narrow(a)) == a).all()
        assert (common.unascending(common.ascending(np.sort(a))) == np.sort(a)).all()
    assert len(common.widen(common.narrow(np.zeros(0, np.uint64)))) == 0


# --- 1


def test_media(spark):
    texts = odd_texts()
    got = by_id(media.op1(docs(spark, texts)))
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        load = raw + b" " * ((-len(raw)) % 192 if raw else 192)
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(load), hashlib.sha256(load).hexdigest(), zlib.crc32(load[-16:]))
        whole = media.header(len(load)) + load
        assert (r["media_bytes"], r["media_sha256"]) == (len(whole), hashlib.sha256(whole).hexdigest())
    assert got[7]["feature"] == got[8]["feature"] == got[19]["feature"]
    assert got[12]["n_chunks"] > 5


def test_media_file_is_a_wave(tmp_path):
    import wave

    load = media.payload(b"some text")
    path = tmp_path / "x.wav"
    path.write_bytes(media.header(len(load)) + load)
    with wave.open(str(path)) as w:
        assert (w.getnchannels(), w.getsampwidth(), w.getframerate()) == (1, 1, media.RATE) and w.readframes(w.getnframes()) == load


def test_chunks_move_with_content(spark):
    rng = random.Random(3)
    text = prose(rng, 30_000).encode()
    a, b = (media.payload(x) for x in (text, b"inserted " + text))
    pieces_of = lambda x, c: {x[i:j] for i, j in zip([0, *c[:-1]], c)}
    own = [pieces_of(x, media.cuts(np.frombuffer(x, np.uint8))) for x in (a, b)]
    assert len(own[0] & own[1]) > 0.8 * len(own[0])
    ends = media.cuts(np.frombuffer(a, np.uint8))
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(a) and sizes.max() <= media.MOST and sizes[:-1].min() >= media.LEAST
    store = media.chunk_store(docs(spark, [text.decode(), "inserted " + text.decode(), text.decode()]))
    assert store.count() == len(own[0] | own[1])


def test_media_damage_is_found():
    load = media.payload(b"x" * 500)
    import zstandard

    kept = zstandard.ZstdCompressor().compress(load)
    with pytest.raises(ValueError):
        media._read_back(media.digest(load), len(load), [(media.digest(b"other"), kept)])
    with pytest.raises(ValueError):
        media._read_back(media.digest(load), len(load), [(media.digest(load), None)])


# --- 2


def simhash_brute(t):
    w = WORD.findall(lower(t))
    sh = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    n = [0] * 64
    for x in sh:
        h = xxhash.xxh64_intdigest(x.encode(), 42)
        for b in range(64):
            n[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * n[b] > len(sh))


def components_brute(ids, fps, bits):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def test_simhash(spark):
    texts = [t for t in odd_texts() if t is None or len(t) < 40_000]
    ids = list(range(100, 100 + len(texts)))
    got = by_id(simhash.op2(docs(spark, texts, ids)))
    fps = [simhash_brute(t) for t in texts]
    want = components_brute(ids, fps, 2)
    assert {d: (r["fingerprint"], r["component_id"]) for d, r in got.items()} == {d: (f"{f:016x}", c) for d, f, c in zip(ids, fps, want)}


def test_gray_index_links_and_components():
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 64, 60, np.uint64)
    codes = np.unique(np.concatenate([seeds] + [seeds[rng.integers(0, 60, 200)] ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) for _ in range(3)]))
    for turn in (0, 21, 43):
        index = simhash.GrayIndex(codes, turn)
        a, b = index.links(np.arange(len(codes)), 2)
        c = index.codes[:, 0]
        near = np.bitwise_count(c[:, None] ^ c[None, :]) <= 2
        assert set(zip(a.tolist(), b.tolist())) == {(i, j) for i, j in zip(*np.nonzero(near)) if i < j}
        label = index.components(2)
        want = components_brute(list(range(len(c))), [int(x) for x in c], 2)
        assert label.tolist() == want
    assert sorted(simhash.gray_rank(np.arange(256, dtype=np.uint64)[:, None])[:, 0].tolist()) == list(range(256))


def test_wide_gray_index():
    rng = np.random.default_rng(6)
    seeds = rng.integers(0, 1 << 64, (12, 4), np.uint64)
    flips = (rng.random((12, 25, 256)) < 0.08).reshape(300, 256)
    codes = np.repeat(seeds, 25, axis=0) ^ np.packbits(flips, axis=1, bitorder="little").view("<u8")
    index = simhash.GrayIndex(codes)
    c = index.codes
    far = np.bitwise_count(c[:, None] ^ c[None]).sum(2)
    a, b = index.links(np.arange(300), 46)
    assert set(zip(a.tolist(), b.tolist())) == {(i, j) for i, j in zip(*np.nonzero(far <= 46)) if i < j}
    assert (codes[index.order] == c).all() and len(set(index.components(46).tolist())) == len(set(index.components(60).tolist())) == 12
    ranks = [tuple(r) for r in simhash.gray_rank(c).tolist()]
    assert ranks == sorted(ranks)


def test_near_copies_by_similarity(spark):
    rng = random.Random(30)
    texts = [prose(rng, rng.choice([40, 150, 900])) for _ in range(60)]
    shared = prose(rng, 60)
    texts += [shared + " " + prose(rng, 200), shared + " " + prose(rng, 200)]
    n = len(texts)
    for k in range(60):
        w = texts[k].split()
        for at in rng.sample(range(len(w)), max(1, len(w) // 70)):
            w[at] = "changed"
        texts.append(" ".join(w))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_components(docs(spark, texts)).collect()}
    sh = [{tuple(w[i : i + 5]) for w in [t.split()] for i in range(len(w) - 4)} for t in texts]
    missed = wrong = pairs = 0
    for i in range(len(texts)):
        for j in range(i):
            s = len(sh[i] & sh[j]) / len(sh[i] | sh[j])
            pairs += s >= 0.82
            missed += s >= 0.82 and got[i] != got[j]
            wrong += s < 0.5 and got[i] == got[j]
    assert pairs > 40 and missed <= 0.1 * pairs and wrong == 0 and got[n - 1] == n - 1


def test_near_copies_need_similar_sets(spark):
    """Documents that share a much repeated line are no near copies; links are those of brute force over sets."""
    rng = random.Random(31)

    def own(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    line = own(16)
    texts = [" ".join([line] * 10) + " " + own(100) for _ in range(150)]
    for k in range(60):
        w = own(rng.choice([12, 60, 200])).split()
        texts.append(" ".join(w))
        for at in rng.sample(range(len(w)), rng.randint(1, max(1, len(w) // 40))):
            w[at] = "changed"
        texts.append(" ".join(w))
    w = own(120).split()
    for k in range(0, 60, 2):  # a chain, each link similar
        w[k] = "changed"
        texts.append(" ".join(w) + " " + line)
    sh = [{tuple(w[i : i + 5]) for w in [t.split()] for i in range(len(w) - 4)} for t in texts]
    want = list(range(len(texts)))
    linked = 0
    for i in range(len(texts)):
        for j in range(i):
            if len(sh[i] & sh[j]) >= 0.8 * len(sh[i] | sh[j]):
                linked += 1
                a, b = sorted((want[i], want[j]))
                want = [a if x == b else x for x in want]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_components(docs(spark, texts)).collect()}
    assert linked > 40 and [got[i] for i in range(len(texts))] == want


def test_simhash_chains_across_tasks(spark):
    """A path of fingerprints two bits apart each ends in one component."""
    fp, fps = 0, [0]
    for k in range(0, 62, 2):
        fp ^= 3 << k
        fps.append(fp)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = simhash.forest(spark.createDataFrame([(x,) for x in signed], "fp long"))
    roots = simhash.connected(edges).collect()
    assert len(roots) == len(fps) - 1 and {r["root"] for r in roots} == {min(signed)}


def test_components_never_stop_half_way(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(40)], "a long, b long")
    assert {(r["node"], r["root"]) for r in simhash.connected(edges).collect()} == {(k, 0) for k in range(1, 41)}
    with pytest.raises(RuntimeError):
        simhash.connected(edges, most_steps=1)


def test_keep_one(spark):
    base = prose(random.Random(2), 80)
    df = docs(spark, [base, base, "other text here", base, None, None], [5, 3, 7, 3, 9, None])
    got = simhash.keep_one(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in got.select("doc_id").collect()) == sorted([(False, 3), (False, 7), (False, 9), (True, None)], key=str) or {r["doc_id"] for r in got.collect()} == {3, 7, 9, None}


def test_keep_one_of_each_group_whatever_its_ids(spark):
    rng = random.Random(33)
    a, b, c, d = (prose(rng, 80) for _ in range(4))
    # one id for unlike texts; copies without ids; a copy whose id an unlike text has too; empty texts
    texts, ids = [a, b, b, c, c, d, d, d, "", None], [1, 1, 2, None, None, None, 7, 1, None, None]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in simhash.keep_one(docs(spark, texts, ids)).collect())
    assert got == sorted([(False, 1, a), (False, 1, b), (True, 0, c), (False, 1, d), (True, 0, d), (True, 0, "")])


# --- 3


def repeats_brute(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    count = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append([x for x, g in zip(w, gone) if not g])
    return words, out


@pytest.mark.parametrize("chunk_bytes", [1, 3000, 8 << 20])
def test_substring_dedup(spark, chunk_bytes, monkeypatch):
    monkeypatch.setattr(substring, "RANGE", 500)
    rng = random.Random(4)
    passage = prose(rng, 60)
    texts = odd_texts(7)[:12] + ["same " * 400, prose(rng, 20) + " " + passage, passage + " " + prose(rng, 9), " ".join(passage.split()[:35]) + " end", " ".join(passage.split()[:34]) + " end", passage.replace(" ", "\n")]
    words, kept = repeats_brute(texts, 35)
    monkeypatch.setattr(substring, "CHUNK_BYTES", chunk_bytes)

    def finish(g, gone):
        n, r, k = zip(*substring.kept_words(g, gone))
        return pa.table({"doc_id": g.chunk.rest.column(0).combine_chunks(), "n": pa.array(n, pa.int64()), "r": pa.array(r, pa.int64()), "k": pa.array([x.decode() for x in k])})

    got = by_id(substring.covered(docs(spark, texts).select("doc_id", "text"), 35, finish, "doc_id long, n long, r long, k string", chunk_bytes))
    for i, (w, k) in enumerate(zip(words, kept)):
        assert (got[i]["n"], got[i]["r"], got[i]["k"]) == (len(w), len(w) - len(k), " ".join(k)), i
    assert sum(len(w) - len(k) for w, k in zip(words, kept)) > 700


@pytest.mark.parametrize("window", [1, 2, 3, 10])
def test_substring_small_windows(spark, window):
    rng = random.Random(window)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))) for _ in range(25)]
    words, kept = repeats_brute(texts, window)
    got = by_id(substring.op3(docs(spark, texts), window))
    assert [got[i]["kept_sha256"] for i in range(25)] == [hashlib.sha256(" ".join(k).encode()).hexdigest() for k in kept]


def test_without_repeats_keeps_rows_and_columns(spark):
    rng = random.Random(1)
    p = prose(rng, 50)
    df = docs(spark, ["alone\n here", None, p, p + " more", ""], [1, 2, None, 4, 4])
    got = substring.without_repeats(df)
    assert got.columns == df.columns
    rows = {(r["doc_id"], r["part"]): r["text"] for r in got.collect()}
    assert rows[1, 0] == "alone\n here" and rows[2, 1] is None and rows[None, 2] == "" and rows[4, 3] == "more" and rows[4, 4] == ""


# --- 4


def brute_paths(lattice, unit):
    out = []

    def go(at, score, ids):
        if at == len(unit):
            out.append((score, ids))
            return
        ends = [e for e in range(at + 1, len(unit) + 1) if unit[at:e] in lattice.pieces]
        for e in ends:
            i, s = lattice.pieces[unit[at:e]]
            go(e, score + s, [*ids, i])
        if at + 1 not in ends:
            go(at + 1, score + lattice.low, ids + lattice.ids(unit, at, at + 1, None))

    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


def test_nbest_is_exact():
    rng = random.Random(6)
    pieces_ = {p: (k, -rng.random() * 10) for k, p in enumerate(["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "aba", "bb", "▁▁", "c"])}
    lattice = pieces.Lattice(pieces_, list(range(100, 356)))
    for text in ["", "a", "ab ba", "abab  bba", "aéb c", "abba ab a", "  ab"]:
        norm = pieces.normalise(text)
        want = brute_paths(lattice, norm)
        for n in (1, 2, 5, 9):
            got = lattice.nbest(norm, n)
            assert np.allclose([s for s, _ in got], [s for s, _ in want[:n]])
            assert len({i for _, i in got}) == len(got) == min(n, len(want))
            by_ids = {np.array(i, "<u4").tobytes(): s for s, i in want}
            assert all(abs(by_ids[i] - s) < 1e-9 for s, i in got)
            assert all(lattice.decode(np.frombuffer(i, "<u4")) == text for _, i in got)


def test_pieces_refuses_inner_marks():
    with pytest.raises(ValueError):
        pieces.Lattice({"a▁b": (0, 0.0)})


def test_segment(spark):
    texts = odd_texts()
    got = by_id(pieces.segment(docs(spark, texts), 3))
    lattice = pieces.load(pieces.model_path())
    assert all(r["decodes"] for r in got.values()) and len(got) == len(texts)
    for i in (3, 4, 6, 20):
        want = [s for s, _ in brute_paths(lattice, pieces.normalise(texts[i]))[:3]] if len(texts[i]) < 14 else None
        if want:
            assert [float(s) for s in got[i]["scores"].split(",")] == want
    assert got[0]["n_pieces"] == 0 and got[0]["best_score"] == 0


# --- 5


def test_packing(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    tok.encode_special_tokens = True
    texts = odd_texts() + ["<|endoftext|> it's  two   spaces\n\n tabs\t\tand's"]
    rows = packing.pack(docs(spark, texts), with_ids=True).collect()
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    own = collections.defaultdict(list)
    seqs = collections.defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert np.frombuffer(r["ids"], "<u4").tolist() == part and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        own[r["doc_id"]].append((r["start"], r["length"]))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, p in own.items():
        at = 0
        for s, n in sorted(p):
            assert s == at and n > 0
            at += n
        assert at == len(ids[d])
    assert set(own) == set(ids)
    for k, p in seqs.items():
        at = 0
        for o, n in sorted(p):
            assert o == at
            at += n
        assert at == 2048 or (k == max(seqs) and at <= 2048)
    assert sorted(seqs) == list(range(len(seqs)))


def test_ids_are_the_tokenizers_ids():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    tok.encode_special_tokens = True
    encoder, rng = packing.Encoder(packing.tokenizer_path()), random.Random(13)
    some = [chr(c) for c in [*range(9, 14), *range(32, 127), *range(0xA0, 0x250), 0x85, 0x1C, 0x2009, 0x2019, 0x2028, 0x20AC, 0x3000, 0x4E2D, 0x0660, 0x0301, 0x1F600, 0x200B]] + ["the", " and", "'s", "'ll", "  ", "\n\n", "2024", "<|endoftext|>"] * 20
    for _ in range(1500):
        t = "".join(rng.choice(some) for _ in range(rng.randint(0, 25)))
        if rng.random() < 0.6:
            t = packing.Encoder.plain.sub("", t)
        assert np.frombuffer(encoder.ids(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t
    long = "a" * 50_000
    assert np.frombuffer(encoder.ids(long), "<u4").tolist() == tok.encode(long, add_special_tokens=False).ids


# --- 6


def test_bottom_k(spark):
    texts = odd_texts() + [prose(random.Random(k), 300) for k in range(6)]
    ids = [3 * k for k in range(len(texts))]
    got = by_id(fingerprint.op6(docs(spark, texts, ids, partitions=2)))
    assert len(got) == len(texts)
    order = sorted(range(len(texts)), key=lambda i: -ids[i])
    for at, i in enumerate(order):
        t, nxt = texts[i] or "", texts[order[(at + 1) % len(order)]] or ""
        n = len(t) // 3
        edit = t[: len(t) - n] + nxt[:n]
        r = got[ids[i]]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edit.encode()).hexdigest()), i
        sh = lambda x: {tuple(w[j : j + 5]) for w in [WORD.findall(x)] for j in range(max(1, len(w) - 4)) if w}
        a, b, c = sh(t), sh(edit), sh(nxt)
        true = lambda x, y: (len(x & y) / len(x | y)) if x | y else 1.0
        assert abs(r["near_edited"] - true(a, b)) < 0.2 and abs(r["near_next"] - true(a, c)) < 0.2
        own = fingerprint.decode(r["fingerprint"])
        assert len(own) == min(fingerprint.K, len(a))
    assert got[ids[7]]["fingerprint"] == got[ids[8]]["fingerprint"] == got[ids[19]]["fingerprint"]


def test_bottom_k_merges_and_estimates():
    rng = random.Random(8)
    a, b = prose(rng, 4000), prose(rng, 2000)
    sa, sb, both = (fingerprint.sketches(pa.array([x]))[0] for x in (a, b, a + " " + b))
    merged = fingerprint.merge(sa, sb)
    assert len(np.intersect1d(merged, both)) >= fingerprint.K - 4  # four shingles over the seam
    sh = lambda t: len({tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)})
    assert abs(fingerprint.distinct(both) / sh(a + " " + b) - 1) < 0.35
    assert fingerprint.containment(sb, both) > 0.8 and fingerprint.resemblance(sa, sb) < 0.1


# --- 7


def base_brute(text):
    found = []
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    for k, pat in enumerate((email, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        own = []
        for m in re.finditer(pat, text):
            d = re.sub("[^0-9]", "", m[0])
            if k == 1 and not all(int(x) <= 255 for x in m[0].split(".")) or k == 2 and not (16 <= len(d) <= 19 and pii.luhn(d)) or k == 3 and not 8 <= len(d) <= 15:
                continue
            own.append(m.span())
        found.append(own)
    return found


def test_pii_base_is_the_patterns():
    rng = random.Random(9)
    bits = ["a@b.co", "x.y+z@mail-1.example.org", "@", "@@", "a@b", ".", "..", "1.2.3.4", "300.1.1.1", "01.002.3.255", "4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "+1 (555) 010-9999", "+12", "-", " ", "é", "12", "7", "+", "1.2.3.4.5.6.7.8", "a@b.c@d.e", "%"]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
        assert pii.detect(t) == base_brute(t), t


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("write to jane [at] mail (dot) example [dot] org now", "email", "jane [at] mail (dot) example [dot] org"), ("mail joe at example dot com please", "email", "joe at example dot com"),
        ("joe_at_example_dot_com", "email", "joe_at_example_dot_com"), ("Joe AT example DOT com", "email", "Joe AT example DOT com"), ("ping 192.l68.O.1O1 ok", "ip", "192.l68.O.1O1"),
        ("call +1 five five five 010 nine nine nine 9", "phone", "+1 five five five 010 nine nine nine 9"), ("card 4111 1ll1 1111 1111", "card", "4111 1ll1 1111 1111"),
        ("ping １０.０.０.１ ok", "ip", "１０.０.０.１"), ("host 192 dot 168 dot 0 dot 7 up", "ip", "192 dot 168 dot 0 dot 7"), ("mаria@exаmple.com", "email", "mаria@exаmple.com"),
        ("call plus four four two zero seven nine four six zero nine five eight", "phone", "plus four four two zero seven nine four six zero nine five eight"),
        ("card four one one one one one one one one one one one one one one one.", "card", "four one one one one one one one one one one one one one one one"), ("jo​hn@ex​ample.com", "email", "jo​hn@ex​ample.com"),
    ],
)
def test_pii_disguises(text, kind, found):
    more = pii.added(text, pii.detect(text))[pii.KINDS.index(kind)]
    assert found in [text[a:b] for a, b in more]


@pytest.mark.parametrize("text", ["we met at noon at the dot", "look at example.com today", "one two three", "at last dot dot dot", "the café at Köln", "two or three of four at five", "10 Il 2O", "state_of_the_art at_home", "dot-com and co-dot-op"])
def test_pii_leaves_clean_text(text):
    assert not any(pii.added(text, pii.detect(text))) and not any(pii.detect(text))


def test_pii_gate_lets_all_disguises_through(monkeypatch):
    """What the gate lets through gives the same spans as the transducer run on every text."""
    rng = random.Random(32)
    digits = ["one", "oh", "zero", "One", "OH", "seven", "5", "1", "O", "l", "555"]
    texts = ["jane <at> example.com", "jane ( at ) example.com", "jane [ at ] example.com", "jane (arroba) example.com", "+1 555 one one oh one", "plus 44 20 7946 0958", "+1 555 O 123 45 67", "jane {ARROBA} example (punkt) org"]
    named = len(texts)
    for _ in range(3000):
        a, b = rng.choice(["[]", "()", "{}", "<>", "[)"])
        gap = [rng.choice(["", " ", "  "]) for _ in range(4)]
        at = rng.choice(["at", "arroba", "@", "AT"])
        dot = rng.choice([".", " dot ", "(punto)", "[.]", " {point} ", "_dot_"])
        mail = f"jane{gap[0]}{a}{gap[1]}{at}{gap[2]}{b}{gap[3]}example{dot}com"
        sign = rng.choice(["+", "plus ", "Plus ", ""])
        call = sign + rng.choice([" ", "-", ", ", ""]).join(rng.choice(digits) for _ in range(rng.randint(3, 12)))
        texts.append(" and ".join(rng.sample([mail, call, "joe at example dot net", "plain words"], rng.randint(1, 2))))
    gated = [pii.added(t, pii.detect(t)) for t in texts]
    monkeypatch.setattr(pii, "disguised", lambda text: True)
    assert gated == [pii.added(t, pii.detect(t)) for t in texts]
    assert all(any(more) for more in gated[:named])


def test_pii_query(spark):
    texts = odd_texts() + ["a@b.co and joe at example dot com", "a@b.co"]
    got = by_id(pii.find_personal_data(docs(spark, texts)))
    for i, t in enumerate(texts):
        base = base_brute(t or "")
        own = ",".join(f"{k}:{a}:{b}" for k, s in zip(pii.KINDS, base) for a, b in s)
        r = got[i]
        assert r["base_sha256"] == hashlib.sha256(own.encode()).hexdigest() and [r[f"n_{k}"] for k in pii.KINDS] == [len(s) for s in base]
    assert got[len(texts) - 2]["spans"] == "email:0:6,email:11:33"
    assert pii.redact(texts[-2]) == "<EMAIL> and <EMAIL>"


# --- 8


def katz_brute(texts, train):
    toks = [WORD.findall(lower(t)) + ["</s>"] for t in texts]
    c1, c2, ch = collections.Counter(), collections.Counter(), collections.Counter()
    for w, use in zip(toks, train):
        if use:
            c1.update(w)
            for h, x in zip(["<s>", *w], w):
                c2[h, x] += 1
                ch[h] += 1
    n = sum(c1.values())
    of = lambda c: katz.Discounts.good_turing(np.array([sum(v == r for v in c.values()) for r in range(1, katz.K + 2)]))
    d1, d2 = of(c1), of(c2)
    d = lambda m, c: m.d[c - 1] if c <= katz.K else 1.0
    left = 1 - sum(d(d1, c) * c for c in c1.values()) / n
    keep = 1.0
    if left < 1e-12:
        keep, left = n / (n + 1), 1 / (n + 1)
    uni = lambda w: d(d1, c1[w]) * c1[w] / n * keep if w in c1 else left

    def p(h, w):
        if h not in ch:
            return uni(w)
        seen = {x: c for (g, x), c in c2.items() if g == h}
        mass, k = 1 - sum(d(d2, c) * c for c in seen.values()) / ch[h], 1.0
        if mass < 1e-12:
            k, mass = ch[h] / (ch[h] + 1), 1 / (ch[h] + 1)
        if w in seen:
            return d(d2, seen[w]) * seen[w] / ch[h] * k
        return mass / (1 - sum(map(uni, seen))) * uni(w)

    return toks, c1, n, p


@pytest.mark.parametrize(("hot", "chunk_bytes"), [(1000, 8 << 20), (20, 300), (3, 1)])
def test_katz(spark, hot, chunk_bytes, monkeypatch):
    monkeypatch.setattr(katz, "RANGE", 300)
    rng = random.Random(10)
    common_words = ["the", "of", "and", "b", "c"]
    texts = [None, "", "The THE the", "x"] + [" ".join(rng.choice(common_words) if rng.random() < 0.6 else f"w{int(rng.expovariate(0.05))}" for _ in range(rng.randint(5, 80))) for _ in range(40)]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    import pyspark.sql.functions as F

    got = by_id(katz.score(docs(spark, texts), F.crc32(F.col("doc_id").cast("string")) % 10 != 0, chunk_bytes, hot))
    toks, c1, n, p = katz_brute(texts, [not h for h in held])
    for i, w in enumerate(toks):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(x in c1 for x in w), n)
        assert math.isclose(r["base_score"], sum(math.log10((c1[x] + 0.1) / (n + 0.1 * (len(c1) + 1))) for x in w), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p(h, x)) for h, x in zip(["<s>", *w], w)), rel_tol=1e-9), i
    for h in ("<s>", "the", "w3", "unheard"):
        assert math.isclose(sum(p(h, w) for w in c1) + p(h, "\0"), 1, rel_tol=1e-9)


def test_katz_tables_give_the_same(spark, tmp_path):
    import pyspark.sql.functions as F

    from cueforge.llm import katz_tables

    rng = random.Random(14)
    texts = [None, "", "The THE the", "x\x0by"] + [" ".join(rng.choice(["the", "of", "a", "b"]) if rng.random() < 0.5 else f"w{int(rng.expovariate(0.1))}" for _ in range(rng.randint(3, 60))) for _ in range(30)]
    df = docs(spark, texts)
    learns = F.col("doc_id") % 4 != 0
    model = katz_tables.train(df.filter(learns))
    model.write(str(tmp_path / "model"))
    model = katz_tables.Tables.read(spark, str(tmp_path / "model"))
    got, want = by_id(katz_tables.score(df, model)), by_id(katz.score(df, learns))
    assert len(got) == len(texts)
    for i, r in want.items():
        assert (got[i]["n_tokens"], got[i]["n_known"]) == (r["n_tokens"], r["n_known"]) and math.isclose(got[i]["score"], r["score"], rel_tol=1e-9), i
    # backoff weights make each history's probabilities sum to 1
    words = {r["word"]: r["p"] for r in model.unigrams.collect()}
    alpha = {r["history"]: r["alpha"] for r in model.backoff.collect()}
    seen = collections.defaultdict(dict)
    for r in model.bigrams.collect():
        seen[r["history"]][r["word"]] = r["p"]
    for h, own in seen.items():
        assert math.isclose(sum(own.values()) + alpha[h] * (1 - sum(words[w] for w in own)), 1, rel_tol=1e-9)


def test_katz_without_training_rows(spark):
    import pyspark.sql.functions as F

    rows = katz.score(docs(spark, ["a b", None]), F.lit(False)).collect()
    assert [r["score"] for r in rows] == [0.0, 0.0] and all(r["train_tokens"] == 0 for r in rows)


# --- 9


def test_codewords_are_far_apart():
    for k in (2, 4, 30):
        c = langid.codewords(k, 25)
        d = (25 - c @ c.T) / 2
        assert d[~np.eye(k, dtype=bool)].min() >= 5 and (abs(c.sum(0)) < k).all()


def test_language(spark):
    rng = random.Random(12)
    parts = {"en": ["the", "and", "tion", "ing", "th", "er"], "de": ["der", "und", "ung", "sch", "ß", "ein"], "fr": ["le", "eau", "que", "é", "oux", "des"]}
    texts, langs = [], []
    for k in range(150):
        lang = rng.choice(list(parts))
        texts.append(prose(rng, rng.randint(20, 60), parts[lang]))
        langs.append(lang if k % 10 else None)
    n = len(texts)
    texts += [None, "", "12 34 !!", "中文", "é" * 30_000]
    langs += ["en", None, None, None, None]
    got = by_id(langid.op9(docs(spark, texts, langs=langs)))
    assert [got[i]["lang_pred"] for i in range(n, n + 3)] == ["und"] * 3 and all(got[i]["score"] == 0 for i in range(n, n + 3))
    assert got[n + 3]["lang_pred"] in parts
    held = [i for i in range(n) if zlib.crc32(str(i).encode()) % 5 == 0 and langs[i]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(n))
    assert sum(got[i]["lang_pred"] == langs[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    df = docs(spark, texts, langs=langs)
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} >= set(range(n))
    assert not {r["doc_id"] for r in kept.collect()} & {n, n + 1, n + 2}


def test_training_draws_from_every_language(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "fit", lambda x, y: seen.append(collections.Counter(y)))
    texts = [f"text {i}" for i in range(400)]
    langs = [f"l{i % 12}" if i < 60 else "big" for i in range(400)]
    # 13 languages, also with a bound under their number; ids that are null or all the same
    for ids in (None, [None] * 400, [7] * 400):
        langid.train(docs(spark, texts, ids, langs), max_train=39, max_per_language=30)
        langid.train(docs(spark, texts, ids, langs), max_train=10)
        assert set(seen[-2]) == set(seen[-1]) == set(langs)
        assert set(seen[-1].values()) == {1} and max(seen[-2].values()) <= 3
    langid.train(docs(spark, ["same"] * 90 + ["other"], [1] * 91, ["a"] * 90 + ["b"]), max_train=20)
    assert seen[-1] == {"a": 1, "b": 1}


@pytest.mark.parametrize("k", [2, 3, 4])
def test_ambiguous_texts_are_rejected(spark, k):
    rng = random.Random(34)
    parts = [["the", "and", "tion", "ing"], ["der", "und", "ung", "sch"], ["le", "eau", "que", "oux"], ["gli", "zza", "ello", "cchi"]][:k]
    texts = [prose(rng, 50, parts[i % k]) for i in range(40 * k)]
    langs = ["abcd"[i % k] for i in range(40 * k)]
    df = docs(spark, texts, langs=langs)
    model = langid.train(df)
    mixed = [prose(rng, n, parts[0]) + " " + prose(rng, 400 - n, parts[1]) for n in range(401) for _ in range(2)]
    _, score, doubt = model.predict(pa.array(mixed))
    odd = [t for t, d, v in zip(mixed, doubt, score) if d and v >= 0.3]
    assert odd
    kept = {r["text"] for r in langid.keep_identified(docs(spark, texts + odd), model).collect()}
    assert kept >= set(texts) and not kept & set(odd)


def test_language_without_labels(spark):
    rows = langid.op9(docs(spark, ["abc", None])).collect()
    assert [r["lang_pred"] for r in rows] == ["und", "und"]
    one = langid.op9(docs(spark, ["abc", "def", "x"], [1, 2, 3], ["en"] * 3)).collect()
    assert {r["lang_pred"] for r in one} == {"en"}


# --- 10


def test_forest_on_unseen_findings():
    forest = secrets.train()
    test = secrets.generated_findings(1000, seed=99)
    p = forest.predict(np.array([secrets.features(*r[:3]) for r in test]))
    assert ((p >= 0.5) == np.array([r[3] for r in test], bool)).mean() > 0.95


def test_secret_scan(spark):
    key = "ghp_" + "aB3dE5fG7hJ9kL1mN3pQ5rS7tU9vW1xY3zA5"
    texts = odd_texts() + [f'the token = "{key}" here', "commit sha 2321bac4d15ec8f90433955bf9d3cf61da5bdd1e done", 'password: "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"']
    df = docs(spark, texts)
    got = by_id(secrets.scan(df))
    n = len(texts)
    assert got[n - 3]["spans"].split(":")[:2] == ["13", str(13 + len(key))] and got[n - 2]["n_secrets"] == 0 and got[n - 1]["n_secrets"] == 1
    assert all(got[i]["n_secrets"] == 0 for i in range(n - 3))
    clean = by_id(secrets.without_secrets(df))
    assert clean[n - 3]["text"] == 'the token = "<SECRET>" here' and clean[n - 3]["n_chars"] == len(clean[n - 3]["text"])
    assert all(clean[i]["text"] == texts[i] for i in range(n - 3))


# --- all


ALL = {
    "op1": media.op1, "op2": simhash.op2, "op3": substring.op3, "op4": lambda d: pieces.segment(d, 2), "op5": packing.pack, "op6": fingerprint.op6,
    "op7": pii.find_personal_data, "op8": katz.op8, "op9": langid.op9, "op10": secrets.scan, "keep_one": simhash.keep_one, "repeats": substring.without_repeats,
    "language": langid.keep_identified, "secrets": secrets.without_secrets, "fingerprints": fingerprint.fingerprints,
}


@pytest.mark.parametrize("name", ALL)
def test_empty_table(spark, name):
    assert ALL[name](docs(spark, [])).collect() == []


@pytest.mark.parametrize("name", [n for n in ALL if n not in ("keep_one", "language")])
def test_repeated_rows_and_null_ids(spark, name):
    texts = ["a b c d e f", "a b c d e f", None, "g " * 60, "", "g " * 60]
    df = docs(spark, texts, [1, 1, 1, None, None, 2], ["en", None, "en", "de", None, "de"])
    rows = ALL[name](df).collect()
    assert len(rows) == len(texts)
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "1", "1", "2", "None", "None"]
