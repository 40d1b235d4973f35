"""The Katz tables at order three against brute force, and the exchange's numbers."""

import collections
import math
import random

import numpy as np
import pytest

from cueforge.llm import katz, katz_tables

from .helpers import docs
from .test_operators import WORD, by_id, lower


def brute(texts, order):
    toks = [WORD.findall(lower(t)) + ["</s>"] for t in texts]
    counts = [collections.Counter() for _ in range(order)]  # counts[k - 1]: (history of k - 1 words, word)
    for w in toks:
        padded = ["<s>"] * (order - 1) + w
        for i in range(len(w)):
            for k in range(1, order + 1):
                counts[k - 1][tuple(padded[i + order - k : i + order - 1]), w[i]] += 1
    tables, seen = [], []
    for k in range(order):
        d = katz.Discounts.good_turing(np.array([sum(v == r for v in counts[k].values()) for r in range(1, katz.K + 2)]))
        own = collections.defaultdict(dict)
        for (h, x), c in counts[k].items():
            own[h][x] = c
        tables.append({h: ({x: (d.d[c - 1] if c <= katz.K else 1.0) * c for x, c in v.items()}, sum(v.values())) for h, v in own.items()})
        seen.append(own)

    def p(h, w):
        if h not in seen[len(h)]:
            return p(h[1:], w)
        kept, total = tables[len(h)][h]
        left, keep = 1 - sum(kept.values()) / total, 1.0
        if left < 1e-12:
            keep, left = total / (total + 1), 1 / (total + 1)
        if w in kept:
            return kept[w] / total * keep
        return left if not h else left / (1 - sum(p(h[1:], x) for x in kept)) * p(h[1:], w)

    return toks, counts, p


@pytest.mark.parametrize("order", [2, 3, 4])
def test_tables_of_an_order(spark, order, tmp_path):
    rng = random.Random(50 + order)
    texts = [None, "", "The THE the of of the of", "x y"] + [" ".join(rng.choice(["the", "of", "a", "b"]) if rng.random() < 0.7 else f"w{int(rng.expovariate(0.2))}" for _ in range(rng.randint(3, 50))) for _ in range(30)]
    learnt = texts[:28]
    model = katz_tables.train(docs(spark, learnt), order=order)
    model.write(str(tmp_path / "model"))
    model = katz_tables.Tables.read(spark, str(tmp_path / "model"))
    got = by_id(katz_tables.score(docs(spark, texts), model))
    _, counts, p = brute(learnt, order)
    for i, t in enumerate(texts):
        w = WORD.findall(lower(t)) + ["</s>"]
        padded = ["<s>"] * (order - 1) + w
        want = sum(math.log10(p(tuple(padded[j : j + order - 1]), x)) for j, x in enumerate(w))
        assert math.isclose(got[i]["score"], want, rel_tol=1e-9), i
        assert (got[i]["n_tokens"], got[i]["n_known"]) == (len(w), sum(((), x) in counts[0] for x in w))
    vocabulary = [x for _, x in counts[0]]
    for h, _ in list(counts[order - 1])[:25] + [(("unheard",) * (order - 1), "")]:
        assert math.isclose(sum(p(h, x) for x in vocabulary) + p(h, "\0"), 1, rel_tol=1e-9)


def test_order_and_empty_model(spark):
    with pytest.raises(ValueError):
        katz_tables.train(docs(spark, ["a"]), order=1)
    model = katz_tables.train(docs(spark, []), order=3)
    assert [r["score"] for r in katz_tables.score(docs(spark, ["a b", None]), model).collect()] == [0.0, 0.0]
    assert katz_tables.score(docs(spark, []), model).collect() == []


def test_numbers_are_distinct_words():
    """Two words whose hashes share the upper 48 bits keep their own counts."""
    a = np.array([5 << 16, (5 << 16) + 1, 9 << 16], np.uint64)
    rows = [(0, k, katz.ascending(a[own]), katz.narrow(np.array(c)), b"", b"", b"", b"") for k, (own, c) in enumerate([([0, 1], [1, 2]), ([1, 2], [4, 8])])]
    out = katz._count_words(katz._table(rows, katz.REQUEST)).to_pylist()
    assert katz.widen(out[0]["a"]).tolist() == [1, 6] and katz.widen(out[1]["a"]).tolist() == [6, 8]
    assert katz.unascending(out[0]["b"]).tolist() == [0, 1] and katz.unascending(out[1]["b"]).tolist() == [1, 2]
