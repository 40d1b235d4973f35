"""Katz backoff language model of bigrams, counted and evaluated over partitioned tables.

P(w | h) = d(c) c(h, w) / c(h) where h w was seen in training, else alpha(h) P(w); P(w) = d(c) c(w) / N where w was seen,
else what the discounts leave, for the one unknown word. d are Good-Turing discounts for counts up to K, 1 beyond.
alpha(h) divides what h's discounts leave by the unigram mass of the words not seen after h, so P sums to 1 over the
vocabulary and the unknown word exactly. A history all of whose counts are above K keeps 1 / (c(h) + 1) for backoff.

Documents are packed into chunks. Round one sends each chunk's distinct words to the words' hash ranges and returns their
training counts and numbers: a word's place among its range's words, so in the order of the 64-bit hashes. Round two sends
its distinct bigrams, as numbers, to their histories' ranges, with the words' counts, and returns
the bigrams' training counts and per history the numbers of continuations of each small count and their unigram mass.
With both, a chunk evaluates its documents token by token. A history with more than N / HOT tokens (so fewer than HOT of
them) is dealt out by continuation instead, and its sums are put together from all ranges. Both rounds' tables, partitioned by
range, are kept in the checkpoint folder; the driver gets only totals and fewer than HOT sums. katz_tables keeps models of any order.

Null texts are empty: one end token. Rows without a doc_id are training rows. Without training rows every token is the one
unknown word, of probability 1. Repeated rows each count and are scored each. An empty table gives no rows. A very long text is a
chunk of its own. Columns besides doc_id and text are not looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Chunk, ascending, chunks, narrow, saved, span_hashes, unascending, widen, words
from .substring import ranged

K = 5
HOT = 1000
CHUNK_BYTES = 12 << 20
RANGE = 1_000_000
END = np.uint64(0x1F0E5D3C7B9A8642)
START = np.uint64(0xC6A4A7935BD1E995)
#: A word's number: its range above, its place in the range below. No word has START's.
PLACES = np.uint64(1 << 32)
START_NUMBER = np.uint64(1 << 63)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
REQUEST = "range long, chunk long, a binary, b binary, c binary, d binary, e binary, f binary"
REPLY = "chunk long, round int, range long, a binary, b binary, c binary, mass double, small array<long>"


class Tokens:
    """A chunk's tokens as hashes: the words of each document, lower-cased, then one end."""

    def __init__(self, row: dict):
        chunk = Chunk(row)
        buf = _LOWER[chunk.buf]
        s, e, at = words(buf, chunk.offsets)
        n = len(at) - 1
        self.ids, train = chunk.rest.column(0).combine_chunks(), chunk.rest.column(1).to_numpy()
        size = np.diff(at) + 1
        self.ends = np.cumsum(size) - 1  # where each document's end token is
        self.token = np.empty(len(s) + n, np.uint64)
        word = np.ones(len(self.token), bool)
        word[self.ends] = False
        self.token[word] = span_hashes(buf, s, e)
        self.token[self.ends] = END
        self.first = self.ends - size + 1
        self.history = np.empty_like(self.token)
        self.history[1:] = self.token[:-1]
        self.history[self.first] = START
        self.doc = np.repeat(np.arange(n), size)
        self.train = train.astype(bool)[self.doc]
        self.n_docs, self.size = n, size
        self.words, self.place = np.unique(self.token, return_inverse=True)

    def counts(self) -> np.ndarray:
        return np.bincount(self.place, self.train, len(self.words)).astype(np.int64)


@dataclass
class Discounts:
    """d for counts 1 to K."""

    d: np.ndarray

    @classmethod
    def good_turing(cls, n: np.ndarray) -> Discounts:
        """n[r - 1]: how many have count r, r from 1 to K + 1. Where these give no proper discounts, a smaller K."""
        for k in range(len(n) - 1, 0, -1):
            if (n[: k + 1] > 0).all():
                over = (k + 1) * n[k] / n[0]
                r = np.arange(1, k + 1)
                d = ((r + 1) * n[1 : k + 1] / n[:k] / r - over) / (1 - over) if over < 1 else np.zeros(k)
                if (d > 0).all() and (d <= 1).all() and (d < 1).any():
                    return cls(np.concatenate([d, np.ones(K - k)]))
        return cls(np.ones(K))

    def of(self, c: np.ndarray) -> np.ndarray:
        return np.concatenate([[0.0], self.d, [1.0]])[np.minimum(c, K + 1)]

    def loss(self, n: np.ndarray) -> np.ndarray:
        """What the discounts take from n[..., r - 1] of each count r."""
        return (n * (np.arange(1, K + 1) * (1 - self.d))).sum(-1)


@dataclass
class Unigrams:
    total: int
    types: int
    discounts: Discounts
    unknown: float
    keep: float
    starts: int
    hot: float

    def p(self, c: np.ndarray) -> np.ndarray:
        """Probability of a word of training count c; of count 0: of the unknown word."""
        if not self.total:
            return np.full(len(c), 1.0)
        return np.where(c > 0, self.discounts.of(c) * c / self.total * self.keep, self.unknown)

    @classmethod
    def of(cls, total: int, types: int, n: np.ndarray, starts: int, hot: int) -> Unigrams:
        discounts = Discounts.good_turing(n)
        left = float(discounts.loss(n[:K])) / total if total else 1.0
        keep = 1.0
        if left <= 0:
            keep, left = total / (total + 1), 1 / (total + 1)
        return cls(total, types, discounts, left, keep, starts, max(1.0, total / hot))


def _table(rows: list[tuple], schema: str) -> pa.Table:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "array<long>": pa.list_(pa.int64())}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], types[kind]) for i, (name, kind) in enumerate(fields)})


def _grouped(key: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, the place of each entry's key, and sums by key."""
    own, place = np.unique(key, return_inverse=True)
    return own, place, [np.bincount(place, s, len(own)) for s in sums]


def _count_words(table: pa.Table) -> pa.Table:
    """Round one at a range: training counts and places of the words, back to each chunk; in row -1 the range's count of counts."""
    rows = table.to_pylist()
    a = [unascending(r["a"]) for r in rows]
    own, place, (count,) = _grouped(np.concatenate(a), np.concatenate([widen(r["b"]) for r in rows]).astype(float))
    count = count.astype(np.int64)
    out, at = [], 0
    for r, x in zip(rows, a, strict=True):
        mine = place[at : at + len(x)]
        out.append((r["chunk"], 1, r["range"], narrow(count[mine]), ascending(mine.astype(np.uint64)), b"", None, None))
        at += len(x)
    out.append((-1, 1, rows[0]["range"], b"", b"", b"", None, _stats(count)))
    return _table(out, REPLY)


def _stats(count: np.ndarray) -> list[int]:
    """Sum, number, and how many have each count up to K + 1, of the counts over 0."""
    seen = count[count > 0]
    return [int(seen.sum()), len(seen), *np.bincount(np.minimum(seen, K + 2), minlength=K + 3)[1 : K + 2].tolist()]


def _sums(n: int) -> list:
    return [F.sum(F.col("small")[i]).alias(f"s{i}") for i in range(n)]


def _summed(df: DataFrame) -> np.ndarray:
    """Sum of the count-of-counts rows."""
    return np.array([v or 0 for v in df.agg(*_sums(K + 3)).first()], np.int64)


class Bigrams:
    """A chunk's distinct bigrams in the order of round two: by range, history, word."""

    def __init__(self, t: Tokens, count: np.ndarray, number: np.ndarray, u: Unigrams, ranges: int):
        hist = np.full(len(t.token), -1, np.int64)
        hist[1:] = t.place[:-1]
        hist[t.first] = -1
        code = (hist + 1) * len(t.words) + t.place
        code, self.place = np.unique(code, return_inverse=True)
        self.seen = np.bincount(self.place, t.train, len(code)).astype(np.int64)
        h, w = code // len(t.words) - 1, code % len(t.words)
        self.word, self.history = number[w], np.where(h < 0, START_NUMBER, number[h])
        history = np.where(h < 0, START, t.words[h])
        self.count_w = count[w]
        self.count_h = np.where(h < 0, u.starts, np.where(history == END, 0, count[h]))
        self.hot = self.count_h > u.hot
        # where an entry is dealt: by its history's hash, or by its word's too if the history is hot
        key = np.where(self.hot, t.words[w] ^ history, history)
        top = ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((self.word, self.history, top))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.place = back[self.place]
        for name in ("seen", "word", "history", "count_w", "count_h", "hot"):
            setattr(self, name, getattr(self, name)[order])
        top = top[order]
        self.edges = np.searchsorted(top, np.arange(ranges + 1))
        new = np.ones(len(order), bool)
        new[1:] = (self.history[1:] != self.history[:-1]) | (top[1:] != top[:-1])
        self.run = np.cumsum(new) - 1
        self.heads = np.flatnonzero(new)

    def spans(self):
        """(range, its entries, its histories' heads)"""
        for k in np.flatnonzero(np.diff(self.edges)).tolist():
            a, b = self.edges[k], self.edges[k + 1]
            i, j = np.searchsorted(self.heads, [a, b])
            yield k, slice(a, b), self.heads[i:j]


def _ask(t: Tokens, g: Bigrams, number: int) -> list[tuple]:
    out = []
    for k, own, heads in g.spans():
        sizes = np.diff(np.append(heads, own.stop))
        word, first, place = np.unique(g.word[own], return_index=True, return_inverse=True)
        # a history's words ascend, so all but its first go as differences
        step = np.diff(place, prepend=0)
        step[heads - own.start] = place[heads - own.start]
        out.append((k, number, ascending(g.history[heads]), ascending(word), narrow(g.count_w[own][first]), narrow(g.seen[own]), _two(sizes, g.hot[heads]), narrow(step)))
    return out


def _sizes(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    at = int.from_bytes(b[:4], "little")
    return widen(b[4 : 4 + at]), widen(b[4 + at :])


def _places(step: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What _ask's differences stand for."""
    total, first = np.cumsum(step), np.cumsum(sizes) - sizes
    return total - np.repeat(total[first] - step[first], sizes)


def _two(a: np.ndarray, b: np.ndarray) -> bytes:
    first = narrow(a)
    return len(first).to_bytes(4, "little") + first + narrow(b)


HOT_ROW = -2


def _count_bigrams(u: Unigrams, table: pa.Table) -> pa.Table:
    """Round two at a range: training counts of bigrams and sums by history, back to each chunk; hot sums in rows of their own."""
    rows = table.to_pylist()
    size, head, hot, hist = [], [], [], []
    for r in rows:
        s, f = _sizes(r["e"])
        h = unascending(r["a"])
        size.append(s.astype(np.int64)), head.append(h), hot.append(f.astype(bool)), hist.append(np.repeat(h, s.astype(np.int64)))
    place = [_places(widen(r["f"]).astype(np.int64), s) for r, s in zip(rows, size, strict=True)]
    history, word = np.concatenate(hist), np.concatenate([unascending(r["b"])[i] for r, i in zip(rows, place, strict=True)])
    count_w = np.concatenate([widen(r["c"])[i] for r, i in zip(rows, place, strict=True)]).astype(np.int64)
    seen = np.concatenate([widen(r["d"]) for r in rows]).astype(np.int64)
    order = np.lexsort((word, history))
    h, w = history[order], word[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    first = np.flatnonzero(new)
    c = np.add.reduceat(seen[order], first)
    total = np.empty(len(h), np.int64)
    total[order] = c[np.cumsum(new) - 1]
    # sums by history over its distinct bigrams that were seen
    start = np.ones(len(first), bool)
    start[1:] = h[first][1:] != h[first][:-1]
    by = np.flatnonzero(start)
    own = h[first][by]
    mass = np.add.reduceat(np.where(c > 0, u.p(count_w[order][first]), 0.0), by)
    small = np.stack([np.add.reduceat((c == r).astype(np.int64), by) for r in range(1, K + 1)], 1)
    types = np.add.reduceat((c > 0).astype(np.int64), by)
    out, at, is_hot = [], 0, {}
    for r, s, hd, f in zip(rows, size, head, hot, strict=True):
        n = int(s.sum())
        i = np.searchsorted(own, hd[~f])
        # a chunk that has all of a history's seen continuations adds up their sums itself: a bit tells it so
        whole = np.add.reduceat((total[at : at + n] > 0).astype(np.int64), np.cumsum(s) - s)[~f] == types[i]
        i = i[~whole]
        out.append((r["chunk"], 2, r["range"], narrow(total[at : at + n]), np.packbits(whole).tobytes() + mass[i].tobytes(), narrow(small[i].ravel()), None, None))
        is_hot |= dict.fromkeys(hd[f].tolist())
        at += n
    for x in is_hot:
        i = int(np.searchsorted(own, np.uint64(x)))
        out.append((HOT_ROW, 2, rows[0]["range"], np.array([x], "<u8").tobytes(), b"", b"", float(mass[i]), small[i].tolist()))
    out.append((-1, 2, rows[0]["range"], b"", b"", b"", None, _stats(c)))
    return _table(out, REPLY)


def _answers(t: Tokens, rows: list[dict], ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Round one's counts and numbers of the chunk's words."""
    edges, count, number = ranged(t.words, 64, ranges), np.zeros(len(t.words), np.int64), np.zeros(len(t.words), np.uint64)
    for r in rows:
        if r["round"] == 1:
            own = slice(edges[r["range"]], edges[r["range"] + 1])
            count[own] = widen(r["a"]).astype(np.int64)
            number[own] = np.uint64(r["range"]) * PLACES + unascending(r["b"])
    return count, number


@dataclass
class Model:
    u: Unigrams
    bigrams: Discounts
    hot: dict[int, tuple[float, np.ndarray]]

    def logs(self, g: Bigrams, rows: list[dict]) -> np.ndarray:
        """log10 P of each distinct bigram of a chunk."""
        n, runs = len(g.word), len(g.heads)
        count = np.zeros(n, np.int64)
        mass, small = np.zeros(runs), np.zeros((runs, K), np.int64)
        by = {r["range"]: r for r in rows if r["round"] == 2}
        hot = g.hot[g.heads]
        for k, own, heads in g.spans():
            r = by[k]
            c = count[own] = widen(r["a"]).astype(np.int64)
            i, first = g.run[heads], heads - own.start
            mass[i] = np.add.reduceat(np.where(c > 0, self.u.p(g.count_w[own]), 0.0), first)
            small[i] = np.stack([np.add.reduceat((c == v).astype(np.int64), first) for v in range(1, K + 1)], 1)
            i = i[~hot[i]]
            bits = -(-len(i) // 8)
            i = i[~np.unpackbits(np.frombuffer(r["b"][:bits], np.uint8), count=len(i)).astype(bool)]
            mass[i] = np.frombuffer(r["b"][bits:], np.float64)
            small[i] = widen(r["c"]).astype(np.int64).reshape(-1, K)
        for i in np.flatnonzero(hot).tolist():
            mass[i], small[i] = self.hot[int(g.history[g.heads[i]])]
        c_h = g.count_h[g.heads].astype(float)
        left = np.divide(self.bigrams.loss(small), c_h, out=np.ones(runs), where=c_h > 0)
        keep = np.ones(runs)
        none = (left <= 0) & (c_h > 0)
        keep[none], left[none] = c_h[none] / (c_h[none] + 1), 1 / (c_h[none] + 1)
        alpha = np.where(c_h > 0, left / np.maximum(1 - mass, 1e-300), 1.0)
        p = np.where(count > 0, self.bigrams.of(count) * count / np.maximum(1, g.count_h) * keep[g.run], alpha[g.run] * self.u.p(g.count_w))
        return np.log10(p)


SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(df: DataFrame, train, chunk_bytes: int = CHUNK_BYTES, hot: int = HOT) -> DataFrame:
    """SCORES of each row of df; train is a column: whether the model learns from the row."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(True)).alias("train"), "text")
    parts = chunks(rows, chunk_bytes)
    size = parts.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(1, -(-size // RANGE))

    def ask_words(batches):
        for batch in batches:
            for row in batch.to_pylist():
                t = Tokens(row)
                count, edges = t.counts(), ranged(t.words, 64, ranges)
                out = [(k, row["chunk"], ascending(t.words[edges[k] : edges[k + 1]]), narrow(count[edges[k] : edges[k + 1]]), b"", b"", b"", b"") for k in np.flatnonzero(np.diff(edges)).tolist()]
                yield from _table(out, REQUEST).to_batches()

    one = saved(parts.mapInArrow(ask_words, REQUEST).groupBy("range").applyInArrow(_count_words, REPLY))
    s = _summed(one.filter("chunk = -1"))
    starts = _starts(rows)
    u = Unigrams.of(int(s[0]), int(s[1]), s[2:], starts, hot)

    def ask_bigrams(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        t = Tokens(row)
        return _table(_ask(t, Bigrams(t, *_answers(t, right.to_pylist(), ranges), u, ranges), row["chunk"]), REQUEST)

    known = one.filter("chunk >= 0")
    asked = parts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(ask_bigrams, REQUEST)
    two = saved(asked.groupBy("range").applyInArrow(lambda t: _count_bigrams(u, t), REPLY))
    bigrams = Discounts.good_turing(_summed(two.filter("chunk = -1"))[2:])
    hot_rows = two.filter(f"chunk = {HOT_ROW}").groupBy("a").agg(F.sum("mass"), *_sums(K)).collect()  # a row for each hot history
    sums = {int(np.frombuffer(r[0], "<u8")[0]): (r[1], np.array(r[2:], np.int64)) for r in hot_rows}
    model = Model(u, bigrams, sums)

    def evaluate(left: pa.Table, right: pa.Table) -> pa.Table:
        row, replies = left.to_pylist()[0], right.to_pylist()
        t = Tokens(row)
        count, number = _answers(t, replies, ranges)
        g = Bigrams(t, count, number, u, ranges)
        own = np.bincount(t.doc, model.logs(g, replies)[g.place], t.n_docs)
        c = count[t.place]
        base = np.log10((c + 0.1) / (u.total + 0.1 * (u.types + 1)))
        return pa.table({
            "doc_id": t.ids, "n_tokens": pa.array(t.size.astype(np.int64)), "n_known": pa.array(np.bincount(t.doc, c > 0, t.n_docs).astype(np.int64)),
            "train_tokens": pa.array(np.full(t.n_docs, u.total, np.int64)), "base_score": pa.array(np.bincount(t.doc, base, t.n_docs)), "score": pa.array(own),
        })

    replies = known.union(two.filter("chunk >= 0"))
    return parts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(evaluate, SCORES)


def _starts(rows: DataFrame) -> int:
    return rows.filter("train").count()


def op8(df: DataFrame, folds: int = 10) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    return score(df, ~held_out).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
