"""Substring dedup by fixed-block anchors.

A run of `window` words that occurs twice holds, in each place, a whole block of block = (window + 1) // 2 words that begins
at a multiple of block in its document: the anchors. The index holds the hashes of these non-overlapping blocks; every
rolling run of block words probes it. A chunk of documents sends each distinct hash once to its hash range, with a mark if
it is an anchor, and gets back one bit: anchor somewhere and present in another place. Hits are extended over the windows
that contain them; the extended windows' 128-bit hashes are counted exactly in the same way, and words covered by a window
that occurs elsewhere, same document included, form the maximal repeats that are removed.

A common passage sends one entry per chunk and hash, whatever number of documents has it. Null texts have no words;
texts shorter than the window lose nothing. Repeated rows repeat all their windows. Hashes are of whole words, unchanged. Rows with null
or equal doc_ids each give their row; an empty table none. A very long text is a chunk of its own. Other columns are carried along as they
are, whatever their names.

A row of the exchange is a chunk's part in a range, so rows grow with the product of both numbers until each holds few hashes. For
corpora of many TB give a larger chunk_bytes, with the workers' memory in mind.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Chunk, ascending, bits_from, bits_of, chunks, saved, span_hashes, unascending, windows, within, words

WINDOW = 35
CHUNK_BYTES = 8 << 20
#: Entries of a hash range that one task holds, about.
RANGE = 1_000_000
#: Bits of a block's hash in the first round; hits are proved by the second.
KEEP = 46
ENTRY = "range long, chunk long, a binary, b binary, marks binary"
REPLY = "chunk long, round int, range long, bits binary"


class Grams:
    """A chunk's words and the hashes of its runs."""

    def __init__(self, row: dict, window: int):
        self.chunk = Chunk(row)
        self.start, self.end, self.at = words(self.chunk.buf, self.chunk.offsets)
        self.window, self.block = window, (window + 1) // 2
        self.h = span_hashes(self.chunk.buf, self.start, self.end)

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct block hashes, place of each hash by run, and marks: anchor, more than once here."""
        g = windows(self.h, self.block) >> np.uint64(64 - KEEP)
        ok = within(len(g), self.at, self.block)
        self.runs = np.flatnonzero(ok)
        own, place, count = np.unique(g[ok], return_inverse=True, return_counts=True)
        first = np.repeat(self.at[:-1], np.diff(self.at))[self.runs]
        anchor = np.zeros(len(own), bool)
        anchor[place[(self.runs - first) % self.block == 0]] = True
        return own, place, anchor, count > 1

    def candidates(self, hit: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold a hit block whole."""
        n = len(self.h) - self.window + 1
        if n <= 0 or not hit.any():
            return np.zeros(0, np.int64)
        mark = np.zeros(len(self.h) + 1, np.int64)
        places = self.runs[hit]
        np.add.at(mark, np.maximum(0, places - (self.window - self.block)), 1)
        np.add.at(mark, places + 1, -1)
        return np.flatnonzero((np.cumsum(mark)[:n] > 0) & within(n, self.at, self.window))

    def keys(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct 128-bit hashes of windows, in order, place of each window's hash, and whether it is here twice."""
        if not len(starts):
            none = np.zeros(0, np.uint64)
            return none, none, np.zeros(0, np.int64), np.zeros(0, bool)
        a, b = windows(self.h, self.window, 1)[starts], windows(self.h, self.window, 2)[starts]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        return a[new], b[new], place, np.bincount(place) > 1


def ranged(values: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Where each of the ranges begins among ascending values of so many bits."""
    edge = [(-(-(k << bits) // ranges)) for k in range(ranges)]
    return np.append(np.searchsorted(values, np.array(edge, np.uint64)), len(values))


def _rows(number: int, edges: np.ndarray, a: np.ndarray, b: np.ndarray | None, marks: list[np.ndarray]) -> pa.RecordBatch:
    cols: list[list] = [[], [], [], [], []]
    for k in np.flatnonzero(np.diff(edges)).tolist():
        own = slice(edges[k], edges[k + 1])
        for c, v in zip(cols, (k, number, ascending(a[own]), b"" if b is None else b[own].tobytes(), bits_of(np.concatenate([m[own] for m in marks]))), strict=True):
            c.append(v)
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(("range", "chunk", "a", "b", "marks"), cols, types, strict=True)})


def _replies(round_: int, table: pa.Table) -> pa.Table:
    """For each entry of a range: whether it is a repeat (round 0: and an anchor is among its places)."""
    rows = table.to_pylist()
    a = [unascending(r["a"]) for r in rows]
    size = [len(x) for x in a]
    marks = [bits_from(r["marks"], n * (2 - round_)) for r, n in zip(rows, size, strict=True)]
    a = np.concatenate(a)
    several = np.concatenate([m[-n:] for m, n in zip(marks, size, strict=True)])
    if round_:
        b = np.concatenate([np.frombuffer(r["b"], np.uint64) for r in rows])
        order = np.lexsort((b, a))
        new = np.concatenate([[True], (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)])
    else:
        order = np.argsort(a, kind="stable")
        new = np.concatenate([[True], np.diff(a[order]) != 0])
    first = np.flatnonzero(new)
    good = np.add.reduceat(1 + several[order].astype(np.int64), first) > 1
    if not round_:
        good &= np.logical_or.reduceat(np.concatenate([m[:n] for m, n in zip(marks, size, strict=True)])[order], first)
    hit = np.empty(len(a), bool)
    hit[order] = good[np.cumsum(new) - 1]
    out, at = [], 0
    for r, n in zip(rows, size, strict=True):
        if (own := hit[at : at + n]).any():
            out.append({"chunk": r["chunk"], "round": round_, "range": r["range"], "bits": bits_of(own)})
        at += n
    return pa.Table.from_pylist(out, schema=pa.schema([("chunk", pa.int64()), ("round", pa.int32()), ("range", pa.int64()), ("bits", pa.binary())]))


def _hits(replies: list[dict], round_: int, edges: np.ndarray) -> np.ndarray:
    hit = np.zeros(edges[-1], bool)
    for r in replies:
        if r["round"] == round_:
            a, b = edges[r["range"]], edges[r["range"] + 1]
            hit[a:b] = bits_from(r["bits"], b - a)
    return hit


def covered(df: DataFrame, window: int, finish, schema: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """finish(grams, gone) for each chunk of df, gone telling for each word whether it is removed."""
    parts = chunks(df, chunk_bytes)
    total = parts.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(1, -(-total // RANGE))

    def probe(batches):
        for batch in batches:
            for row in batch.to_pylist():
                g = Grams(row, window)
                own, _, anchor, several = g.blocks()
                yield _rows(row["chunk"], ranged(own, KEEP, ranges), own, None, [anchor, several])

    def second(g: Grams, replies: list[dict]):
        own, place, _, _ = g.blocks()
        hit = _hits(replies, 0, ranged(own, KEEP, ranges))
        starts = g.candidates(hit[place])
        return starts, g.keys(starts)

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            _, (a, b, _, several) = second(Grams(row, window), right.to_pylist())
            out.append(_rows(row["chunk"], ranged(a, 64, ranges), a, b, [several]))
        return pa.Table.from_batches(out)  # each key has its chunk on the left

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            g, replies = Grams(row, window), right.to_pylist()
            starts, (a, _, place, _) = second(g, replies)
            again = starts[_hits(replies, 1, ranged(a, 64, ranges))[place]] if len(starts) else starts
            edge = np.zeros(len(g.h) + 1, np.int64)
            np.add.at(edge, again, 1)
            np.add.at(edge, again + window, -1)
            out.append(finish(g, np.cumsum(edge)[:-1] > 0))
        return pa.concat_tables(out)

    first = parts.mapInArrow(probe, ENTRY).groupBy("range").applyInArrow(lambda t: _replies(0, t), REPLY)
    first = saved(first)
    again = parts.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(extend, ENTRY)
    both = first.union(again.groupBy("range").applyInArrow(lambda t: _replies(1, t), REPLY))
    return parts.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(mark, schema)


def kept_words(g: Grams, gone: np.ndarray):
    """Of each document: number of words, number removed, and the kept words joined by a space, as bytes."""
    raw = g.chunk.buf.tobytes()
    start, end = g.start.tolist(), g.end.tolist()
    for a, b in zip(g.at[:-1].tolist(), g.at[1:].tolist(), strict=True):
        own = gone[a:b]
        n = int(own.sum())
        places = range(a, b) if n == 0 else (np.flatnonzero(~own) + a).tolist()
        yield b - a, n, b" ".join([raw[start[i] : end[i]] for i in places])


def op3(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and digest of the kept words of each row."""

    def finish(g: Grams, gone: np.ndarray) -> pa.Table:
        n, removed, kept = zip(*((n, r, hashlib.sha256(k).hexdigest()) for n, r, k in kept_words(g, gone)), strict=True)
        return pa.table({"doc_id": g.chunk.rest.column(0).combine_chunks(), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(kept, pa.string())})

    return covered(df.select(F.col("doc_id").cast("long"), "text"), window, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """df with the kept words as text where words were removed, and n_chars, where it is a column, to match.

    Other texts stay as they are, byte for byte; rows whose text loses all its words stay with an empty text.
    """
    names = df.columns
    others = [c for c in names if c != "text"]

    def finish(g: Grams, gone: np.ndarray) -> pa.Table:
        rest = g.chunk.rest
        off, raw = g.chunk.offsets.tolist(), g.chunk.buf.tobytes()
        texts = [None if null else kept.decode() if r else raw[off[i] : off[i + 1]].decode() for i, ((_, r, kept), null) in enumerate(zip(kept_words(g, gone), g.chunk.null.tolist(), strict=True))]
        cols = dict(zip(others, rest.columns, strict=True))
        cols["text"] = pa.chunked_array([pa.array(texts, pa.string())])
        if "n_chars" in cols:
            cols["n_chars"] = pa.chunked_array([pa.array([len(t) if t is not None else o for t, o in zip(texts, cols["n_chars"].to_pylist(), strict=True)], cols["n_chars"].type)])
        return pa.table({c: cols[c] for c in names})

    return covered(df, window, finish, df.schema)
