"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints that differ in at most `bits` places agree on one of bits + 1 blocks of places, so distinct fingerprints go
to a task by (block, its value), once per block. A task sorts its fingerprints by Gray rank, the block's places first, and
builds a tree over runs of 16: a node holds the places that all its fingerprints share, less what its parent holds.
A search adds up the differences on the way down and drops a node, with all that is under it, once they exceed
`bits`; a node whose fingerprints are all in the searcher's component already is dropped too, so a group of near copies
costs no pairs. Tasks return a spanning forest, and alternating large-star and small-star steps join the forests.

Near copies by similarity (near_components) take wide fingerprints of the set of five-word shingles. At a similarity of 0.8
these differ in 39 of 256 places, too many for blocks of equal places; a task gets its fingerprints by the shingles' least hashes
instead. KEYS such keys are shared by none of two texts of that similarity once in ten million times. Fingerprints only find
candidates, with a wide margin; the sets of a group of candidates meet, and there a link needs their true similarity.

A group that is too large for a task, of one block value, key or candidate component, is dealt out: see links. Nothing is left out for it.

Null texts are empty; texts without words have fingerprint zero and link like any other. Equal fingerprints are one node,
whatever number of rows has them. A component's id is the least doc_id that is not null. Repeated rows and rows with null or equal
doc_ids each give their row; an empty table none. Very long texts are taken whole. Ties (a bit set in just half the hashes) are 0.
Other columns are not looked at, or carried along by keep_one, whatever their names.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import M1, M2, buffers, keyed_join, mapped, mix, saved_anew, shuffle_count, span_hashes, text_frame, windows, within, words

BITS = 2
WIDTH = 3
SEED = 42
FAN = 16
#: Wide fingerprints: 64-bit words, least-hash keys, words of a shingle, and the similarity of near copies.
WIDE, KEYS, NEAR_WIDTH, SIMILARITY = 4, 10, 5, 0.8
QUERIES = 1024
#: Rows of small groups that a worker takes at once; rows, or bytes of sets, of a group that one task takes; what a set counts for besides its bytes.
SLAB, BLOCK_ROWS, BLOCK_BYTES, SET_BYTES = 1 << 15, 1 << 13, 8 << 20, 16 << 10
#: Rows of a larger group that all its blocks see, and how often such a group is split by further keys before blocks meet blocks.
LEADERS, REFINE = 8, 2
#: Edges that are joined in one task.
FEW = 20_000
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """64-bit SimHash of UTF-8 text: word shingles, repeats included; a bit is 1 if set in over half the hashes."""
    own = text.lower().split()  # bytes: A-Z alone change, and space is 0x20 and 0x09 to 0x0D
    if not own:
        return 0
    joined = b" ".join(own)
    size = np.fromiter(map(len, own), np.int64, len(own))
    end = np.cumsum(size + 1) - 1
    start = end - size
    w = min(width, len(own))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(start[: len(own) - w + 1].tolist(), end[w - 1 :].tolist(), strict=True)], np.uint64)
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a long) of each row."""

    def rows(part: pa.RecordBatch) -> dict:
        buf, off = buffers(part.column(1))
        raw = buf.tobytes()
        own = np.array([fingerprint(raw[a:b], width) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], np.uint64)
        return {"doc_id": part.column(0), "fp": pa.array(own.view(np.int64))}

    return mapped(text_frame(df), rows, "doc_id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code (a row of 64-bit words, high ones first) in the order in which neighbours differ in one bit."""
    x = x.copy()
    for k in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(k)
    for j in range(1, x.shape[1]):
        x[:, j] ^= np.where(x[:, j - 1] & np.uint64(1), _ALL, np.uint64(0))
    return x


def block_edges(bits: int) -> list[tuple[int, int]]:
    """(lowest place, width) of bits + 1 blocks that cover 64 places."""
    cuts = [round(64 * k / (bits + 1)) for k in range(bits + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


class GrayIndex:
    """A tree over codes in Gray order. Level 0 are the codes; pattern and rest hold what a node adds to its parent.

    codes: 64-bit words, or rows of them. turn: how many low places of one-word codes come first in the order.
    """

    def __init__(self, codes: np.ndarray, turn: int = 0):
        codes = codes.reshape(len(codes), -1)
        turned = codes if turn == 0 else (codes << np.uint64(64 - turn)) | (codes >> np.uint64(turn))
        self.order = np.lexsort(gray_rank(turned).T[::-1])
        self.codes = codes[self.order]
        shared, pattern = [np.full(codes.shape, _ALL)], [self.codes]
        while len(pattern[-1]) > FAN:
            p, m = pattern[-1], shared[-1]
            at = np.arange(0, len(p), FAN)
            first = np.repeat(p[at], np.diff(np.append(at, len(p))), axis=0)
            m = np.bitwise_and.reduceat(m, at) & ~np.bitwise_or.reduceat(p ^ first, at)
            shared.append(m)
            pattern.append(p[at] & m)
        self.pattern = pattern
        self.rest = [m & ~np.repeat(up, FAN, axis=0)[: len(m)] for m, up in zip(shared, shared[1:])] + [shared[-1]]

    def components(self, bits: int, alike: Callable[[int, int], bool] | None = None, known: np.ndarray | None = None) -> np.ndarray:
        """For each code in Gray order, the place of the first code of its component under links of at most bits.

        With alike only links between places that it confirms count; it is not asked about places joined already. known: labels
        of the codes, in Gray order; equal ones are joined from the start.
        """
        n = len(self.codes)
        label = np.arange(n)
        if known is not None:
            _, first, place = np.unique(known, return_index=True, return_inverse=True)
            label = first[place]
        # with alike the first blocks are small, so that a group of near copies is joined before most of its pairs come up
        at, step = 0, 1 if alike else QUERIES
        while at < n:
            a, b = self.links(np.arange(at, min(n, at + step)), bits, label)
            label = joined(label, *(confirmed(label, a, b, alike) if alike else (a, b)))
            at, step = at + step, min(2 * step, QUERIES)
        return label

    def links(self, queries: np.ndarray, bits: int, label: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later place) within bits. With label: without pairs whose node is all of the query's label."""
        alike = []
        if label is not None:
            low = high = label
            for level in self.pattern:
                alike.append(np.where(low == high, low, -1))
                at = np.arange(0, len(level), FAN)
                low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        top = len(self.pattern) - 1
        nodes = np.arange(len(self.pattern[top]))
        out: list[tuple[np.ndarray, np.ndarray]] = []
        step = max(1, (1 << 21) // max(1, len(nodes) * FAN * self.codes.shape[1]))
        for begin in range(0, len(queries), step):
            own = queries[begin : begin + step]
            q, node = np.repeat(own, len(nodes)), np.tile(nodes, len(own))
            far = np.zeros(len(q), np.int64)
            for level in range(top, -1, -1):
                far = far + np.bitwise_count((self.codes[q] ^ self.pattern[level][node]) & self.rest[level][node]).sum(1)
                keep = (far <= bits) & ((node + 1) * FAN**level - 1 > q)
                if alike:
                    keep &= alike[level][node] != label[q]
                q, node, far = q[keep], node[keep], far[keep]
                if level:
                    size = len(self.pattern[level - 1])
                    q, far = np.repeat(q, FAN), np.repeat(far, FAN)
                    node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                    there = node < size
                    q, node, far = q[there], node[there], far[there]
            out.append((q, node))
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def confirmed(label: np.ndarray, a: np.ndarray, b: np.ndarray, alike: Callable[[int, int], bool]) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs that alike confirms, without pairs that pairs before them have joined."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (to := up.get(x, x)) != x:
            up[x] = up.get(to, to)
            x = to
        return x

    kept = []
    for i, (x, y, k, m) in enumerate(zip(a.tolist(), b.tolist(), label[a].tolist(), label[b].tolist(), strict=True)):
        k, m = root(k), root(m)
        if k != m and alike(x, y):
            up[max(k, m)] = min(k, m)
            kept.append(i)
    return a[kept], b[kept]


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """label after a[i] and b[i] have become one component each; a component's label is its least member."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        to = np.arange(len(label))
        np.minimum.at(to, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(nxt := to[to], to):
            to = nxt
        label = to[label]


def whole_groups(batches, limit: int) -> Iterator[pa.Table]:
    """Rows sorted by their first column, as tables that hold each of its values whole: of about limit rows, or one group."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size >= limit:
            table = pa.concat_tables(held)
            group = table.column(0).to_numpy()
            if group[0] != group[-1]:
                end = int(np.flatnonzero(group != group[-1])[-1]) + 1
                yield table.slice(0, end).combine_chunks()
                held = [table.slice(end)]
                size = held[0].num_rows
    if held:
        yield pa.concat_tables(held).combine_chunks()


LINK = "a long, b long"


def _edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array(np.maximum(a, b), pa.int64()), "b": pa.array(np.minimum(a, b), pa.int64())})


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _narrow_links(bits: int, edges: list[tuple[int, int]]):
    """For rows (group, node, label, block), node the code itself: a spanning forest of the links among many groups at once.

    Links need no common group, so one index serves all rows of a block's groups.
    """

    def run(batches):
        for table in whole_groups(batches, SLAB):
            node, label, block = (table.column(i).to_numpy() for i in (1, 2, 3))
            code = node.view(np.uint64)
            for k in np.unique(block).tolist():
                at = np.flatnonzero(block == k)
                index = GrayIndex(code[at], sum(edges[k]) % 64)
                known = label[at][index.order]
                got, own = index.components(bits, known=known), node[at][index.order]
                # the least node of a component stands for it, so that forests of other tasks meet in few steps
                low = np.full(len(own), np.iinfo(np.int64).max)
                np.minimum.at(low, got, own)
                to = low[got]
                keep = own != to
                yield _edge_batch(own[keep], to[keep])

    return run


def _wide_links(bits: int, similarity: float | None):
    """For rows (group, node, label, fp and, with a similarity, shingles): a spanning forest of each group's links."""

    def linked(node: np.ndarray, label: np.ndarray, code: np.ndarray, shingles) -> tuple[np.ndarray, np.ndarray]:
        node, first = np.unique(node, return_index=True)
        index = GrayIndex(code[first])
        order = first[index.order]
        alike = None
        if shingles is not None:
            own = [np.frombuffer(shingles[i].as_py(), "<u4") for i in order.tolist()]

            def alike(x: int, y: int) -> bool:
                small, large = sorted((len(own[x]), len(own[y])))
                return small >= similarity * large and set_similarity(own[x], own[y]) >= similarity

        got = index.components(bits, alike, label[order])
        own_node = node[index.order]
        keep = got != np.arange(len(got))
        return own_node[keep], own_node[got[keep]]

    def run(batches):
        for table in whole_groups(batches, SLAB if similarity is None else 64):
            group, node, label = (table.column(i).to_numpy() for i in range(3))
            shingles = None if similarity is None else table.column(4)
            start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            size = np.diff(np.append(start, len(group)))
            many = np.flatnonzero(size > 1)
            if not len(many):
                continue
            code = _codes(table.column(3))
            a, b = [], []
            if similarity is None:
                two = start[size == 2]
                near = two[(np.bitwise_count(code[two] ^ code[two + 1]).sum(1) <= bits) & (node[two] != node[two + 1])]
                a, b = [node[near]], [node[near + 1]]
                many = np.flatnonzero(size > 2)
            for at, n in zip(start[many].tolist(), size[many].tolist(), strict=True):
                x, y = linked(node[at : at + n], label[at : at + n], code[at : at + n], None if shingles is None else shingles.slice(at, n))
                a.append(x)
                b.append(y)
            yield _edge_batch(np.concatenate(a), np.concatenate(b))

    return run


def links(rows: DataFrame, run, limit: int, others: DataFrame | None = None, level: int = 0) -> DataFrame:
    """Edges (a, b), a > b, saved, that join what the links within each group of rows join.

    rows: group, node, label (known to be joined where equal; the node itself at first), columns that run reads, weight, and at a
    deeper level used (the keys that split it). run takes batches of whole groups. A group of more than limit weight is no task's: its rows are dealt out into blocks, each
    with the group's LEADERS least hashes beside it, so that near copies become one component. Rows outside the group's largest
    component (with all that this left apart) then meet the whole group: by the other keys that they share (others: node, keys),
    and from level REFINE on block by block, which is exact whatever the group's size. Only blocks' numbers are broadcast: one
    row for each limit of weight at most.
    """
    n = shuffle_count(rows.sparkSession)
    given = [c for c in rows.columns if c not in ("group", "weight", "used")]

    def dealt(df: DataFrame) -> DataFrame:
        return df.select("group", *given).repartition(n, "group").sortWithinPartitions("group").mapInArrow(run, LINK)

    big = saved_anew(rows.groupBy("group").agg(F.sum("weight").alias("total")).filter(F.col("total") > limit).select("group", F.ceil(F.col("total") / limit).cast("long").alias("blocks")))
    if big.isEmpty():
        return saved_anew(dealt(rows))
    small = rows.join(F.broadcast(big.select("group")), "group", "left_anti")
    large = saved_anew(rows.join(F.broadcast(big), "group").withColumn("spot", F.xxhash64("node", F.lit(level))))
    block = lambda b: F.xxhash64("group", b)
    row = F.struct("spot", *given, "blocks")
    leaders = large.groupBy("group", F.pmod("spot", F.lit(LEADERS)).alias("turn")).agg(F.min_by(row, "spot").alias("row")).select("group", "row.*")
    leaders = leaders.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("group", block(F.col("slot").cast("long"))).select("group", *given)
    members = large.withColumn("group", block(F.pmod(F.shiftright("spot", 8), F.col("blocks")))).select("group", *given)
    inner = saved_anew(dealt(members.unionByName(leaders)))
    found = dealt(small).unionByName(inner)
    # what is joined by now within these groups, labels that rows came with included
    came = large.filter("label <> node").select(F.greatest("label", "node").alias("a"), F.least("label", "node").alias("b"))
    roots = connected(inner.unionByName(came))
    placed = saved_anew(large.drop("label").join(roots.select("node", F.col("root").alias("label")), "node", "left").withColumn("label", F.coalesce("label", "node")))
    parts = placed.groupBy("group", "label").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    apart = saved_anew(parts.groupBy("group").agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.sum("w").alias("w"), F.max_by("w", F.struct("n", "label")).alias("w_most"), F.count("*").alias("k")).filter("k > 1").select("group", "most", F.ceil((F.col("w") - F.col("w_most")) / limit).cast("long").alias("turns")))
    if apart.isEmpty():
        return saved_anew(found)
    left = placed.join(F.broadcast(apart), "group").withColumn("minor", F.col("label") != F.col("most"))
    if others is not None and level < REFINE:
        used = F.col("used") if level else F.array("group")
        sub = left.withColumn("used", used).join(others, "node").withColumn("key", F.explode(F.array_except("keys", "used")))
        sub = sub.withColumn("group", F.xxhash64("group", "key")).withColumn("used", F.array_append("used", F.col("key")))
        unsettled = sub.filter("minor").select("group").distinct()
        sub = saved_anew(sub.join(unsettled, "group", "left_semi").select("group", *given, "weight", "used"))
        return saved_anew(found.unionByName(links(sub, run, limit, others, level + 1)))
    side = F.pmod(F.shiftright("spot", 8), F.col("blocks"))
    whole = left.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1))).withColumn("slot", side)
    minor = left.filter("minor").withColumn("turn", F.pmod(F.shiftright("spot", 24), F.col("turns"))).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = whole.unionByName(minor).withColumn("group", F.xxhash64("group", "turn", "slot")).select("group", *given)
    return saved_anew(found.unionByName(dealt(met)))


def forest(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Edges (a, b), a > b, that join what links of at most bits join among the distinct codes fp, found task by task."""
    edges = block_edges(bits)
    keys = F.array(*[F.struct(F.lit(k).alias("block"), F.expr(f"shiftrightunsigned(fp, {a}) & {(1 << w) - 1}L").alias("value")) for k, (a, w) in enumerate(edges)])
    keyed = fps.select("fp", F.explode(keys).alias("key"))
    rows = keyed.select((F.col("key.value") * len(edges) + F.col("key.block")).alias("group"), F.col("fp").alias("node"), F.col("fp").alias("label"), "key.block", F.lit(1).alias("weight"))
    return links(rows, _narrow_links(bits, edges), BLOCK_ROWS)


def _few_connected(edges: DataFrame) -> DataFrame:
    """As connected, in one task, for at most FEW edges."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            node, place = np.unique(np.concatenate([table.column(0).to_numpy(), table.column(1).to_numpy()]), return_inverse=True)
            label = joined(np.arange(len(node)), *np.split(place, 2))
            out = label != np.arange(len(node))
            yield pa.RecordBatch.from_pydict({"node": pa.array(node[out]), "root": pa.array(node[label[out]])})

    return edges.coalesce(1).mapInArrow(run, "node long, root long")


def connected(edges: DataFrame, most_steps: int | None = None) -> DataFrame:
    """node and root (the least node of its component) of every node with an edge, roots left out.

    Large-star and small-star alternate until the edges stay as they are; each round is cut off by a checkpoint. A node that has
    more than one in HOT of all edges is not joined by key: see keyed_join. Up to FEW edges take one task and no rounds. With
    most_steps it is an error if they have not settled by then.
    """
    edges = saved_anew(edges.distinct())
    known = None
    for step in itertools.count():
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now["n"] == 0 or (now["n"], now["s"]) == known:
            break
        if step == 0 and most_steps is None and now["n"] <= FEW:
            return _few_connected(edges)
        if step == most_steps:
            raise RuntimeError(f"components have not settled in {most_steps} rounds")
        known = now["n"], now["s"]
        both = edges.union(edges.select("b", "a"))
        least = saved_anew(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n"))
        large = keyed_join(both, least, "a", 2 * now["n"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = saved_anew(large)
        least = saved_anew(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
        small = keyed_join(large, least, "a", now["n"]).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = saved_anew(small.union(least.select("a", F.col("m").alias("b"))).distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def labelled(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """node, component_id and n of each of nodes (node, least, n), saved; roots as connected gives them."""
    roots = saved_anew(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()))
    members = roots.join(nodes, "node").select("node", "root", "least")
    ids = saved_anew(members.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")))
    linked = keyed_join(roots, ids, "root", roots.count()).select("node", "component_id", F.lit(True).alias("linked"))
    return saved_anew(nodes.join(linked, "node", "left").select("node", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"), "n"))


def components(df: DataFrame, bits: int = BITS, width: int = WIDTH) -> DataFrame:
    """doc_id, fp and component_id of each row of df."""
    own = saved_anew(fingerprints(df, width))
    nodes = saved_anew(own.groupBy(F.col("fp").alias("node")).agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    roots = connected(forest(nodes.select(F.col("node").alias("fp")), bits))
    placed = labelled(nodes, roots).withColumnRenamed("node", "fp")
    return keyed_join(own, placed, "fp", own.count()).select("doc_id", "fp", "component_id")


def op2(df: DataFrame) -> DataFrame:
    return components(df).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def places_apart(similarity: float, places: int = 64 * WIDE) -> int:
    """How many places of wide fingerprints may differ at such a share of common shingles, with a margin of 5 deviations."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(places * p + 5 * math.sqrt(places * p * (1 - p)))


def wide_fingerprints(df: DataFrame, width: int = NEAR_WIDTH) -> DataFrame:
    """doc_id, text_hash, fp (WIDE 64-bit words as bytes), keys (the least hashes of the shingles under KEYS orders), node and shingles of each row.

    All are of the set of shingles, so repeats count once. shingles holds the set's 32-bit hashes in order (a hash stands for two
    shingles of a pair of texts once in 2**32 / words), node is a 64-bit hash of the set.
    """

    def rows(part: pa.RecordBatch) -> dict:
        buf, off = buffers(part.column(1))
        s, e, at = words(_LOWER[buf], off)
        h = span_hashes(_LOWER[buf], s, e)
        n = np.diff(at)
        # shorter texts are one shingle; texts without words have one of their own
        size = np.maximum(1, n - width + 1)
        first = np.concatenate([[0], np.cumsum(size)])
        hashes = np.zeros(first[-1], np.uint64)
        long = n >= width
        wide = windows(h, width)
        hashes[np.repeat(long, size)] = wide[within(len(wide), at, width)]
        for i in np.flatnonzero(~long & (n > 0)).tolist():
            hashes[first[i]] = windows(h[at[i] : at[i + 1]], int(n[i]), 3)[0]
        sets = [np.unique(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        size = np.array([len(own) for own in sets], np.int64)
        first = np.concatenate([[0], np.cumsum(size)])
        hashes = np.concatenate(sets)
        fp, keys = np.empty((len(n), WIDE), np.uint64), np.empty((len(n), KEYS), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(WIDE):
                mixed = hashes if j == 0 else mix(hashes + np.uint64(j) * M1)
                bits = np.unpackbits(mixed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                count = np.add.reduceat(bits, first[:-1], axis=0, dtype=np.int32)
                fp[:, j] = np.packbits(count * 2 > size[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
            for j in range(KEYS):
                keys[:, j] = np.minimum.reduceat(mix(hashes ^ (np.uint64(j + 1) * M2)), first[:-1]) ^ np.uint64(j)
        node = np.array([xxhash.xxh64_intdigest(own.tobytes(), SEED) for own in sets], np.uint64).view(np.int64)
        kept = [np.unique((own >> np.uint64(32)).astype("<u4")).tobytes() for own in sets]
        return {"doc_id": part.column(0), "text_hash": part.column(2), "fp": pa.array([r.tobytes() for r in fp], pa.binary()), "keys": pa.array(keys.view(np.int64).tolist(), pa.list_(pa.int64())), "node": pa.array(node), "shingles": pa.array(kept, pa.binary())}

    return mapped(text_frame(df).withColumn("text_hash", F.xxhash64("text")), rows, "doc_id long, text_hash long, fp binary, keys array<long>, node long, shingles binary", 1 << 20)


def set_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shared members by all members of two sets in order, neither empty."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared)


def near_groups(df: DataFrame, similarity: float, width: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, text_hash and node of each row of df, and component_id and n of each node, under links between sets of shingles of at least that similarity.

    Nodes are known by a 64-bit hash of their sets. A component's id is its first row: (no doc_id, doc_id, text_hash), the least.
    """
    own = saved_anew(wide_fingerprints(df, width))
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    nodes = saved_anew(own.groupBy("node").agg(F.first("fp").alias("fp"), F.first("keys").alias("keys"), F.min(row).alias("least"), F.count("*").alias("n")))
    bits = places_apart(similarity)
    keyed = nodes.select(F.explode("keys").alias("group"), "node", F.col("node").alias("label"), "fp", F.lit(1).alias("weight"))
    wide = connected(links(keyed, _wide_links(bits, None), BLOCK_ROWS, nodes.select("node", "keys")))
    wide = saved_anew(wide.unionByName(wide.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("root", "group"))
    # copies are put together before the shuffle; then only nodes that have a candidate stay
    sets = saved_anew(own.groupBy("node").agg(F.first("fp").alias("fp"), F.first("shingles").alias("shingles")).join(wide, "node"))
    sets = sets.select("group", "node", F.col("node").alias("label"), "fp", "shingles", (F.length("shingles") + SET_BYTES).alias("weight"))
    return own.select("doc_id", "text_hash", "node"), labelled(nodes.select("node", "least", "n"), connected(links(sets, _wide_links(bits, similarity), BLOCK_BYTES)))


def near_components(df: DataFrame, similarity: float = SIMILARITY, width: int = NEAR_WIDTH) -> DataFrame:
    """doc_id and component_id (its least doc_id) of each row of df; see near_groups."""
    own, placed = near_groups(df, similarity, width)
    placed = placed.withColumn("component_id", F.col("component_id.doc_id"))
    return keyed_join(own, placed, "node", own.count()).select("doc_id", "component_id")


def keep_one(df: DataFrame, similarity: float = SIMILARITY, width: int = NEAR_WIDTH) -> DataFrame:
    """df with one row of each group of near copies: that of the least doc_id, then of the least hash of its text.

    Rows without doc_id are groups of their own, beside copies that have one. Of rows with equal doc_id and text any one stays.
    """
    keys = []
    for name in ("no_id", "id", "hash"):
        while name in df.columns:
            name += "_"
        keys.append(name)
    no_id, own_id, own_hash = keys
    rows, placed = near_groups(df, similarity, width)
    named = placed.filter("not component_id.nameless").select("component_id.doc_id", "component_id.text_hash").distinct()
    nameless = keyed_join(rows.filter("doc_id is null"), placed, "node", rows.count()).groupBy("component_id").agg(F.min("text_hash").alias("text_hash"))
    kept = named.unionByName(nameless.select(F.lit(None).cast("long").alias("doc_id"), "text_hash"))
    kept = kept.select(F.col("doc_id").isNull().alias(no_id), F.coalesce("doc_id", F.lit(0).cast("long")).alias(own_id), F.col("text_hash").alias(own_hash))
    number = F.col("doc_id").cast("long")
    own = df.withColumns({no_id: number.isNull(), own_id: F.coalesce(number, F.lit(0).cast("long")), own_hash: F.xxhash64(F.col("text").cast("string"))})
    # equal rows are put together before the shuffle, and the join keeps its partitions: texts move once
    return own.dropDuplicates(keys).join(kept, keys, "left_semi").select(*[f"`{c}`" for c in df.columns])
