"""Shared helpers: Arrow text slices, vectorised word and window hashes, packed chunks.

All helpers treat a null text as empty and never look at a prefix: a slice holds whole texts.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes of text that a worker handles at once, unless one text alone is longer.
SLICE_BYTES = 4 << 20
BATCH_BYTES = 4 << 20
#: White space of the word rule [^\x20\x09-\x0D]+; all other bytes, UTF-8 tails included, are word bytes.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

M1 = np.uint64(0x9E3779B97F4A7C15)
M2 = np.uint64(0xBF58476D1CE4E5B9)
M3 = np.uint64(0x94D049BB133111EB)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, else the context's own checkpoint folder.

    Where neither is set, a temporary folder for a local master (tests); on a cluster, whose executors share no local folders, an error.
    """
    set_dir, own = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext._jsc.sc().getCheckpointDir()
    if not set_dir and own.isDefined():
        return own.get()
    if not set_dir:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        set_dir = "file://" + os.path.join(tempfile.gettempdir(), "cueforge-checkpoints")
    if not own.isDefined():
        spark.sparkContext.setCheckpointDir(set_dir)
    return set_dir


def saved(df: DataFrame) -> DataFrame:
    """df, computed once and read from the shared checkpoint folder from then on."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def saved_anew(df: DataFrame) -> DataFrame:
    """As saved, but its size is unknown to Spark's estimates, as that of a plain RDD.

    A checkpoint keeps the estimate of the plan that it cuts off, and a join's is the product of its sides'. Over rounds of joins
    the estimate gets numbers of millions of digits, which fill the driver's memory.
    """
    df = saved(df)
    spark, plan = df.sparkSession, df._jdf.queryExecution().analyzed()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(plan.rdd(), df._jdf.schema(), False), spark)


def small_batches(df: DataFrame) -> DataFrame:
    """df; from now on Arrow batches between Spark and Python have at most BATCH_BYTES, unless the session has set any bound.

    Plans read the setting when they run, so it stays set.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in df.sparkSession.conf.getAll:
        df.sparkSession.conf.set(name, str(BATCH_BYTES))
    return df


def text_frame(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text, under fixed names, so that other columns can't clash."""
    return small_batches(df).select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type) and not pa.types.is_large_binary(texts.type):
        texts = texts.cast(pa.large_binary() if pa.types.is_binary(texts.type) else pa.large_string())
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, cut so that the texts (column 1) of a slice have at most limit bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = buffers(batch.column(1))[1][1:]
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """As slices, but small batches are put together until limit is reached."""
    held, size = [], 0
    for part in slices(batches, limit):
        n = int(buffers(part.column(1))[1][-1])
        if held and size + n > limit:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
        held.append(part)
        size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def mapped(df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: str, limit: int = SLICE_BYTES) -> DataFrame:
    """rows(slice) gives the columns of schema, in its order, for each slice of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit):
            yield pa.RecordBatch.from_pydict(rows(part))

    return df.mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= M2
    x ^= x >> np.uint64(27)
    x *= M3
    x ^= x >> np.uint64(31)
    return x


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of all texts, and n + 1 offsets into them by text."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~SPACE[buf]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | first[1:-1]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, offsets)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes at a time."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    load = np.ndarray((len(buf) + 1,), "<u8", padded.data, 0, (1,))
    size = (end - start).astype(np.int64)
    with np.errstate(over="ignore"):
        h = mix(size.astype(np.uint64) * M1 + np.uint64(seed))
        todo, at = np.arange(len(start)), 0
        while len(todo):
            left = size[todo] - at
            x = load[start[todo] + at]
            keep = np.minimum(left, 8).astype(np.uint64) * np.uint64(8)
            x = np.where(left >= 8, x, x & ((np.uint64(1) << (keep & np.uint64(63))) - np.uint64(1)))
            h[todo] = mix((h[todo] ^ x) * M1)
            at += 8
            todo = todo[left > 8]
    return h


def windows(h: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hash of every run of width consecutive words; entry p stands for words p to p + width - 1."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    base = int(mix(np.array([seed], np.uint64))[0]) | 1
    power = lambda k: np.uint64(pow(base, k, 1 << 64))
    with np.errstate(over="ignore"):
        out, done, block, size = None, 0, mix(h ^ np.uint64(seed)), 1
        while True:
            if width & size:
                if done == 0:
                    out = block.copy()
                else:
                    m = len(h) - (done + size) + 1
                    out = out[:m] * power(size) + block[done : done + m]
                done += size
            if done == width:
                return mix(out[: len(h) - width + 1])
            block = block[:-size] * power(size) + block[size:]
            size *= 2


def within(n: int, offsets: np.ndarray, width: int) -> np.ndarray:
    """Which of n window starts have all their width words in one text."""
    ok = np.ones(max(0, n), bool)
    for back in range(1, width):
        at = offsets[1:] - back
        at = at[(at >= 0) & (at < n)]
        ok[at] = False
    return ok


def squeeze(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=6).compress(np.ascontiguousarray(a).tobytes())


def unsqueeze(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def narrow(a: np.ndarray) -> bytes:
    """Non-negative integers in the least whole bytes each that hold them all, by byte plane, compressed."""
    a = np.ascontiguousarray(a, np.uint64)
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def widen(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8).reshape(b[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : b[0]] = planes.T
    return out.reshape(-1).view(np.uint64)


def ascending(a: np.ndarray) -> bytes:
    """Sorted 64-bit values as their differences."""
    return narrow(np.diff(a, prepend=np.uint64(0)))


def unascending(b: bytes) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(widen(b), dtype=np.uint64)


CHUNK = "chunk long, n_words long, rest binary, lengths binary, blob binary"


def chunks(df: DataFrame, chunk_bytes: int, text: str = "text") -> DataFrame:
    """Rows of many whole documents each: their other columns, byte lengths (-1: null) and compressed texts.

    A chunk's number comes from the input partition and the place in it. The result is checkpointed, so later passes
    see the same chunks whatever executors are lost.
    """
    others = [c for c in small_batches(df).columns if c != text]
    df = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)), F.col(f"`{text}`").cast("string").alias("text"))
    place = len(others)

    def run(batches):
        from pyspark import TaskContext

        def turned():
            for b in batches:
                own = b.select([*range(place), place])
                yield own.select([0, place, *range(1, place)]) if place else pa.RecordBatch.from_arrays([own.column(0), own.column(0)], ["none", "text"])

        part = TaskContext.get().partitionId() << 32
        for k, table in enumerate(gathered(turned(), chunk_bytes)):
            buf, off = buffers(table.column(1))
            lengths = np.where(table.column(1).is_null().to_numpy(), -1, np.diff(off))
            rest = pa.BufferOutputStream()
            with pa.ipc.new_stream(rest, (kept := table.drop_columns([table.column_names[1]])).schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(kept)
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([part + k], pa.int64()), "n_words": pa.array([len(words(buf, off)[0])], pa.int64()), "rest": pa.array([rest.getvalue().to_pybytes()], pa.binary()), "lengths": pa.array([narrow(lengths + 1)], pa.binary()), "blob": pa.array([squeeze(buf)], pa.binary())})

    return saved(df.mapInArrow(run, CHUNK))


class Chunk:
    """A row of chunks: texts' bytes and offsets, nulls, and the other columns."""

    def __init__(self, row: dict):
        lengths = widen(row["lengths"]).astype(np.int64) - 1
        self.null = lengths < 0
        self.offsets = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
        self.buf = unsqueeze(row["blob"], np.uint8)
        self.number = row["chunk"]
        self._rest = row["rest"]

    @property
    def rest(self) -> pa.Table:
        return pa.ipc.open_stream(self._rest).read_all()


def bits_of(a: np.ndarray) -> bytes:
    return squeeze(np.packbits(a))


def bits_from(b: bytes, n: int) -> np.ndarray:
    return np.unpackbits(unsqueeze(b, np.uint8), count=n).astype(bool)


#: A key with more than one in HOT of all rows is hot; fewer than HOT keys can be.
HOT = 1000


def keyed_join(left: DataFrame, right: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of left with right, whose keys are unique and whose column n tells how many rows of left have the key.

    Rows of hot keys stay where they are: the fewer than HOT rows of right that they need are broadcast. The others are
    joined by key. right should be saved, as it is read three times.
    """
    hot = right.filter(F.col("n") > total / HOT).drop("n")
    rest = right.filter(F.col("n") <= total / HOT).drop("n")
    return left.join(F.broadcast(hot), key).unionByName(left.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key))


def shuffle_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
