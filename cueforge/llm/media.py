"""Media columns: content-defined payload chunking with a deduplicated chunk store.

A text's UTF-8 bytes, padded with spaces to a positive multiple of 192, are the samples of an 8-bit mono WAVE file. A
rolling gear hash over the payload cuts it where the hash's low bits are zero, between a least and a most chunk length.
Chunks go by digest: Spark joins keep one copy of each in the store, a manifest lists a medium's digests in order, and a
medium is put together from its manifest, every chunk and the whole checked by digest, before features are computed.

Null texts are empty (one payload block of spaces). Equal texts share one medium. A wrong chunk raises an error. Rows with null or equal
doc_ids each give their row; an empty table none. A very long text has as many chunks as it needs; they meet in the task that puts the
medium together. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT, buffers, mapped, mix, saved, slices, text_frame

BLOCK = 192
RATE = 8000
LEAST, MEAN, MOST = 1 << 11, 1 << 13, 1 << 15
SPREAD = 64
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def header(n: int) -> bytes:
    """The 44 bytes before n samples of 8-bit mono at RATE."""
    i4 = lambda v: int(v % (1 << 32)).to_bytes(4, "little")
    return b"RIFF" + i4(36 + n) + b"WAVEfmt " + i4(16) + b"\1\0\1\0" + i4(RATE) + i4(RATE) + b"\1\0\x08\0" + b"data" + i4(n)


def payload(text: bytes) -> bytes:
    return text + b" " * (-len(text) % BLOCK if text else BLOCK)


def cuts(data: np.ndarray, least: int = LEAST, mean: int = MEAN, most: int = MOST) -> list[int]:
    """Ends of data's chunks. The hash at a byte depends on the 32 bytes up to it, so cuts move along with the content."""
    n = len(data)
    if n <= least:
        return [n]
    h, width = _GEAR[data], 1
    while width < 32:  # h[i] = sum of gear[data[i - k]] << k over the window, by doubling
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    spots = np.flatnonzero((h >> np.uint32(32 - (mean.bit_length() - 1))) == 0) + 1
    out, at = [], 0
    while n - at > least:
        i = np.searchsorted(spots, at + least)
        end = min(int(spots[i]) if i < len(spots) else n, at + most, n)
        out.append(end)
        at = end
    if at < n:
        out.append(n)
    return out


def digest(b: bytes) -> bytes:
    return hashlib.blake2b(b, digest_size=16).digest()


def _payloads(part: pa.RecordBatch):
    buf, off = buffers(part.column(1))
    raw = memoryview(buf)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        yield b - a, payload(bytes(raw[a:b]))


def manifests(df: DataFrame) -> DataFrame:
    """A row for each row of df: doc_id, n_bytes, medium (digest of the payload), size, and the chunks' digests in order."""

    def rows(part: pa.RecordBatch) -> dict:
        cols: list[list] = [[], [], [], []]
        for n, data in _payloads(part):
            ends = cuts(np.frombuffer(data, np.uint8))
            own = [digest(data[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            for c, v in zip(cols, (n, digest(data), len(data), own), strict=True):
                c.append(v)
        types = (pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.binary()))
        return {"doc_id": part.column(0), **{k: pa.array(c, t) for k, c, t in zip(("n_bytes", "medium", "size", "digests"), cols, types, strict=True)}}

    return mapped(text_frame(df), rows, "doc_id long, n_bytes long, medium binary, size long, digests array<binary>")


def chunk_store(df: DataFrame) -> DataFrame:
    """digest and compressed bytes of every distinct chunk. A task sends each of a slice's chunks once."""

    def run(batches):
        z = zstandard.ZstdCompressor(level=6)
        for part in slices(batches):
            found: dict[bytes, bytes] = {}
            for _, data in _payloads(part):
                ends = cuts(np.frombuffer(data, np.uint8))
                for a, b in zip([0, *ends[:-1]], ends, strict=True):
                    if (d := digest(own := data[a:b])) not in found:
                        found[d] = z.compress(own)
            yield pa.RecordBatch.from_pydict({"digest": pa.array(found.keys(), pa.binary()), "bytes": pa.array(found.values(), pa.binary())})

    return text_frame(df).mapInArrow(run, "digest binary, bytes binary").groupBy("digest").agg(F.first("bytes").alias("bytes"))


def wave_features(samples: np.ndarray) -> str:
    """Mean, root mean square about the middle, zero crossings and entropy of 8-bit samples."""
    x = samples.astype(np.float64) - 128
    p = np.bincount(samples, minlength=256) / max(1, len(samples))
    p = p[p > 0]
    crossings = int((np.diff(np.signbit(x)) != 0).sum())
    return f"mean={x.mean():.6f};rms={np.sqrt((x * x).mean()):.6f};crossings={crossings};entropy={-(p * np.log2(p)).sum():.6f}"


MEDIUM = "medium binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_chunks long"


def _read_back(medium: bytes, size: int, parts: list[tuple[bytes, bytes]]) -> tuple:
    z = zstandard.ZstdDecompressor()
    out = []
    for want, kept in parts:
        if kept is None or digest(own := z.decompress(kept)) != want:
            raise ValueError(f"chunk {want.hex()} is missing or damaged")
        out.append(own)
    media = header(size) + b"".join(out)
    data = media[44:]  # the samples, as a reader of the file gets them
    if len(data) != int.from_bytes(media[40:44], "little") or digest(data) != medium:
        raise ValueError(f"medium {medium.hex()} is damaged")
    return medium, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(media), hashlib.sha256(media).hexdigest(), wave_features(np.frombuffer(data, np.uint8)), len(parts)


def _media_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = [x.split()[0] for x in MEDIUM.split(", ")]
    return pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types, strict=True))})


def reconstruct(listed: DataFrame, store: DataFrame) -> DataFrame:
    """MEDIUM rows of distinct media (medium, size, digests) from the store.

    A medium of one chunk is read where the store has it; longer ones bring their chunks together by medium.
    """
    wanted = listed.select("medium", "size", F.size("digests").alias("n"), F.posexplode("digests").alias("place", "digest"))
    # chunks that very many media share (fewer than HOT can be) are broadcast, so that no task serves all of one
    counts = wanted.groupBy("digest").agg(F.count("*").alias("n_media"))
    total = counts.agg(F.sum("n_media")).first()[0] or 0
    hot = saved(counts.filter(F.col("n_media") > total / HOT).select("digest"))
    hot_store = store.join(F.broadcast(hot), "digest")
    few = wanted.join(F.broadcast(hot), "digest", "left_anti").join(store, "digest", "left")
    many_media = wanted.join(F.broadcast(hot), "digest", "left_semi").join(F.broadcast(hot_store), "digest", "left")
    joined = few.unionByName(many_media).select("medium", "size", "n", "place", "digest", "bytes")

    def longer(key, table):
        rows = sorted(table.select(["place", "size", "digest", "bytes"]).to_pylist(), key=lambda r: r["place"])
        return pa.Table.from_batches([_media_batch([_read_back(key[0].as_py(), rows[0]["size"], [(r["digest"], r["bytes"]) for r in rows])])])

    one = joined.filter("n = 1")
    many = joined.filter("n > 1")

    def only(batches):
        for batch in batches:
            if batch.num_rows:
                yield _media_batch([_read_back(r["medium"], r["size"], [(r["digest"], r["bytes"])]) for r in batch.to_pylist()])

    return one.mapInArrow(only, MEDIUM).unionByName(many.groupBy("medium").applyInArrow(longer, MEDIUM))


def op1(df: DataFrame) -> DataFrame:
    """Every row's payload, stored in chunks and read back. Media are read once however many rows share them.

    The rows of a medium that more than one in HOT of all share are dealt out over SPREAD copies of its row.
    """
    listed = saved(manifests(df))
    distinct = listed.groupBy("medium").agg(F.first("size").alias("size"), F.first("digests").alias("digests"))
    media = reconstruct(distinct, chunk_store(df))
    hot = saved(listed.groupBy("medium").agg(F.count("*").alias("n")).filter(F.col("n") > listed.count() / HOT).select("medium", F.lit(SPREAD).alias("copies")))
    with_copies = lambda rows: rows.join(F.broadcast(hot), "medium", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    own = with_copies(listed.select("doc_id", "n_bytes", "medium")).withColumn("copy", F.pmod(F.monotonically_increasing_id(), "copies").cast("int"))
    media = with_copies(media).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    return own.drop("copies").join(media, ["medium", "copy"]).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_chunks")
