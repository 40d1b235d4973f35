"""Packing: concatenate and cut.

Pass one tokenizes each document once, in whatever order its partition has, and keeps each document's place within its
partition. Partition totals (one number a task) give every partition its global offset by a prefix sum; pass two cuts the
stream of all tokens into fixed windows. A document over a window's edge gives one boundary record per piece. Only the
last sequence of all is not full.

Null texts are empty and hold the end id alone. Repeated rows and rows with equal or null doc_ids are packed each; a very long text has
as many pieces as windows it reaches. An empty table has no pieces. Other columns are not looked at, whatever their names. Ids are
those of the tokenizers library.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, slices, text_frame

WINDOW = 2048
END_ID = 1


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the vocabulary file is: in the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts by a tokenizers file. Strings of special tokens are ordinary text, or with special the tokens' own ids.

    Texts of Latin letters, on whose character classes all libraries agree, take the same vocabulary's rank file, whose
    merges give the same ids in a fifth of the time (tests hold the two together). Other texts take the file itself.
    """

    loaded: dict[tuple[str, bool], Encoder] = {}
    plain = re.compile(r"[^\t-\r -~\xa1-\u024f‐-‧€]")

    def __init__(self, path: str, special: bool = False):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        # the rank file knows no added tokens, so texts that hold one's string go to the tokenizers file
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.slow = re.compile("|".join([self.plain.pattern, *map(re.escape, added)]))
        self.fast = self._ranks(path.removesuffix(".json") + ".tiktoken")

    @staticmethod
    def _ranks(path: str):
        import public_tokenizers
        import tiktoken

        if not os.path.exists(path):
            return None
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.fast is not None and not self.slow.search(text):
            return array("I", self.fast(text)).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    @classmethod
    def get(cls, path: str, special: bool = False) -> Encoder:
        if (path, special) not in cls.loaded:
            cls.loaded[path, special] = cls(path, special)
        return cls.loaded[path, special]


def tokenized(df: DataFrame, path: str | None = None, end_id: int = END_ID, special: bool = False) -> DataFrame:
    """part, at (tokens of the partition before it), doc_id, n (with the end id), ids."""
    path = path or tokenizer_path()

    def run(batches):
        from pyspark import TaskContext

        part, at, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4").tobytes()
        encoder = Encoder.get(path, special)
        for rows in slices(batches):
            ids = [encoder.ids(t or "") + end for t in rows.column(1).to_pylist()]
            n = np.array([len(i) // 4 for i in ids], np.int64)
            ends = at + np.cumsum(n)
            # ids of a vocabulary under 65,536 are kept in two bytes each
            kept = [i if (a := np.frombuffer(i, "<u4")).max() > 65535 else b"\0" + a.astype("<u2").tobytes() for i in ids]
            yield pa.RecordBatch.from_pydict({"part": pa.array(np.full(len(n), part), pa.int64()), "at": pa.array(ends - n), "doc_id": rows.column(0), "n": pa.array(n), "ids": pa.array(kept, pa.binary())})
            at = int(ends[-1])

    return text_frame(df).mapInArrow(run, "part long, at long, doc_id long, n long, ids binary")


def unpacked(kept: bytes) -> np.ndarray:
    return np.frombuffer(kept, "<u2", offset=1).astype("<u4") if len(kept) % 2 else np.frombuffer(kept, "<u4")


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(df: DataFrame, window: int = WINDOW, path: str | None = None, end_id: int = END_ID, with_ids: bool = False, special: bool = False) -> DataFrame:
    """A row for each piece: PIECES, and with with_ids the piece's ids.

    special: a special token's string in a text becomes the token's id, as in a plain call of the tokenizer; else it is ordinary text, so
    that no document can write an end of text. The driver holds one total per partition of df, nothing by document.
    """
    tokens = saved(tokenized(df, path, end_id, special))
    totals = sorted((r["part"], r["n"]) for r in tokens.groupBy("part").agg(F.sum("n").alias("n")).collect())
    before, base = 0, {}
    for part, n in totals:
        base[part] = before
        before += n

    def cut(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for part, at, doc, n, kept in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                ids, place, start = unpacked(kept), base[part] + at, 0
                while start < n:
                    offset = (place + start) % window
                    length = min(n - start, window - offset)
                    own = ids[start : start + length].tobytes()
                    for col, v in zip(cols, (doc, start, length, zlib.crc32(own), n, (place + start) // window, offset, own), strict=True):
                        col.append(v)
                    start += length
            types = [pa.int64()] * 7 + [pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            out = {name: pa.array(c, t) for name, c, t in zip(names, cols, types, strict=True)}
            if not with_ids:
                del out["ids"]
            yield pa.RecordBatch.from_pydict(out)

    return tokens.mapInArrow(cut, PIECES + ", ids binary" * with_ids)
