"""Language identification by error-correcting output codes.

Each language gets a binary codeword; one linear classifier per bit predicts that bit from hashed byte n-grams of the
lower-cased text (letters only, other ASCII as a space). Decoding sums the logistic loss of every bit's margin against
each codeword, weighted by how reliable the bit was in training, and takes the nearest codeword; a text whose two
nearest codewords are close is flagged as ambiguous.

Training takes at most max_per_language documents of each language, or fewer so that all are max_train; one of each language
at least, however many there are up to MOST_LANGUAGES. They are picked by a hash of doc_id and text, and rows with equal ones count once. Texts that are null or have no letter give `und`, score 0; so does everything when no
language can be learned. Repeated rows and rows with null or equal doc_ids each give their own row, an empty table none; ties between
codewords go to the first language. Very long texts are taken whole. Other columns are not looked at, or carried along by
keep_identified, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, mapped, mix, small_batches, text_frame

DIMENSIONS = 1 << 12
ORDERS = (1, 2, 3, 4)
#: Texts whose features are in memory at once.
BLOCK = 256
#: Bounds of the training sample: documents in all (unless there are more languages), and for one language.
MAX_TRAIN = 3000
MAX_PER_LANGUAGE = 600
#: More values of lang than this are no languages, and too many for the driver: an error.
MOST_LANGUAGES = 10_000
#: Texts whose decoding margin is below this are ambiguous.
AMBIGUOUS = 0.1
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def features(texts: pa.Array) -> np.ndarray:
    """A row of length 1 for each text: square roots of the n-gram shares."""
    buf, off = buffers(pc.utf8_lower(texts.fill_null("") if texts.null_count else texts))
    n = len(off) - 1
    out = np.zeros((n, DIMENSIONS), np.float32)
    a = np.maximum(1, np.diff(off))
    # blocks of texts keep the temporary arrays small
    at = 0
    while at < n:
        to = min(at + BLOCK, max(at + 1, int(np.searchsorted(off[1:], off[at] + (1 << 20), "right"))))
        b = _FOLD[buf[off[at] : off[to]]]
        own = off[at : to + 1] - off[at]
        doc = np.repeat(np.arange(to - at), np.diff(own))
        code = np.zeros(len(b), np.uint64)
        hits = np.zeros((to - at) * DIMENSIONS, np.float32)
        with np.errstate(over="ignore"):
            for k in range(1, max(ORDERS) + 1):
                m = len(b) - k + 1
                if m <= 0:
                    break
                code = code[:m] * np.uint64(257) + b[k - 1 :] + np.uint64(1)
                if k in ORDERS:
                    h = (mix(code + np.uint64(k << 56)) >> np.uint64(64 - 12)).astype(np.int64) + doc[:m] * DIMENSIONS
                    same = doc[:m] == doc[k - 1 :]
                    hits += np.bincount(h[same], minlength=len(hits)).astype(np.float32)
        out[at:to] = np.sqrt(hits.reshape(to - at, DIMENSIONS) / a[at:to, None])
        at = to
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


def codewords(k: int, length: int, seed: int = 7) -> np.ndarray:
    """k rows of +1 and -1, pairwise far apart: the best of many random draws, no column constant if k > 1."""
    if k < 2:
        return np.ones((k, 1), np.float32)
    rng, best, most = np.random.default_rng(seed), None, -1
    for _ in range(200):
        c = rng.integers(0, 2, (k, length)) * 2 - 1
        for j in range(length):
            while abs(c[:, j].sum()) == k:
                c[:, j] = rng.integers(0, 2, k) * 2 - 1
        d = (length - c @ c.T) // 2
        least = d[~np.eye(k, dtype=bool)].min()
        if least > most:
            best, most = c, least
    return best.astype(np.float32)


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(texts.fill_null("") if texts.null_count else texts, r"\pL").to_numpy(zero_copy_only=False).astype(bool)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    scale: float = 1.0

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        n = len(texts)
        letter = has_letter(texts)
        if not self.languages:
            return ["und"] * n, np.zeros(n), np.zeros(n, bool)
        # in blocks, as a slice of short texts has many rows of DIMENSIONS
        margin = np.concatenate([features(texts.slice(at, BLOCK)) @ self.weights + self.bias for at in range(0, n, BLOCK)] or [np.zeros((0, self.weights.shape[1]))])
        loss = np.stack([(np.logaddexp(0, -margin * c) * self.trust).sum(1) for c in self.codes], 1) / self.trust.sum()
        p = np.exp(-(loss - loss.min(1, keepdims=True)) * self.scale)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        top = np.sort(p, 1)[:, ::-1]
        gap = top[:, 0] - (top[:, 1] if p.shape[1] > 1 else 0)
        score = np.where(letter, np.clip(top[:, 0], 0, 1), 0.0)
        return [self.languages[b] if ok else "und" for b, ok in zip(best, letter, strict=True)], score, letter & (gap < AMBIGUOUS)


def fit(x: np.ndarray, y: list[str], steps: int = 100, seed: int = 7) -> Model:
    languages = sorted(set(y))
    k = len(languages)
    codes = codewords(k, max(15, 5 * int(np.ceil(np.log2(max(2, k))))), seed)
    if k < 2:
        return Model(languages, codes, np.zeros((DIMENSIONS, 1), np.float32), np.ones(1, np.float32), np.ones(1))
    row = np.array([languages.index(v) for v in y])
    target = codes[row]
    share = 1 / np.bincount(row)[row][:, None] / k
    w, b = np.zeros((DIMENSIONS, codes.shape[1]), np.float32), np.zeros(codes.shape[1], np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = -(target / (1 + np.exp(np.clip(target * (x @ w + b), -30, 30)))) * share
        gw = x.T @ g + 1e-6 * w
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        w -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        b -= 0.5 * g.sum(0)
    right = ((x @ w + b) * target > 0).mean(0)
    trust = np.clip(np.log(np.clip(right, 0.51, 0.999) / np.clip(1 - right, 0.001, 0.49)), 0.05, None)
    return Model(languages, codes, w.astype(np.float32), b.astype(np.float32), trust, scale=4.0)


def is_held_out(mod: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % mod == 0, F.lit(False))


def train(df: DataFrame, max_train: int = MAX_TRAIN, max_per_language: int = MAX_PER_LANGUAGE) -> Model:
    """Learns from text and lang of rows with a lang: of each language max_per_language of them, or its share of max_train; one at least."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("lang is not null")
    rows = rows.withColumn("draw", F.xxhash64("doc_id", "text", F.lit("train")))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("first")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"lang has more than {MOST_LANGUAGES} values")
    if not counts:
        return fit(np.zeros((0, DIMENSIONS), np.float32), [])
    each = max(1, min(max_per_language, max_train // len(counts)))
    # about each of the language's hashes are under its edge, and the least one is
    edges = [(r["lang"], max(r["first"], min((1 << 63) - 1, (1 << 64) * each // r["n"] - (1 << 63)))) for r in counts]
    under = df.sparkSession.createDataFrame(edges, "lang string, edge long")
    drawn = rows.join(F.broadcast(under), "lang").filter("draw <= edge").groupBy("lang", "draw").agg(F.first("text").alias("text")).select("draw", "text", "lang")

    def vectors(batches):
        from .common import slices

        for part in slices(batches):
            for at in range(0, part.num_rows, BLOCK):
                own = part.slice(at, BLOCK)
                x = features(own.column(1)).astype(np.float16)
                yield pa.RecordBatch.from_pydict({"draw": own.column(0), "lang": own.column(2), "x": pa.array([r.tobytes() for r in x], pa.binary())})

    got = drawn.mapInArrow(vectors, "draw long, lang string, x binary").toArrow().sort_by([("lang", "ascending"), ("draw", "ascending")])
    lang = got["lang"].to_pylist()
    # those over each, which chance has let under the edge, go by their hash
    kept = [i for i, v in enumerate(lang) if i < each or lang[i - each] != v]
    got = got.take(kept)
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float16).reshape(-1, DIMENSIONS).astype(np.float32)
    return fit(x, got["lang"].to_pylist())


def identify(df: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous for each row of df; only the text is looked at."""
    spread = df.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS x code length floats, whatever the input

    def rows(part: pa.RecordBatch) -> dict:
        lang, score, doubt = spread.value.predict(part.column(1))
        return {"doc_id": part.column(0), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64()), "ambiguous": pa.array(doubt, pa.bool_())}

    return mapped(text_frame(df), rows, "doc_id long, lang_pred string, score double, ambiguous boolean", 1 << 21)


def op9(df: DataFrame, folds: int = 5) -> DataFrame:
    """Predicts every row; learns from labelled rows outside the held-out fold."""
    model = train(df.filter(~is_held_out(folds)))
    out = identify(df, model)
    return out.select("doc_id", is_held_out(folds).alias("held_out"), "lang_pred", "score", "ambiguous")


def keep_identified(df: DataFrame, model: Model | None = None) -> DataFrame:
    """df without the rows whose language can't be told: no letters, or ambiguous, which no score at or over chance makes up for.

    All columns are kept; lang is filled from the prediction where it is null. Where no row has a lang there is no language to tell,
    so only texts without letters go, and lang stays null.
    """
    spread = df.sparkSession.sparkContext.broadcast(model or train(df))
    at, names = small_batches(df).columns.index("text"), df.columns

    def run(batches):
        from .common import slices

        order = [at, *(i for i in range(len(names)) if i != at)]
        for batch in batches:
            if batch.num_rows:
                # slices looks at column 1
                first = batch.select([order[1] if len(order) > 1 else at, at])
                begin = 0
                for part in slices(iter([first]), 1 << 21):
                    lang, _, doubt = spread.value.predict(part.column(1))
                    keep = has_letter(part.column(1)) & ~doubt
                    own = batch.slice(begin, part.num_rows)
                    begin += part.num_rows
                    if "lang" in names and spread.value.languages:
                        i = names.index("lang")
                        own = own.set_column(i, "lang", pc.coalesce(own.column(i), pa.array(lang, own.column(i).type)))
                    yield own.filter(pa.array(keep))

    return df.mapInArrow(run, df.schema)
