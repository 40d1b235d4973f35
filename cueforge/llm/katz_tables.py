"""The Katz model of katz as tables, of any order: train once, keep, and score other documents by joins.

unigrams (word, count, p), bigrams (order, history, word, count, p) and backoff (order, history, total, alpha) of the orders from
2 on, each with range, a hash of the word or history by which they are partitioned when written; totals has one row. A history is its
words joined by a space. A token's probability is that of its longest n-gram seen, times alpha of every longer history:
P_k(w | h) = p if h w was seen, else alpha(h) P_(k-1)(w | h without its first word), alpha 1 for a history not seen, and at last
the word's own p or the unknown word's. All steps are DataFrame functions; skewed joins are left to adaptive execution. katz.score
does all at once for one corpus and moves far less.

Null texts are empty. Rows with null or equal doc_ids are scored each. An empty table gives an untrained model, for which every token is
the unknown word. Other columns are not looked at, whatever their names. Very long texts are dealt out by token.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .katz import Discounts, K, Unigrams

#: No word holds white space, so these are no words.
START, END = "\n<s>", "\n</s>"
RANGES = 64
NAMES = ("unigrams", "bigrams", "backoff", "totals")


def tokens(df: DataFrame, order: int = 2) -> DataFrame:
    """doc (a number of the row), doc_id, word and h2 to h<order> (its histories) of each token, an end for each row."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = F.regexp_extract_all(F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), upper, upper.lower()), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    rows = df.select(F.monotonically_increasing_id().alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), words.alias("words"))
    ahead = F.concat(F.array(*[F.lit(START)] * (order - 1)), F.col("words"))
    rows = rows.select("doc", "doc_id", ahead.alias("ahead"), F.posexplode(F.concat(F.col("words"), F.array(F.lit(END)))).alias("at", "word"))
    # word i has the order - 1 entries of ahead from place i before it
    return rows.select("doc", "doc_id", "word", *[F.array_join(F.slice("ahead", F.col("at") + order - k + 1, k - 1), " ").alias(f"h{k}") for k in range(2, order + 1)])


@dataclass
class Tables:
    unigrams: DataFrame
    bigrams: DataFrame
    backoff: DataFrame
    totals: DataFrame

    def write(self, path: str, mode: str = "errorifexists") -> None:
        for name in NAMES:
            df = getattr(self, name)
            writer = df.write.mode(mode)
            (writer.partitionBy("range") if "range" in df.columns else writer).parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Tables:
        return cls(*(spark.read.parquet(f"{path}/{name}") for name in NAMES))


def _discount(d: Discounts, count: Column) -> Column:
    return F.when(count <= K, F.element_at(F.array(*map(F.lit, d.d.tolist())), F.least(count, F.lit(K)).cast("int"))).otherwise(1.0)


def _count_of_counts(df: DataFrame) -> np.ndarray:
    n = np.zeros(K + 1, np.int64)
    for r in df.filter(F.col("count") <= K + 1).groupBy("count").agg(F.count("*").alias("n")).collect():  # at most K + 1 rows
        n[r["count"] - 1] = r["n"]
    return n


def train(df: DataFrame, ranges: int = RANGES, order: int = 2) -> Tables:
    """Tables learned from every row of df."""
    if order < 2:
        raise ValueError("the order is 2 at least")
    rows = tokens(df, order)
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(ranges)).cast("int").alias("range")
    words = rows.groupBy("word").agg(F.count("*").alias("count"))
    total, types = words.agg(F.sum("count"), F.count("*")).first()
    u = Unigrams.of(total or 0, types or 0, _count_of_counts(words), 0, 1)
    unigrams = words.select("word", "count", (_discount(u.discounts, F.col("count")) * F.col("count") / F.lit(max(1, u.total)) * u.keep).alias("p"), place("word"))
    grams, backoffs = [], []
    below = unigrams.select(F.lit("").alias("shorter"), "word", F.col("p").alias("below"))
    for k in range(2, order + 1):
        pairs = rows.groupBy(F.col(f"h{k}").alias("history"), "word").agg(F.count("*").alias("count"))
        d = Discounts.good_turing(_count_of_counts(pairs))
        kept = _discount(d, F.col("count")) * F.col("count")
        # an n-gram's shorter one was seen too, so its p is in the table below
        shorter = F.lit("") if k == 2 else F.regexp_replace("history", "^[^ ]* ", "")
        sums = pairs.withColumn("shorter", shorter).join(below, ["word"] if k == 2 else ["shorter", "word"]).groupBy("history").agg(F.sum("count").alias("total"), F.sum(F.col("count") - kept).alias("left"), F.sum("below").alias("mass"))
        # where discounts leave nothing, one more event is set aside for words not seen
        full = F.col("left") <= 1e-9
        sums = sums.select("history", "total", F.when(full, F.col("total") / (F.col("total") + 1)).otherwise(1.0).alias("keep"), (F.when(full, 1 / (F.col("total") + 1)).otherwise(F.col("left") / F.col("total")) / (1 - F.col("mass"))).alias("alpha"))
        own = pairs.join(sums, "history").select(F.lit(k).alias("order"), "history", "word", "count", (kept / F.col("total") * F.col("keep")).alias("p"), place("history"))
        grams.append(own)
        backoffs.append(sums.select(F.lit(k).alias("order"), "history", "total", "alpha", place("history")))
        below = own.select(F.col("history").alias("shorter"), "word", F.col("p").alias("below"))
    totals = df.sparkSession.createDataFrame([(u.total, u.types, u.unknown, order)], "tokens long, types long, unknown double, order int")
    return Tables(unigrams, reduce(DataFrame.unionByName, grams), reduce(DataFrame.unionByName, backoffs), totals)


def score(df: DataFrame, model: Tables) -> DataFrame:
    """doc_id, n_tokens, n_known and score (log10 probability) of each row of df."""
    t = model.totals.first()
    unknown = t["unknown"] if t["tokens"] else 1.0
    rows = tokens(df, t["order"]).join(model.unigrams.select("word", F.col("p").alias("p1")), "word", "left")
    p = F.coalesce("p1", F.lit(unknown))
    for k in range(2, t["order"] + 1):
        own = F.col("order") == k
        rows = rows.join(model.bigrams.filter(own).select(F.col("history").alias(f"h{k}"), "word", F.col("p").alias(f"p{k}")), [f"h{k}", "word"], "left")
        rows = rows.join(model.backoff.filter(own).select(F.col("history").alias(f"h{k}"), F.col("alpha").alias(f"a{k}")), f"h{k}", "left")
        p = F.coalesce(f"p{k}", F.coalesce(f"a{k}", F.lit(1.0)) * p)
    return rows.groupBy("doc", "doc_id").agg(F.count("*").alias("n_tokens"), F.count("p1").alias("n_known"), F.sum(F.log10(p)).alias("score")).drop("doc")
