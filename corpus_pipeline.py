"""A corpus pipeline: language, near copies, repeated passages, secrets, then packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the columns
of documents: language ID drops documents whose language can't be told and near-dedup keeps one of each group; the passages and
secrets that the next two find leave the texts. The last returns the pieces of packed sequences.

Null and empty texts have no language and go in the first stage, unless no row has a lang: then no language can be told, and only texts
without letters go. Repeated rows are copies, of which one stays. Null doc_ids stay, as rows of their own. An empty table passes
through as such. Columns besides doc_id, text, lang and n_chars are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cueforge.llm import langid, packing, secrets, simhash, substring
from cueforge.llm.common import documents, shared_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.without_repeats(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, special=True)


STAGES = [("language_id", language), ("simhash_near_dedup", near_copies), ("substring_dedup", repeated_passages), ("secret_scan", secret_scan), ("pack", pack)]

#: SQL can't train the classifiers or read a tokenizer's vocabulary; tests hold the stages against brute force.
ORACLE_SQL = None


def removed(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet to the shared folder and read again by the next.

    A stage's folder goes once the next one's is there; that of the last but one stays, as the result is read from it.
    """
    import uuid

    base = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs, done = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        if done:
            removed(spark, done)
        done = f"{base}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
