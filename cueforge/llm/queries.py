"""The registered queries of this subpackage: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprint, katz, langid, media, oracles, packing, pieces, pii, secrets, simhash, substring
from .common import documents


def op1_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.op1(documents(spark, sf_dir)).drop("n_chunks")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op2(documents(spark, sf_dir))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.op3(documents(spark, sf_dir))


def op4_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.segment(documents(spark, sf_dir), n=4)


def op5_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), special=True)


def op6_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.op6(documents(spark, sf_dir))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, sf_dir))


def op8_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.op8(documents(spark, sf_dir))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op9(documents(spark, sf_dir))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


# What SQL can say of three more: columns of the same operators' rows, for their oracles.


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op6_bottom_k without sketches."""
    return op6_bottom_k(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def base_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op7_personal_data without what the transducer adds."""
    return op7_personal_data(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8_katz with scores rounded, as sums in another order differ in their last places."""
    rows = op8_katz(spark, sf_dir)
    return rows.withColumns({c: F.round(c, 3) for c in ("base_score", "score")})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (edited_texts, base_identifiers, katz_scores, op1_media_chunks, op2_simhash, op3_repeats, op4_nbest_pieces, op5_pack_tokens, op6_bottom_k, op7_personal_data, op8_katz, op9_language, op10_secrets)}
OP3_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
 win AS (SELECT doc_id, i, md5(array_to_string(words[i : i + 34], ' ')) AS h FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w)),
 again AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
 gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM win JOIN again USING (h)),
 word AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM w),
 kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(len(w.words) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""
ORACLE_SQL: dict[str, str] = {"op1_media_chunks": oracles.MEDIA, "op3_repeats": OP3_SQL, "edited_texts": oracles.EDITS, "base_identifiers": oracles.BASE_SPANS, "katz_scores": oracles.KATZ}
