"""The corpus pipeline: language ID, near-duplicates, decontamination, secrets, token ids.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.
All but the last return the columns of ``documents``; the last returns the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontam, langid, neardup, secrets
from tidemark.llm.queries import BYTE_BPE, language_model, read
from tidemark.session import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the learnt languages, or without letters, go."""
    return langid.keep_known(docs, language_model(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or an edited copy of one, go."""
    return decontam.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are masked, and n_chars follows."""
    return secrets.redact(docs, chars_col="n_chars")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids): ids are packed little-endian 32-bit integers."""
    keyed = docs.select(F.struct("doc_id", "lang", "source").alias("doc"), "text")
    # the stages before leave less of an executor's memory than the operator alone has
    return bpe.encode(keyed, BYTE_BPE, id_col="doc", pieces=60_000).select(
        "doc.*", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids"
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("token_ids", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage ends as a table in shared scratch space."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
