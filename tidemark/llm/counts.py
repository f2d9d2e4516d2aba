"""Token counts of documents, kept in a cache under the digests of content and tokenizer.

The cache is a Parquet table (tokenizer digest as partition; content digest, count). Two
contents that differ in the white space between their words alone have the same count, so
the digest is that of the normalised content. Only distinct contents that the cache lacks
are encoded, each once, and their counts are appended.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Memo
from tidemark.llm.worker import kept

CACHE_SCHEMA = "content binary, n_tokens long, tokenizer string"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file: another version has another cache."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one blank, and none at its ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))


def counter(path: str) -> Memo:
    """Token counts of words, by the tokenizer's library. The tokenizer drops white space and
    never joins across it, so a text has the tokens of its words."""

    def make() -> Memo:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        return Memo(lambda word: len(library.encode(word, add_special_tokens=False).ids))

    return kept(("counter", path), make)


def encoded_counts(contents: DataFrame, path: str) -> DataFrame:
    """(content, n_tokens) of rows (content, text), the text being normalised."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).__getitem__
        for batch in batches:
            # rows that repeat with their id stand for one content
            texts = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            numbers = [sum(map(count, text.split(" "))) if text else 0 for text in texts.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(texts), pa.binary()), pa.array(numbers, pa.int64())], names=["content", "n_tokens"])

    return contents.select("content", "text").mapInArrow(run, "content binary, n_tokens long")


def cached(contents: DataFrame, cache: str, version: str) -> DataFrame:
    """(content, n_tokens) that the cache holds for a tokenizer version."""
    rows = contents.sparkSession.read.schema(CACHE_SCHEMA).parquet(cache)
    # runs that overlap may have appended a content twice, with one count
    return rows.where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(
    docs: DataFrame, path: str, cache: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) for each row of ``docs``.

    ``cache`` is a folder that all executors share; it is made if it is not there, and what
    was missing is in it when this returns. A null text counts as empty, with no bytes and
    no tokens; repeated rows and null ids are counted as they are; an empty table gives an
    empty result and leaves the cache as it is.
    """
    version = tokenizer_version(path)
    nothing = docs.sparkSession.createDataFrame([], CACHE_SCHEMA)
    nothing.write.mode("append").partitionBy("tokenizer").parquet(cache)
    text = F.col(text_col)
    digest = F.unhex(F.sha2(normalised(text), 256))
    rows = docs.select(
        F.col(id_col).alias("doc"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), digest.alias("content")
    )
    # one row stands for each content; the texts of the others are not moved any further
    stand = rows.groupBy("content").agg(F.min("doc").alias("doc")).join(cached(docs, cache, version), "content", "left_anti")
    stand = stand.select("content", F.col("doc").alias("_doc")).hint("shuffle_hash")
    texts = docs.select(F.col(id_col).alias("doc"), normalised(text).alias("text"))
    missing = texts.join(stand, F.col("doc").eqNullSafe(F.col("_doc")))
    # an id may have several texts
    missing = missing.where(F.unhex(F.sha2("text", 256)) == F.col("content"))
    fresh = encoded_counts(missing, path).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    fresh = fresh.withColumn("tokenizer", F.lit(version))
    fresh.write.mode("append").partitionBy("tokenizer").parquet(cache)
    counts = cached(docs, cache, version)
    return rows.join(counts, "content", "left").select(
        F.col("doc").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
