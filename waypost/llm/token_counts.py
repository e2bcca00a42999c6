"""Token counts through a digest cache.

The cache is a Parquet table of (tokenizer digest, text digest, count). Texts are
joined to it by the two digests; only distinct texts that it lacks are encoded, and
their counts are appended. Content is normalised only in that null counts as empty:
any further change could change a count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost.llm.tokenizing import counter
from waypost.workspace import settle

CACHE = "digest binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """The version of a tokenizer: the SHA-256 of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def content(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(content(text), "UTF-8"), 256))


def _cached(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def _counting(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count_tokens = counter(path)
        for batch in batches:
            counts = pa.array(count_tokens(batch.column(1)), pa.int64())
            yield pa.record_batch([batch.column(0), counts], ["digest", "n_tokens"])

    return count


def fill_cache(docs: DataFrame, text_col: str, tokenizer: str, cache: str) -> str:
    """Adds the counts of texts that the cache lacks; returns its folder for this tokenizer.

    A text is encoded once, however many rows have it: copies are combined before the
    shuffle and after it.
    """
    folder = f"{cache.rstrip('/')}/tokenizer={tokenizer_digest(tokenizer)}"
    texts = docs.select(_digest(F.col(text_col)).alias("digest"), content(F.col(text_col)).alias("text"))
    known = _cached(docs.sparkSession, folder)
    misses = texts.dropDuplicates(["digest"]).join(known, "digest", "left_anti")
    misses.mapInArrow(_counting(tokenizer), CACHE).write.mode("append").parquet(folder)
    return folder


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
) -> DataFrame:
    """Per row of ``docs`` its id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    ``tokenizer`` is a byte-level ``tokenizers`` file that all executors can open;
    counts are without added special tokens, while special strings inside a text count
    as the library takes them. ``cache`` is a folder that all executors share. A null
    text is empty: 0 bytes, 0 tokens. Repeated rows and null ids come out as often as
    they went in, other columns are not read, and no rows give no rows. Two runs that
    add to one cache at a time may both store a count; it is the same and is read once.
    """
    folder = fill_cache(docs, text_col, tokenizer, cache)
    # Written, so that the join can split the rows of a text that very many have.
    counts = settle(docs.sparkSession.read.schema(CACHE).parquet(folder).dropDuplicates(["digest"]), "counts")
    slim = docs.select(
        F.col(id_col),
        F.octet_length(content(F.col(text_col))).cast("long").alias("n_bytes"),
        _digest(F.col(text_col)).alias("digest"),
    )
    return slim.join(counts, "digest").select(
        id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
