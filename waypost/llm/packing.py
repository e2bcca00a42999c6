"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two, longest first:
as many of the longest length as fit, then one for each binary digit of the rest.
Every piece is a sequence of its own, so no sequence crosses documents and none needs
padding; a training job takes its batches from one length at a time. This needs no
shuffle at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost.llm.batches import in_slices
from waypost.llm.tokenizing import encoder

#: Longest sequence, a power of two.
LONGEST = 2048

#: Id that ends each document.
END_ID = 1

#: Bytes of ids in one Arrow batch.
BATCH_BYTES = 4_000_000


def cuts(n: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of ``n`` ids."""
    lengths = [longest] * (n // longest)
    size, rest = longest >> 1, n % longest
    while size:
        if rest & size:
            lengths.append(size)
        size >>= 1
    return lengths


def _packing(tokenizer: str, longest: int, end_id: int, id_type: pa.DataType):
    names = ["id", "start", "length", "ids", "doc_tokens"]
    types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            columns = zip(*rows)
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for doc, encoded in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                encoded += end
                start, tokens = 0, len(encoded) // 4
                for length in cuts(tokens, longest):
                    rows.append((doc, start, length, encoded[4 * start : 4 * (start + length)], tokens))
                    start += length
                    held += 4 * length + 40
                    if held > BATCH_BYTES:
                        yield flush()
                        rows, held = [], 0
        if rows:
            yield flush()

    return pack


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = LONGEST,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece, which is a whole sequence.

    Columns: the id under its own name, ``start`` (the document's ids before the
    piece), ``length``, ``ids`` (binary: little-endian unsigned 32-bit), ``doc_tokens``
    (with the end id), ``sequence_id`` (unique, not dense) and ``offset`` (always 0).
    ``tokenizer`` is a ``tokenizers`` file that drops white space. A null or empty text
    is the end id alone. Repeated rows are packed each time, null ids stay null, other
    columns are not read, and no rows give no rows.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    kind = docs.schema[id_col].dataType
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    from pyspark.sql.pandas.types import to_arrow_type

    made = source.mapInArrow(
        in_slices(_packing(tokenizer, longest, end_id, to_arrow_type(kind))),
        f"id {kind.simpleString()}, start long, length long, ids binary, doc_tokens long",
    )
    return made.select(
        F.col("id").alias(id_col),
        "start",
        "length",
        "ids",
        "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences in one folder per length."""
    packed.write.partitionBy("length").parquet(path)
