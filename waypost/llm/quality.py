"""Quality classifier: hashed word n-grams and logistic regression, trained with FTRL.

A text's features are its words (runs of letters, digits and underscores, or of other
marks) and pairs of adjacent words, hashed into a fixed number of slots, with their
counts scaled to length one. Training is FTRL-proximal over a bounded sample of the
labelled rows, in one task; scoring is a sparse dot product per text in parallel.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from waypost.llm.batches import in_slices
from waypost.llm.shingles import mix

#: Most labelled rows that are learnt from; which ones, their ids' hashes decide.
SAMPLE_ROWS = 8_000

#: Slots, and examples that are learnt from one after another, round after round.
SLOT_BITS = 18
STEPS = 24_000

# Step size and its offset; penalties on absolute values and on squares.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.05

#: Rows that score at least this are of good quality.
GOOD = 0.3

#: One in this many ids is held out.
FOLDS = 5

_WORD = re.compile(r"\w+|[^\w\s]+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def features(text: str, bits: int = SLOT_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text; slot 0 is the constant term."""
    found = _WORD.findall(text)
    prints = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in found), np.uint64, len(found))
    pairs = mix(prints[:-1] * np.uint64(3)) ^ prints[1:]
    slots = mix(np.concatenate((prints, pairs))) >> np.uint64(64 - bits)
    slots, counts = np.unique(slots.astype(np.int64), return_counts=True)
    values = counts / np.sqrt((counts.astype(float) ** 2).sum()) if len(counts) else counts.astype(float)
    return np.append(slots, 1 << bits), np.append(values, 1.0)


@dataclass
class Model:
    weights: np.ndarray  # the last one is the constant term

    def score(self, text: str) -> float:
        slots, values = features(text, (len(self.weights) - 1).bit_length() - 1)
        return float(1 / (1 + np.exp(-np.clip(self.weights[slots] @ values, -35, 35))))


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], bits: int, steps: int) -> np.ndarray:
    """FTRL-proximal weights after whole rounds, ``steps`` at least, over (label, slots, values)."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(-(-steps // max(1, len(examples)))):
        for label, slots, values in examples:
            zs, ns = z[slots], n[slots]
            w = weights(zs, ns)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            after = ns + g * g
            z[slots] = zs + g - (np.sqrt(after) - np.sqrt(ns)) / ALPHA * w
            n[slots] = after
    return weights(z, n)


def _featuring(bits: int):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for place, label, text in zip(*(c.to_pylist() for c in batch.columns)):
                slots, values = features(text, bits)
                rows.append((place, label, slots.astype(np.int32).tobytes(), values.astype(np.float32).tobytes()))
            if rows:
                types = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                names = ["place", "label", "slots", "values"]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return extract


def _training(bits: int, steps: int):
    def fit_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [
            (label, np.frombuffer(slots, np.int32), np.frombuffer(values, np.float32))
            for batch in batches
            for label, slots, values in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))
        ]
        yield pa.record_batch([pa.array([train(examples, bits, steps).tobytes()], pa.binary())], ["weights"])

    return fit_sample


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    bits: int = SLOT_BITS,
    steps: int = STEPS,
) -> Model:
    """A model of ``label_col`` (0 or 1) from labelled rows that are not held out.

    At most ``sample_rows`` labels are learnt from, those whose ids have the smallest
    hashes, in that order; so many ids are broadcast and so many feature vectors meet
    in one task: of an id that ``docs`` repeats, the text with the smallest hash is
    learnt from. Labels that are null or without an id are left out; without any label
    all scores are 0.5.
    """
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("_id")))
        .withColumn("place", F.xxhash64("_id"))
        .orderBy("place", "_id", "label")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))  # combined before the shuffle
    texts = texts.join(F.broadcast(chosen.select("_id").distinct()), "_id").groupBy("_id").agg(first["text"].alias("text"))
    sample = texts.join(F.broadcast(chosen), "_id").select("place", "label", "text")
    vectors = sample.mapInArrow(_featuring(bits), "place long, label int, slots binary, values binary")
    one = vectors.repartition(1).sortWithinPartitions("place", "label", "slots")
    learnt = one.mapInArrow(_training(bits, steps), "weights binary").first()
    return Model(np.frombuffer(learnt[0], float) if learnt else np.zeros((1 << bits) + 1))


def _scoring(model, id_type: pa.DataType):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.value.score(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0).cast(id_type), pa.array(found, pa.float64())], ["id", "score"])

    return score


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs`` its id, ``held_out``, ``score`` and ``predicted``.

    A null text is empty, and an empty text has the score of the constant term. Rows
    come out as often as they went in, null ids included (not held out); other columns
    are not read, and no rows give no rows.
    """
    kind = docs.schema[id_col].dataType
    held = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scored = source.mapInArrow(_scoring(held, to_arrow_type(kind)), f"id {kind.simpleString()}, score double")
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``GOOD``."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index(text_col)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [held.value.score(t or "") >= GOOD for t in batch.column(column).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(in_slices(good), docs.schema)
