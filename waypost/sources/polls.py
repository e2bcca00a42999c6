"""Recorded polls: JSON envelopes of positional state vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost import schemas
from waypost.functions.scalar import (
    dedup_key,
    observed_at,
    position_age,
    trim_callsign,
)

#: Capture order of vectors: recordings by file name, then place in the poll.
CAPTURE_ORDER = ("file", "poll_time", "pos")

_ZERO = {"string": "", "bigint": 0, "boolean": False, "smallint": 0}


def read_envelopes(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per poll: ``file``, ``poll_time``, ``states``.

    One document per file by default, as recorders write them; ``lines`` reads
    one document per line. Malformed JSON and a pattern without files are errors.
    """
    return (
        spark.read.schema(schemas.POLL)
        .option("mode", "FAILFAST")
        .option("multiLine", not lines)
        .json(path)
        .select(
            F.col("_metadata.file_name").alias("file"),
            F.col("time").alias("poll_time"),
            "states",
        )
    )


def read_polls(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per recorded vector: ``file``, ``poll_time``, ``pos``, ``raw``, ``v``.

    Polls without states give no rows.
    """
    return state_rows(read_envelopes(spark, path, lines))


def state_rows(envelopes: DataFrame) -> DataFrame:
    return with_fields(
        envelopes.select("file", "poll_time", F.posexplode("states").alias("pos", "raw"))
    )


def with_fields(states: DataFrame) -> DataFrame:
    """Adds ``v``, the elements of the vector ``raw`` as text."""
    return _once(states, F.from_json("raw", "array<string>").alias("v"))


def _once(df: DataFrame, *columns: Column) -> DataFrame:
    """Adds columns that are computed once per row.

    Exploded from a one-element array: a filter on a projected column would be pushed
    down as a copy of its whole expression, and each rule in it would parse the text again.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def _typed_vector() -> str:
    """A pattern of vectors whose elements all have their field's JSON type, or are null."""
    kinds = {
        "string": r'"(?:[^"\\]|\\.)*+"',
        "bigint": r"-?[0-9]++",
        "smallint": r"-?[0-9]++",
        "double": r"-?[0-9]++(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?",
        "boolean": "true|false",
        "any": r'"(?:[^"\\]|\\.)*+"|\[[^\[\]]*+\]|[^\s,"\[\]{}]++',
    }
    parts = [
        rf"\s*+(?:null|{kinds['any' if name == 'sensors' else kind]})\s*+"
        for name, kind, _ in schemas.VECTOR_FIELDS
    ]
    least = schemas.MIN_VECTOR_FIELDS
    rest = "".join(f"(?:,{p}" for p in parts[least:]) + "(?:,.*)?" + ")?" * len(parts[least:])
    return rf"(?s)^\s*\[{','.join(parts[:least])}{rest}\]\s*$"


#: What ``schema_of_variant`` calls the JSON types that a field may have.
_JSON_TYPES = {
    "string": "STRING|VOID",
    "bigint": "BIGINT|VOID",
    "smallint": "BIGINT|VOID",
    "double": "BIGINT|DOUBLE|FLOAT|VOID|DECIMAL.*",
    "boolean": "BOOLEAN|VOID",
}


def _decoded(field: str, kind: str, required: bool) -> Column:
    value = F.col(f"_read.{field}")
    if required:
        value = F.when(value.isNull(), F.lit(_ZERO[kind]).cast(kind)).otherwise(value)
    return value.alias(field)


def decode_vectors(polls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Named, typed columns from positional vectors, and the vectors that have none.

    A null stays NULL in an optional field and becomes the type's zero value in a
    required one. Vectors with fewer than 17 elements, or with an element of another
    JSON type than its field's, go to the second frame with a ``reason``.

    One pattern over the text tells that all types are right; only vectors that it
    does not match have their elements' types looked at one by one.
    """
    wire = [(n, k, r, i) for i, (n, k, r) in enumerate(schemas.VECTOR_FIELDS) if n != "sensors"]

    def text(at: int) -> Column:
        return F.get(F.col("v"), F.lit(at))

    def unread(name: str, at: int) -> Column:
        return text(at).isNotNull() & F.col(f"_read.{name}").isNull()

    def misread(name: str, kind: str, at: int) -> Column:
        found = F.get(F.col("_kinds"), F.lit(at))
        wrong = F.coalesce(~found.rlike(f"^(?:{_JSON_TYPES[kind]})$"), F.lit(False))
        if kind != "string":
            wrong = wrong | unread(name, at)
        return F.when(wrong, F.lit(f"{name}: not a {kind}"))

    read = _once(
        polls,
        F.struct(*[(text(i) if kind == "string" else text(i).try_cast(kind)).alias(name) for name, kind, _, i in wire]).alias("_read"),
        F.col("raw").rlike(_typed_vector()).alias("_plain"),
    )
    kinds = F.when(~F.col("_plain"), F.transform(F.from_json("raw", "array<variant>"), F.schema_of_variant))
    fields = F.coalesce(F.size("v"), F.lit(0))
    short = F.when(
        fields < schemas.MIN_VECTOR_FIELDS, F.concat(F.greatest(fields, F.lit(0)).cast("string"), F.lit(" fields"))
    )
    fine = F.coalesce(F.col("_plain") & (fields >= schemas.MIN_VECTOR_FIELDS), F.lit(False))
    for name, kind, _, i in wire:
        if kind != "string":
            fine = fine & ~unread(name, i)
    # Within a lambda the rules are interpreted: compiled with the rest of the stage they make a
    # method too large for the JVM's compiler. Only vectors that fail the short test need them.
    rules = F.coalesce(short, *[misread(name, kind, i) for name, kind, _, i in wire])
    found = F.get(F.transform(F.array(F.lit(0)), lambda _: rules), F.lit(0))
    judged = _once(_once(read, kinds.alias("_kinds")), F.when(fine, None).otherwise(found).alias("reason"))
    keep = [c for c in polls.columns if c not in ("v", "raw")]
    good = judged.where(F.col("reason").isNull()).select(*keep, *[_decoded(n, k, r) for n, k, r, _ in wire])
    return good, judged.where(F.col("reason").isNotNull()).select(*polls.columns, "reason")


def time_shift(vectors: DataFrame, anchor: int) -> DataFrame:
    """Rebase all times so that the first recorded poll happens at ``anchor``.

    Differences between times are preserved.
    """
    first = vectors.agg(F.min_by("poll_time", F.struct(*CAPTURE_ORDER))).scalar()
    delta = F.lit(anchor) - first
    return vectors.withColumns(
        {c: F.col(c) + delta for c in ("poll_time", "last_contact", "time_position")}
    )


def to_records(
    vectors: DataFrame,
    ingested_at: Column,
    region: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Wire records: identity, trimmed callsign, provenance; times as epoch seconds.

    ``region`` defaults to the column of that name; ``keep`` passes columns on.
    """
    return vectors.withColumns(
        {
            "dedup_key": dedup_key("icao24", "time_position", "last_contact"),
            "observed_at": observed_at("time_position", "last_contact"),
            "callsign": trim_callsign("callsign"),
            "region": F.col("region") if region is None else region,
            "ingested_at": ingested_at,
            "position_age_seconds": position_age("time_position", "last_contact"),
        }
    ).select(*keep, *schemas.RECORD_COLUMNS)


def to_bronze(records: DataFrame) -> DataFrame:
    """Bronze rows from typed records: epoch seconds become instants."""
    return records.select(
        *[
            (
                F.timestamp_seconds(F.col(f.name)) if f.name in schemas.EPOCH_COLUMNS else F.col(f.name)
            )
            .cast(f.dataType)
            .alias(f.name)
            for f in schemas.BRONZE.fields
        ]
    )
