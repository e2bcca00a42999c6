"""Record validation: one pass over raw JSON text, first failing rule wins.

Rules test JSON types, not just values: ``true`` is no number and ``"5"`` no
integer. The text is parsed with the declared types; only where that fails is it
parsed again with every field as text, and a field with text but no typed value
has the wrong type. Any JSON value reads as text, so string fields are declared
VARIANT, which remembers what they were.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waypost.params import MAX_EPOCH, MAX_INVALID_RATIO, MIN_EPOCH, RATIO_GUARD_MIN_MESSAGES
from waypost.schemas import BRONZE, BRONZE_COLUMNS, EPOCH_COLUMNS, RECORD_COLUMNS

_REQUIRED_EPOCHS = ("observed_at", "last_contact", "poll_time", "ingested_at")
_JSON = {
    "allowNonNumericNumbers": "false",
    "allowSingleQuotes": "false",
    "columnNameOfCorruptRecord": "_bad",
}


def _wire_type(field: str) -> str:
    """Type a field is read with; integers are read wide so that ranges can be judged."""
    declared = BRONZE[field].dataType.simpleString()
    if declared == "string" or field == "position_age_seconds":
        return "variant"
    return "bigint" if field in (*EPOCH_COLUMNS, "category", "position_source") else declared


def _text(field: str) -> Column:
    return F.col(f"_text.{field}")


def _value(field: str) -> Column:
    return F.col(f"_typed.{field}")


def _fails(when: Column, reason: str) -> Column:
    return F.when(when, F.lit(reason))


def _mistyped(field: str) -> Column:
    return _text(field).isNotNull() & _value(field).isNull()


def _kind(field: str) -> Column:
    """JSON type of a VARIANT field; NULL when it is missing or null."""
    return F.nullif(F.col(f"_kinds.{field}"), F.lit("VOID"))


def _string_value(field: str) -> Column:
    return F.try_variant_get(_value(field), "$", "string")


def _string(field: str, required: bool) -> list[Column]:
    missing = [_fails(_kind(field).isNull(), f"{field}: required")] if required else []
    return [*missing, _fails(_kind(field) != "STRING", f"{field}: not a string")]


def _epoch(field: str) -> list[Column]:
    required = field in _REQUIRED_EPOCHS
    missing = [_fails(_value(field).isNull(), f"{field}: required")] if required else []
    return [
        _fails(_mistyped(field), f"{field}: not an integer"),
        *missing,
        _fails(~_value(field).between(MIN_EPOCH, MAX_EPOCH), f"{field}: implausible epoch"),
    ]


def _number(field: str) -> list[Column]:
    return [_fails(_mistyped(field), f"{field}: not a number")]


def _flag(field: str) -> list[Column]:
    return [_fails(_value(field).isNull(), f"{field}: not a boolean")]


def _within(field: str, low: float, high: float) -> list[Column]:
    return [_fails(~_value(field).between(low, high), f"{field}: out of range")]


def _age() -> list[Column]:
    """A number, or text that reads as a whole one; blank text counts as none."""
    kind, text = _kind("position_age_seconds"), _string_value("position_age_seconds")
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    numeric_text = (kind == "STRING") & text.rlike(r"^\s*([+-]?\d+\s*)?$")
    return [_fails(~(number | numeric_text), "position_age_seconds: not a number")]


def _reason() -> Column:
    is_object = F.col("_object")
    unreadable = (F.coalesce(F.col("_documents"), F.lit(0)) != 1) | (
        is_object & (F.col("_typed").isNull() | F.col("_text._bad").isNotNull())
    )
    rules = [
        _fails(unreadable, "json: unparseable"),
        _fails(~is_object, "record: not an object"),
        *_string("icao24", required=True),
        _fails(_string_value("icao24").rlike(r"^\s*$"), "icao24: empty"),
        *_number("latitude"),
        *_number("longitude"),
        *_within("latitude", -90, 90),
        *_within("longitude", -180, 180),
        _fails(_mistyped("category"), "category: not an integer"),
        *_within("category", 0, 20),
        _fails(_value("position_source").isNull(), "position_source: not an integer"),
        *_within("position_source", 0, 3),
        *_epoch("observed_at"),
        *_string("callsign", required=False),
        *_string("origin_country", required=True),
        *_epoch("time_position"),
        *_epoch("last_contact"),
        *_number("baro_altitude"),
        *_flag("on_ground"),
        *_number("velocity"),
        *_number("true_track"),
        *_number("vertical_rate"),
        *_number("geo_altitude"),
        *_string("squawk", required=False),
        *_flag("spi"),
        *_string("region", required=True),
        *_epoch("poll_time"),
        *_epoch("ingested_at"),
        *_age(),
    ]
    return F.coalesce(*rules)


def _fine() -> Column:
    """True only if no rule fails; not true for some records that pass, such as ages in text.

    Nothing is mistyped where the typed read found nothing corrupt.
    """

    def kind(field: str, *allowed: str) -> Column:
        return F.coalesce(F.col(f"_kinds.{field}").isin(*allowed), F.lit("VOID" in allowed))

    def between(field: str, low: float, high: float, required: bool) -> Column:
        return F.coalesce(_value(field).between(low, high), F.lit(not required))

    tests = [
        F.col("_object"),
        F.coalesce(F.col("_documents") == 1, F.lit(False)),
        F.col("_typed").isNotNull(),
        _value("_bad").isNull(),
        *[kind(f, "STRING") for f in ("icao24", "origin_country", "region")],
        *[kind(f, "STRING", "VOID") for f in ("callsign", "squawk")],
        kind("position_age_seconds", "BIGINT", "VOID"),
        between("latitude", -90, 90, False),
        between("longitude", -180, 180, False),
        between("category", 0, 20, False),
        between("position_source", 0, 3, True),
        *[between(f, MIN_EPOCH, MAX_EPOCH, True) for f in _REQUIRED_EPOCHS],
        between("time_position", MIN_EPOCH, MAX_EPOCH, False),
        _value("on_ground").isNotNull(),
        _value("spi").isNotNull(),
        F.coalesce(~_string_value("icao24").rlike(r"^\s*$"), F.lit(False)),
    ]
    return reduce(lambda a, b: a & b, tests)


def _field(name: str) -> Column:
    """One bronze column of a document that passed every rule."""
    if name in EPOCH_COLUMNS:
        value = F.timestamp_seconds(_value(name))
    elif name == "position_age_seconds":
        # Through double, as a fraction is cut off rather than refused.
        value = F.coalesce(F.trim(_string_value(name)).try_cast("double").try_cast("int"), F.lit(0))
    elif _wire_type(name) == "variant":
        value = _string_value(name)
    else:
        value = _value(name).cast(BRONZE[name].dataType)
    return value.alias(name)


_FLAT = r"^\s*+\{[^{}]*+\}\s*$"


def validate(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``rec`` (the bronze record, NULL when rejected) and ``reason``.

    A record is judged whole: types, required fields, plausible epochs and ranges
    in a fixed order, the first failure being the reason. Absent measurements
    stay NULL; whole numbers are accepted where a float is meant.
    """
    value = F.col(value_col)
    typed = ", ".join(f"{f} {_wire_type(f)}" for f in BRONZE_COLUMNS)
    text = ", ".join(f"{f} string" for f in BRONZE_COLUMNS)
    # Exploded from one-element arrays: a generator's output is computed once per
    # row, while a filter on a projected column would be pushed down as a copy of
    # its whole expression and parse the text again for every rule.
    read = raw.select(
        "*",
        F.inline(
            F.array(
                F.struct(
                    F.from_json(value, f"{typed}, _bad string", _JSON).alias("_typed"),
                    # Exactly one document, with nothing after it. One pair of braces
                    # around all the rest is that without another parse.
                    F.when(value.rlike(_FLAT), 1)
                    .otherwise(F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))))
                    .alias("_documents"),
                    value.rlike(r"^\s*\{").alias("_object"),
                )
            )
        ),
    )
    kinds = [
        F.schema_of_variant(_value(f)).alias(f) for f in BRONZE_COLUMNS if _wire_type(f) == "variant"
    ]
    as_text = F.when(_value("_bad").isNotNull(), F.from_json(value, f"{text}, _bad string", _JSON))
    read = read.select(
        "*", F.inline(F.array(F.struct(as_text.alias("_text"), F.struct(*kinds).alias("_kinds"))))
    )
    # Within a lambda the rules are interpreted. Compiled with the rest of the stage they
    # make a method too large for the JVM's compiler, which then runs all of it slowly.
    # Only rows that fail the short test need them.
    found = F.get(F.transform(F.array(F.lit(0)), lambda _: _reason()), F.lit(0))
    judged = read.select("*", F.explode(F.array(F.when(_fine(), None).otherwise(found))).alias("reason"))
    rec = F.when(F.col("reason").isNull(), F.struct(*[_field(f) for f in BRONZE_COLUMNS]))
    return judged.select(*raw.columns, "reason", rec.alias("rec"))


def split_valid(validated: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """The accepted records and the quarantine (raw payload and reason)."""
    valid = validated.where(F.col("reason").isNull()).select("rec.*")
    quarantine = validated.where(F.col("reason").isNotNull()).select("reason", F.col(value_col).alias("payload"))
    return valid, quarantine


def field_drift(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Field names a producer adds or leaves out, with the number of messages."""
    # Messages with one list of names count as one row from here on; each is parsed once.
    lists = raw.groupBy(F.json_object_keys(F.col(value_col)).alias("keys")).agg(F.count(F.lit(1)).alias("n"))
    expected = F.array(*[F.lit(c) for c in RECORD_COLUMNS])
    found = lists.select(
        "n",
        F.explode(
            F.concat(
                F.transform(
                    F.array_except("keys", expected),
                    lambda k: F.struct(k.alias("field"), F.lit("unexpected").alias("drift")),
                ),
                F.transform(
                    F.array_except(expected, "keys"),
                    lambda k: F.struct(k.alias("field"), F.lit("missing").alias("drift")),
                ),
            )
        ).alias("d"),
    )
    return found.groupBy("d.field", "d.drift").agg(F.sum("n").alias("messages"))


def ratio_verdict(
    validated: DataFrame,
    max_ratio: float = MAX_INVALID_RATIO,
    min_messages: int = RATIO_GUARD_MIN_MESSAGES,
    samples: int = 5,
) -> DataFrame:
    """One row: counts, the invalid ratio, whether to stop, and a few distinct reasons."""
    per_reason = validated.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    listed = F.slice(F.sort_array(F.collect_set("reason")), 1, samples)
    return (
        # At most one row per rule is left to collect.
        per_reason.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("messages"),
            F.coalesce(F.sum(F.when(F.col("reason").isNotNull(), F.col("n"))), F.lit(0)).alias("invalid"),
            listed.alias("samples"),
        )
        .withColumn("invalid_ratio", F.coalesce(F.try_divide("invalid", "messages"), F.lit(0.0)))
        .withColumn(
            "stop", (F.col("messages") >= min_messages) & (F.col("invalid_ratio") > max_ratio)
        )
    )
