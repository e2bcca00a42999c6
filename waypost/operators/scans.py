"""Ordered per-key computations that split one key's history over many tasks.

A window over ``partitionBy(key)`` puts a whole history into one task. Here a
history is cut into time slices: each slice is windowed on its own, one summary
row per slice is scanned per key, and the result is handed back to the slices.
Only the summaries, one per key and slice, are ever ordered as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waypost.params import EWMA_ALPHA

DAY = 86_400


def time_slice(ts: Column | str, seconds: int) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_seconds(ts) / F.lit(seconds))


def sessionize(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    gap_s: int,
    state_col: str | None = None,
    from_state: object = True,
    to_state: object = False,
    boundary: str = "takeoff_row",
    chunk_s: int = DAY,
    carry: DataFrame | None = None,
    slice_col: str | None = None,
) -> DataFrame:
    """Number the sessions of every key.

    A row starts a session when it is the key's first, when more than ``gap_s``
    seconds passed since the previous row, or when ``state_col`` changes from
    ``from_state`` to ``to_state``. With ``boundary="takeoff_row"`` the row after
    the change starts the session, with ``"last_ground_row"`` the row before it.

    Adds ``observation_seq``, ``previous_ts``, ``previous_state`` and
    ``seconds_since_previous`` (NULL on the first row), ``is_session_start`` and
    ``session_seq``. ``(key, ts)`` must be unique at
    one-second resolution, which bounds a slice to ``chunk_s`` rows. The input is
    read twice, first the key, time and state columns only; pass a written table
    (see ``workspace.settle``) where its lineage is expensive.

    ``carry`` continues earlier work: one row per key with ``last_ts``,
    ``last_state``, ``last_seq`` and ``last_session``.

    ``slice_col`` names a stored slice number, which grows with ``ts``, in place of the
    one from ``chunk_s``. Over a table bucketed by key and that column (see
    ``sinks.buckets``) only the summaries are shuffled.
    """
    if boundary not in ("takeoff_row", "last_ground_row"):
        raise ValueError(f"unknown boundary {boundary!r}")
    keys = list(key)
    state = F.col(state_col) if state_col else F.lit(None).cast("boolean")
    before, after = F.lit(from_state), F.lit(to_state)

    def gap_or_change(prev_ts: Column, prev_state: Column, this_ts: Column, this_state: Column) -> Column:
        rule = F.unix_seconds(this_ts) - F.unix_seconds(prev_ts) > gap_s
        if state_col and boundary == "takeoff_row":
            rule = rule | ((prev_state == before) & (this_state == after))
        return F.coalesce(rule, F.lit(False))

    def last_before_change(this_state: Column, next_state: Column) -> Column:
        if state_col and boundary == "last_ground_row":
            return F.coalesce((this_state == before) & (next_state == after), F.lit(False))
        return F.lit(False)

    def locally_flagged(frame: DataFrame) -> DataFrame:
        """Row numbers and every start that a slice can see without its neighbours."""
        by_time = W.partitionBy(*keys, "_slice").orderBy(ts)
        frame = frame.withColumns(
            {
                "_row": F.row_number().over(by_time),
                "_prev_ts": F.lag(ts).over(by_time),
                "_prev_state": F.lag(state).over(by_time),
                "_local": gap_or_change(
                    F.lag(ts).over(by_time), F.lag(state).over(by_time), F.col(ts), state
                )
                | last_before_change(state, F.lead(state).over(by_time)),
            }
        )
        return frame.withColumn(
            "_local_sum",
            F.sum(F.col("_local").cast("bigint")).over(
                by_time.rowsBetween(W.unboundedPreceding, W.currentRow)
            ),
        )

    sliced = df.withColumn("_slice", F.col(slice_col) if slice_col else time_slice(ts, chunk_s))
    narrow = sliced.select(*keys, ts, "_slice", *([state_col] if state_col else []))
    summary = (
        locally_flagged(narrow)
        .groupBy(*keys, "_slice")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.sum(F.col("_local").cast("bigint")).alias("_inner"),
            F.min(ts).alias("_first_ts"),
            F.max(ts).alias("_last_ts"),
            F.min_by(state, ts).alias("_first_state"),
            F.max_by(state, ts).alias("_last_state"),
            F.min_by("_local", ts).alias("_first_flag"),
            F.max_by("_local", ts).alias("_last_flag"),
        )
    )

    by_slice = W.partitionBy(*keys).orderBy("_slice")
    earlier = by_slice.rowsBetween(W.unboundedPreceding, -1)
    in_prev_ts, in_prev_state = F.lag("_last_ts").over(by_slice), F.lag("_last_state").over(by_slice)
    base_rows, base_sessions = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    if carry is not None:
        summary = summary.join(
            carry.select(
                *keys,
                F.col("last_ts").alias("_carry_ts"),
                F.col("last_state").alias("_carry_state"),
                F.col("last_seq").alias("_carry_seq"),
                F.col("last_session").alias("_carry_session"),
            ),
            keys,
            "left",
        )
        first_slice = F.row_number().over(by_slice) == 1
        in_prev_ts = F.when(first_slice, F.col("_carry_ts")).otherwise(in_prev_ts)
        in_prev_state = F.when(first_slice, F.col("_carry_state")).otherwise(in_prev_state)
        base_rows = F.coalesce(F.col("_carry_seq"), base_rows)
        base_sessions = F.coalesce(F.col("_carry_session"), base_sessions)

    opens = F.col("_in_prev_ts").isNull() | gap_or_change(
        F.col("_in_prev_ts"), F.col("_in_prev_state"), F.col("_first_ts"), F.col("_first_state")
    )
    closes = last_before_change(F.col("_last_state"), F.lead("_first_state").over(by_slice))
    handed = (
        summary.withColumns({"_in_prev_ts": in_prev_ts, "_in_prev_state": in_prev_state})
        .withColumns({"_opens": opens, "_closes": closes})
        # What the neighbours add to the flags the slice saw by itself.
        .withColumn("_add_first", (F.col("_opens") & ~F.col("_first_flag")).cast("bigint"))
        .withColumn(
            "_add_last",
            (
                F.col("_closes")
                & ~F.col("_last_flag")
                & ~((F.col("_rows") == 1) & F.col("_opens"))
            ).cast("bigint"),
        )
        .withColumns(
            {
                "_base_rows": base_rows + F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
                "_base_sessions": base_sessions
                + F.coalesce(
                    F.sum(F.col("_inner") + F.col("_add_first") + F.col("_add_last")).over(earlier),
                    F.lit(0),
                ),
            }
        )
        .select(
            *keys, "_slice", "_rows", "_in_prev_ts", "_in_prev_state", "_opens", "_closes",
            "_add_first", "_add_last", "_base_rows", "_base_sessions",
        )
    )

    is_first, is_last = F.col("_row") == 1, F.col("_row") == F.col("_rows")
    starts = F.col("_local") | (is_first & F.col("_opens")) | (is_last & F.col("_closes"))
    prev_ts = F.when(is_first, F.col("_in_prev_ts")).otherwise(F.col("_prev_ts"))
    prev_state = F.when(is_first, F.col("_in_prev_state")).otherwise(F.col("_prev_state"))
    return (
        locally_flagged(sliced)
        .join(handed, [*keys, "_slice"])
        .select(
            *df.columns,
            (F.col("_base_rows") + F.col("_row")).alias("observation_seq"),
            prev_ts.alias("previous_ts"),
            prev_state.alias("previous_state"),
            (F.unix_seconds(F.col(ts)) - F.unix_seconds(prev_ts)).alias("seconds_since_previous"),
            starts.cast("int").alias("is_session_start"),
            (
                F.col("_base_sessions")
                + F.col("_local_sum")
                + F.col("_add_first")
                + F.when(is_last, F.col("_add_last")).otherwise(F.lit(0))
            ).alias("session_seq"),
        )
    )


def running_total(
    df: DataFrame,
    key: Sequence[str],
    ts: str,
    order: Sequence[str],
    value: str,
    out: str,
    chunk_s: int = 600,
) -> DataFrame:
    """Running sum of ``value`` per key in the order ``(ts, *order)``, sliced by time."""
    keys = list(key)
    sliced = df.withColumn("_slice", time_slice(ts, chunk_s))
    by_slice = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    bases = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.sum(value).alias("_sum"))
        .select(*keys, "_slice", F.coalesce(F.sum("_sum").over(by_slice), F.lit(0)).alias("_base"))
    )
    inside = (
        W.partitionBy(*keys, "_slice")
        .orderBy(ts, *order)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        sliced.withColumn("_inside", F.sum(value).over(inside))
        .join(bases, [*keys, "_slice"])
        .select(*df.columns, (F.col("_base") + F.col("_inside")).alias(out))
    )


def ewma(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    alpha: float = EWMA_ALPHA,
    chunk_s: int = DAY,
) -> DataFrame:
    """Exponentially weighted mean per key in time order; the first value seeds it.

    Each slice is smoothed as if it were the first. Restarting from the carried
    mean instead of the slice's own first value changes row ``n`` by
    ``(1 - alpha) ** n`` times their difference, so slices need no second pass
    over their rows. ``(key, ts)`` must be unique at one-second resolution.
    """
    sliced = df.select(
        F.col(key), F.col(ts), F.col(value).cast("double").alias(value),
        time_slice(ts, chunk_s).alias("_slice"),
    )
    schema = T.StructType(
        [
            *sliced.schema.fields,
            T.StructField("_n", T.LongType()),
            T.StructField("_smooth", T.DoubleType()),
        ]
    )

    def smooth(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(ts, ignore_index=True)
        return rows.assign(
            _n=range(1, len(rows) + 1),
            _smooth=rows[value].ewm(alpha=alpha, adjust=False).mean(),
        )

    local = sliced.groupBy(key, "_slice").applyInPandas(smooth, schema)
    summary = local.groupBy(key, "_slice").agg(
        F.min_by(value, ts).alias("_first"),
        F.max("_n").alias("_n"),
        F.max_by("_smooth", ts).alias("_last"),
    )
    handed_schema = T.StructType(
        [
            summary.schema[key],
            T.StructField("_slice", T.LongType()),
            T.StructField("_first", T.DoubleType()),
            T.StructField("_in", T.DoubleType()),
        ]
    )

    def hand_over(slices: pd.DataFrame) -> pd.DataFrame:
        """Fold the slice summaries of one key; one row per slice."""
        slices = slices.sort_values("_slice", ignore_index=True)
        mean, carried = None, []
        for first, n, last in zip(slices["_first"], slices["_n"], slices["_last"]):
            mean = first if mean is None else mean
            carried.append(mean)
            mean = last + (1.0 - alpha) ** n * (mean - first)
        return slices.assign(_in=carried)[[key, "_slice", "_first", "_in"]]

    handed = summary.groupBy(key).applyInPandas(hand_over, handed_schema)
    decayed = F.pow(F.lit(1.0 - alpha), F.col("_n"))
    return local.join(handed, [key, "_slice"]).select(
        key,
        ts,
        value,
        (F.col("_smooth") + decayed * (F.col("_in") - F.col("_first"))).alias("ewma"),
    )
