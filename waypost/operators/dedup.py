"""Latest copy per key, with pre-aggregation before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    tie_breakers: Sequence[str] = (),
    null_policy: str = "row",
    count_col: str | None = None,
) -> DataFrame:
    """One row per ``keys``: the copy with the highest ``version``.

    Adds ``source_row_count``, the number of copies that collapsed (the sum of
    ``count_col`` where the input has itself been collapsed before).

    Ties on ``version`` fall to ``tie_breakers`` and then to all other columns,
    so the winner never depends on arrival order. ``null_policy="column"`` takes
    each column from its latest non-null copy instead of from the latest row.

    The winner is one ``max`` over a struct, which Spark evaluates on the map
    side too: a key with any number of copies reaches the shuffle as one row per
    map task.
    """
    rest = [c for c in df.columns if c not in {*keys, version, *tie_breakers, count_col}]
    ranking = [version, *tie_breakers, *rest]
    copies = F.sum(count_col) if count_col else F.count(F.lit(1))

    if null_policy == "row":
        best = df.groupBy(*keys).agg(
            F.max(F.struct(*ranking)).alias("_best"), copies.alias("_copies")
        )
        picked = [F.col(f"_best.{c}").alias(c) for c in ranking]
    elif null_policy == "column":
        order = F.struct(*ranking)
        best = df.groupBy(*keys).agg(
            *[
                F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c)
                for c in ranking
            ],
            copies.alias("_copies"),
        )
        picked = [F.col(c) for c in ranking]
    else:
        raise ValueError(f"unknown null_policy {null_policy!r}")

    columns = [c for c in df.columns if c != count_col]
    return best.select(
        *keys, *picked, F.col("_copies").cast("bigint").alias("source_row_count")
    ).select(*columns, "source_row_count")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest ``order`` for each key. Filter before, not after."""
    rest = [c for c in df.columns if c not in {*keys, *order}]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)
