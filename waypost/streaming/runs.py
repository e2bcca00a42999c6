"""Tables that grow by a folder per batch, merged every so many batches.

A batch writes ``run=<n>-<n>``; a merge writes ``run=<first>-<n>``, which stands for all
runs within it. A run is there once it is complete, so a reader never sees half of one.
A batch that is retried replaces its own run and its own merge; what it started from,
the runs before it, is kept until the merge after the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from waypost.workspace import children, delete

#: Batches between merges.
MERGE_EVERY = 50


def _complete(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    found = []
    for name in children(spark, path):
        if name.startswith("run=") and "_SUCCESS" in children(spark, f"{path}/{name}"):
            first, last = name[4:].split("-")
            found.append((int(first), int(last)))
    return found


def live_runs(runs: Sequence[tuple[int, int]], before: int | None = None) -> list[tuple[int, int]]:
    """The runs that together hold all batches (before one), each batch once."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs, key=lambda r: (r[0], -r[1])):
        if (before is None or last < before) and (not out or last > out[-1][1]):
            out.append((first, last))
    return out


def read_runs(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    before: int | None = None,
    after: int | None = None,
    without: tuple[int, int] | None = None,
) -> DataFrame:
    """All rows of the live runs, optionally of batches before one, of runs that end after one, or without one."""
    complete = [r for r in _complete(spark, path) if r != without]
    runs = [r for r in live_runs(complete, before) if after is None or r[1] > after]
    if not runs:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*[f"{path}/run={first}-{last}" for first, last in runs]).select(*schema.fieldNames())


def write_run(rows: DataFrame, path: str, first: int, last: int, partition_by: Sequence[str] = ()) -> None:
    writer = rows.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/run={first}-{last}")


def merge_runs(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    batch: int,
    reduce: Callable[[DataFrame], DataFrame],
    *,
    whole: bool = False,
    partition_by: Sequence[str] = (),
    every: int | None = None,
) -> None:
    """At every ``every``-th batch, one run from those since the last merge, or from all.

    Runs that the merge before this one stood for are deleted.
    """
    every = every or MERGE_EVERY
    if (batch + 1) % every:
        return
    first = 0 if whole else batch - every + 1
    # The merge of a batch that is retried does not read itself.
    own = (first, batch) if first < batch else None
    rows = read_runs(spark, path, schema, batch + 1, None if whole else first - 1, own)
    write_run(reduce(rows), path, first, batch, partition_by)
    for lo, hi in _complete(spark, path):
        replaced = hi <= batch - every and (whole or lo == hi)
        kept = whole and (lo, hi) == (0, batch - every)
        if replaced and not kept:
            delete(spark, f"{path}/run={lo}-{hi}")
