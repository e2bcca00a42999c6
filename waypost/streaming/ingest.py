"""Raw records to bronze, continuously."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waypost import schemas
from waypost.operators.validation import split_valid, validate
from waypost.params import BATCH_SECONDS, MAX_INVALID_RATIO, RATIO_GUARD_MIN_MESSAGES
from waypost.plans.partials import add_partials
from waypost.sinks.tables import write_bronze, write_bronze_table, write_fanout, write_quarantine
from waypost.workspace import release, settle_observed


log = logging.getLogger(__name__)


class InvalidRatioExceeded(RuntimeError):
    """Too many messages break the schema: the producer has probably changed."""


@dataclass(frozen=True)
class IngestPaths:
    bronze: str
    quarantine: str
    metrics: str
    checkpoint: str
    table: str | None = None
    partials: str | None = None


class _EnoughBatches(Exception):
    """Raised in place of the batch after the last one, whose offsets stay uncommitted."""


@dataclass
class Progress:
    """What an ingest job has done since it was started."""

    max_batches: int | None
    batches: int = 0
    lost_metrics: int = 0
    stopped: bool = False


def start_bronze(
    source: DataFrame,
    paths: IngestPaths,
    value_col: str = "value",
    bounded: bool = False,
    every_seconds: int = BATCH_SECONDS,
    max_batches: int | None = None,
    on_partial: str = "fail",
    max_invalid_ratio: float = MAX_INVALID_RATIO,
    min_messages: int = RATIO_GUARD_MIN_MESSAGES,
) -> StreamingQuery:
    """Validate, write and quarantine micro-batches of raw text.

    A batch is validated once, into a table of the shared folder that all targets read;
    its messages are counted during that write, and only distinct observations take a
    narrow pass over the table. Too many invalid ones stop the job before any target is
    written. A batch's offsets are committed after its targets are written. Everything it
    writes lies in folders with its number, so a batch that is retried after a partial
    write replaces what it had written. The batch size is the source's
    ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger``; ``bounded`` takes what is there
    and stops, and ``max_batches`` stops after so many batches that held messages (wait
    with ``await_bronze``); what is left waits for the next start. There is no watermark: a late row belongs to the
    hour it was observed and must not be dropped.

    A lost measurement does not cost a batch its observations; it is logged and counted
    in ``query.progress_made``.
    """
    seen = {"messages": 0, "invalid": 0}

    def guard(metrics: dict, validated: DataFrame) -> None:
        seen["messages"] += metrics["messages_consumed"]
        seen["invalid"] += metrics["invalid_messages"]
        if seen["messages"] < min_messages or seen["invalid"] <= max_invalid_ratio * seen["messages"]:
            return
        examples = [
            row.reason for row in validated.where("reason IS NOT NULL").select("reason").limit(5).collect()
        ]
        raise InvalidRatioExceeded(
            f"{seen['invalid']} of {seen['messages']} messages are invalid, e.g. {examples}"
        )

    def flush(batch: DataFrame, batch_id: int) -> None:
        if progress.max_batches is not None and progress.batches >= progress.max_batches:
            progress.stopped = True
            raise _EnoughBatches
        at = dt.datetime.now(dt.timezone.utc)
        validated, counted = settle_observed(
            validate(batch, value_col),
            "ingest",
            messages_consumed=F.count(F.lit(1)),
            rows_written=F.count_if(F.col("reason").isNull()),
            invalid_messages=F.count_if(F.col("reason").isNotNull()),
        )
        counted = {name: n or 0 for name, n in counted.items()}
        try:
            guard(counted, validated)
            valid, rejected = split_valid(validated, value_col)
            targets: dict[str, Callable[[DataFrame], None]] = {
                "bronze": lambda rows: write_bronze(rows, paths.bronze, batch=batch_id)
            }
            if paths.table:
                targets["table"] = lambda rows: write_bronze_table(rows, paths.table, batch=batch_id)
            if paths.partials:
                targets["partials"] = lambda rows: add_partials(rows, paths.partials, batch_id)
            write_fanout(valid, targets, on_partial, stored=True)
            if counted["invalid_messages"]:
                write_quarantine(rejected, f"{paths.quarantine}/batch={batch_id}", mode="overwrite")
            distinct = valid.select("icao24", "observed_at").distinct().count()
            row = (at, *counted.values(), distinct)
            record(batch.sparkSession.createDataFrame([row], schemas.INGEST_METRICS), batch_id)
        finally:
            release(validated)
        progress.batches += counted["messages_consumed"] > 0

    def record(metrics: DataFrame, batch_id: int) -> None:
        try:
            metrics.coalesce(1).write.mode("overwrite").parquet(f"{paths.metrics}/batch={batch_id}")
        except Exception:  # noqa: BLE001 - see the docstring
            progress.lost_metrics += 1
            log.exception("metrics of batch %s not recorded", batch_id)

    progress = Progress(max_batches)
    writer = source.writeStream.foreachBatch(flush).option("checkpointLocation", paths.checkpoint)
    trigger = {"availableNow": True} if bounded else {"processingTime": f"{every_seconds} seconds"}
    query = writer.trigger(**trigger).start()
    query.progress_made = progress
    return query


def await_bronze(query: StreamingQuery) -> Progress:
    """Wait until an ingest job ends, by itself or at its ``max_batches``."""
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not query.progress_made.stopped:
            raise
    return query.progress_made
