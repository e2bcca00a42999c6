"""Session settings, the shared work folder and size checks."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest side, in rows, that any job here will broadcast by hint.
BROADCAST_ROWS = 100_000

#: Largest side in bytes.
BROADCAST_BYTES = 64 << 20

_LOCAL_ROOTS: dict[str, str] = {}


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are instants in UTC; pin the session so casts agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets one temporary
    folder per application.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="waypost-")
    return _LOCAL_ROOTS[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage before a job that reads its input more than once: the second
    read is a columnar scan, not a recomputation, and survives lost executors.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``settle``, with aggregates over the rows collected while they are written.

    Without a shuffle in ``df`` its tasks are those of the write, each of which counts
    once however often it is tried.
    """
    seen = Observation()
    settled = settle(df.observe(seen, *[c.alias(n) for n, c in measures.items()]), name)
    return settled, {n: seen.get.get(n) for n in measures}


def release(settled: DataFrame) -> None:
    """Delete the files of a settled table; it cannot be read from then on."""
    files = settled.inputFiles()
    if files:
        delete(settled.sparkSession, files[0].rpartition("/")[0])


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that have ended.

    It does so once the driver has collected their handles as garbage, which by itself may
    take until long after a query with several large steps.
    """
    spark._jvm.System.gc()


def _folder(spark: SparkSession, path: str):
    """Spark's own file access, which knows the same stores as its readers."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    files, at = _folder(spark, path)
    return [c.getPath().getName() for c in files.listStatus(at)] if files.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    files, at = _folder(spark, path)
    files.delete(at, True)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there, as another writer had come first."""
    files, at = _folder(spark, path)
    try:
        files.create(at, False).close()
    except Py4JJavaError as error:
        if files.exists(at):
            return False
        raise error
    return True


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes of text and numbers.

    A look at the first ``max_rows`` + 1 rows decides. It runs the lineage of ``df``, which
    should be a stored reference table.
    """
    width = sum(
        (F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(8))
        for f in df.schema.fields
    )
    seen = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("size")).first()
    return seen.n <= max_rows and (seen["size"] or 0) <= max_bytes
