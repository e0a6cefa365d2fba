"""Where stream rows go and how they are read back.

A run's history is a folder for each micro-batch and a manifest of the finished ones:

    run_id=<id>/batch_id=<n>/attempt=<unique>/...   the rows
    run_id=<id>/_manifest/...                       one row for each finished attempt

An attempt is written whole before it is entered, and entering it is one file that appears at once. Readers take
the last entered attempt of each batch, so they see whole batches only: not one that is being written, nor
one whose writer was lost, nor two versions of one that was run again after a failure. Nothing is deleted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
])


def _run_folder(path: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/run_id={run_id}"


def accumulate(path: str, run_id: str):
    """``foreachBatch`` callback that appends each micro-batch to the run's history.

    A batch that is run again (after a failure) becomes a new attempt that takes the place of
    the old one, so the sink is idempotent."""
    base = _run_folder(path, run_id)

    def write(df: DataFrame, batch_id: int) -> None:
        spark, attempt = df.sparkSession, uuid.uuid4().hex
        folder = f"{base}/batch_id={int(batch_id)}/attempt={attempt}"
        df.write.parquet(folder)
        n = spark.read.schema(df.schema).parquet(folder).count()  # from the files' footers
        entry = spark.range(1).select(F.lit(int(batch_id)).cast("long").alias("batch_id"), F.lit(attempt).alias("attempt"),
                                      F.lit(n).cast("long").alias("n_rows"), F.current_timestamp().alias("committed_at"))
        entry.coalesce(1).write.mode("append").parquet(f"{base}/_manifest")

    return write


def batches(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """(batch_id, n_rows, committed_at, attempt) of the finished micro-batches of a run, the last attempt of each."""
    entries = spark.read.schema(MANIFEST).parquet(f"{_run_folder(path, run_id)}/_manifest")
    last = F.max(F.struct("committed_at", "attempt", "n_rows")).alias("_last")
    return entries.groupBy("batch_id").agg(last).select("batch_id", "_last.n_rows", "_last.committed_at", "_last.attempt")


def history(spark: SparkSession, path: str, run_id: str, schema=None) -> DataFrame:
    """The rows of the run's finished batches, with their ``batch_id`` (older runs are ignored, nothing is
    deleted). The batches are those finished now: call it again to see later ones.

    To the driver come the names of the batches' folders. A run without any is empty if ``schema`` is given."""
    base = _run_folder(path, run_id)
    try:
        done = batches(spark, path, run_id).where("n_rows > 0").select("batch_id", "attempt").collect()
    except Exception as missing:
        if schema is None or "PATH_NOT_FOUND" not in str(missing):
            raise
        done = []
    reader = spark.read.option("basePath", base)
    if schema is not None:
        if not done:
            return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch_id", T.IntegerType())]))
        reader = reader.schema(schema)
    if not done:  # batches without rows still have the columns
        return reader.parquet(base).drop("attempt")
    return reader.parquet(*[f"{base}/batch_id={r['batch_id']}/attempt={r['attempt']}" for r in done]).drop("attempt")


def live_view(spark: SparkSession, path: str, run_id: str, name: str, schema) -> DataFrame:
    """The run's finished batches as a view queryable by ``name``; the rows stay in the
    history's files. Call it again to see batches finished since."""
    view = history(spark, path, run_id, schema)
    view.createOrReplaceTempView(name)
    return view


def snapshot(spark: SparkSession, path: str, run_id: str, schema=None) -> DataFrame:
    """Everything received so far, by time."""
    return history(spark, path, run_id, schema).orderBy(F.col("ts").asc_nulls_last())
