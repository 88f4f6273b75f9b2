"""File streams that process every new file once and then stop.

``availableNow`` runs suit a scheduler: each call handles the files that
arrived since the last one, split into batches by Spark, and the checkpoint in
the shared folder remembers them.  A batch may be repeated after a failure, so
the batch writers are idempotent (merge by key, replace by date); plain copies
use the exactly-once file sink.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spreadlab.session import exists
from spreadlab.sinks.tables import merge_latest, replace_dates

Transform = Callable[[DataFrame], DataFrame]


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None, **options) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(folder)


def _run(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append_new_files(stream: DataFrame, target: str, checkpoint: str, date: str | None = None) -> None:
    """Copy the rows of unseen files to a Parquet table, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", target)
    _run(writer.partitionBy(date) if date else writer, checkpoint)


def merge_new_files(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str],
                    order: Sequence[str], date: str, transform: Transform = lambda df: df,
                    buckets: int | None = None) -> None:
    """Merge every batch into a dated table; the latest row per key wins.

    ``buckets`` divides the dates of a new table, so that a batch rewrites only its keys' buckets.
    """
    def merge(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            merge_latest(transform(batch), target, keys, order, date, buckets)
    _run(stream.writeStream.foreachBatch(merge), checkpoint)


def replace_new_dates(stream: DataFrame, target: str, checkpoint: str, date: str,
                      transform: Transform = lambda df: df) -> None:
    """The dates of the new files replace the stored dates (late or corrected files).

    All batches of a run are gathered beside the checkpoint, each under its own
    number, so that a repeated batch overwrites itself; the dates are replaced
    once, from all of them.  So a date may be spread over files and batches.

    Two markers make a run an epoch that survives a break at any step: *gathered*
    says that all batches are there, *replaced* that they are in the table.  The
    next run first ends what it finds: gathered batches are replaced as their own run would have
    done, replaced ones only removed (the marker last).  Batches without a marker belong to a run
    that broke while gathering; the next run goes on with it.
    """
    spark = stream.sparkSession
    gathered, markers = (f"{checkpoint.rstrip('/')}-{part}" for part in ("gathered", "epoch"))

    def gather(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            transform(batch).write.mode("overwrite").parquet(f"{gathered}/batch={number}")

    def finish() -> None:
        if not exists(spark, f"{markers}/replaced"):
            rows = _gathered(spark, gathered)
            if rows is not None:
                replace_dates(rows, target, date)
            _mark(spark, f"{markers}/replaced")
        for path in (gathered, f"{markers}/gathered", f"{markers}/replaced"):
            _remove(spark, path)

    if exists(spark, f"{markers}/gathered") or exists(spark, f"{markers}/replaced"):
        finish()
    _run(stream.writeStream.foreachBatch(gather), checkpoint)
    _mark(spark, f"{markers}/gathered")
    finish()


def _gathered(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", True).parquet(path).drop("batch")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _mark(spark: SparkSession, path: str) -> None:
    """An empty file that says a step is done."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True).close()


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
