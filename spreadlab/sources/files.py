"""Scans of Parquet and CSV files and of folders with one file per date."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadlab.functions.dates import century_date
from spreadlab.functions.scalars import nan_to_null_all, quoted
from spreadlab.session import staged
from spreadlab.sinks.buckets import without_bucket


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan without the bucket level of a table; a missing path gives an empty table of the schema."""
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return without_bucket(reader.parquet(path))
    except AnalysisException as error:
        if schema is None or error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
             encoding: str = "UTF-8", date_format: str | None = None) -> DataFrame:
    """CSV with a header; without a schema every column is text.

    Values that do not fit the schema become NULL; NaN becomes NULL as well.
    """
    reader = spark.read.option("header", True).option("encoding", encoding).option("mode", "PERMISSIVE")
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if schema:
        reader = reader.schema(schema)
    return nan_to_null_all(reader.csv(path if isinstance(path, str) else list(path)))


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV or Parquet by the extension of the path."""
    bare = path.rstrip("/").lower()
    if bare.endswith((".csv", ".csv.gz", ".txt")):
        return read_csv(spark, path, schema)
    return read_parquet(spark, path, schema)


def reject_date_column(columns: Sequence[str], name: str = "Date") -> None:
    """A feed that gets its date from the file name must not bring one."""
    clash = [c for c in columns if c.strip().lower() == name.lower()]
    if clash:
        raise ValueError(f"feed already has a date column: {', '.join(clash)}")


def file_inventory(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, name, modification time and size of the files in a folder.

    Only the listing is read, not the files.
    """
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
               .option("pathGlobFilter", pattern).load(folder))
    return listing.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"),
                          F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def new_or_changed(inventory: DataFrame, state: DataFrame | None,
                   by: Sequence[str] = ("file_name", "modified", "size")) -> DataFrame:
    """Files that the saved state does not hold in this version.

    ``by=("file_name",)`` is the name-only form, which ignores changes.
    """
    if state is None:
        return inventory
    return inventory.join(state.select(*by), list(by), "left_anti")


def saved_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The files a build has read, each in the version it read last; None before the first."""
    try:
        log = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    version = F.struct("path", "file_name", "modified", "size")
    return log.groupBy("path").agg(F.max_by(version, F.struct("recorded_at", "run_id")).alias("f")).select("f.*")


def save_state(inventory: DataFrame, path: str, run_id: str) -> None:
    """Append the files of a run to the state; to be called when they are in the table.

    The state is a log: an append is committed as a whole or not at all, and what earlier runs
    recorded is never rewritten.  A run that is repeated records its files again, to the same effect.
    """
    rows = inventory.select("path", "file_name", "modified", "size", F.lit(run_id).alias("run_id"),
                            F.current_timestamp().alias("recorded_at"))
    rows.hint("rebalance").write.mode("append").parquet(path)


def dated_files(inventory: DataFrame, pivot: int = 69, on_undated: str = "skip",
                dated_by: str = "file_name") -> DataFrame:
    """Files with the date of their name; undated ones are skipped or fail.

    ``dated_by="path"`` also accepts the date in a folder name.
    """
    dated = inventory.withColumn("file_date", century_date(F.col(dated_by), pivot))
    if on_undated == "skip":
        return dated.filter(F.col("file_date").isNotNull())
    message = F.concat(F.lit("no date in file name: "), F.col("file_name"))
    return dated.withColumn("file_date", F.coalesce("file_date", F.raise_error(message).cast("date")))


def _plain_path(c: Column) -> Column:
    """Readable form of a ``_metadata`` path, which is percent-encoded."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def _first_line(spark: SparkSession, path: str, encoding: str) -> str:
    """First line of a file, of which only the first buffer is read; compressed files by their extension."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        source = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, encoding)).readLine() or ""
    finally:
        stream.close()


def csv_layouts(spark: SparkSession, paths: Sequence[str], encoding: str = "UTF-8") -> list[tuple[list[str], list[str]]]:
    """Files grouped by their header line: (column names, paths).

    Each file is opened once by a pool of threads, through the file system Spark uses, and only
    its first buffer is read, whatever its size.  What the driver holds is one line per file,
    beside the file names, which its listing holds anyway.
    """
    with ThreadPoolExecutor(16) as pool:
        headers = pool.map(lambda p: _first_line(spark, p, encoding), paths)
        files: dict[str, list[str]] = {}
        for path, header in zip(paths, headers):
            files.setdefault(header, []).append(path)
    return [(next(csv.reader([header.lstrip("\ufeff")])), sorted(files[header])) for header in sorted(files) if header]


def read_by_name(spark: SparkSession, paths: Sequence[str], fmt: str, encoding: str = "UTF-8") -> DataFrame:
    """Files of differing column sets, united by column name, with their path."""
    if fmt == "parquet":
        feed = spark.read.option("mergeSchema", True).parquet(*paths)
        return feed.select(*[quoted(c) for c in feed.columns], _plain_path(F.col("_metadata.file_path")).alias("source_file"))
    if fmt != "csv":
        raise ValueError(f"unsupported feed format {fmt!r}")
    united = None
    for columns, files in csv_layouts(spark, paths, encoding):
        # read by position, as a header name may occur twice; of equal names (in any case) the first counts
        reader = spark.read.option("header", True).option("enforceSchema", True).option("encoding", encoding)
        schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(columns))])
        first = {name.lower(): i for i, name in reversed(list(enumerate(columns)))}
        part = reader.schema(schema).csv(files).select(
            *[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns) if first[c.lower()] == i],
            _plain_path(F.col("_metadata.file_path")).alias("source_file"))
        united = part if united is None else united.unionByName(part, allowMissingColumns=True)
    return united


def read_dated_folder(spark: SparkSession, folder: str, fmt: str, pivot: int = 69,
                      on_undated: str = "skip", state: DataFrame | None = None,
                      date: str = "Date", dated_by: str = "file_name",
                      whole_dates: bool = False) -> DataFrame | None:
    """All new files of a folder as one table with their date in front.

    ``state`` (as given by :func:`file_inventory`) leaves out files already
    processed; ``None`` is a full refresh.  With ``whole_dates`` the other
    files of a new file's date are read as well, so that its rows can replace
    the date.  Returns None when nothing is new.
    """
    inventory = file_inventory(spark, folder, f"*.{fmt}")
    files = dated_files(new_or_changed(inventory, state), pivot, on_undated, dated_by)
    if whole_dates and state is not None:
        files = dated_files(inventory, pivot, on_undated, dated_by).join(
            files.select("file_date").distinct(), "file_date", "left_semi")
    paths = [row.path for row in files.select("path", "file_date").collect()]
    if not paths:
        return None
    feed = read_by_name(spark, paths, fmt)
    own = [c for c in feed.columns if c != "source_file"]
    reject_date_column(own, date)
    path = F.col("source_file")
    text = path if dated_by == "path" else F.element_at(F.split(path, "/"), -1)
    return feed.select(century_date(text, pivot).alias(date), *[quoted(c) for c in own], path)
