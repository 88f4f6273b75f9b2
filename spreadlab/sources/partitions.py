"""What the folder names of a dated table tell: its dates, without reading a file.

A question like "which is the latest date" needs the listing of one folder, not
a scan of the date column.  The listing is one row per date, a few thousand at
most, and comes from the table's own file system.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadlab.functions.scalars import quoted
from spreadlab.sources.files import read_parquet

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [status.getPath().toString() for status in found or ()]


def _holds_data(spark: SparkSession, folder: str) -> bool:
    """Whether a data file lies in the folder or below it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(place, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def _folders(spark: SparkSession, path: str, date: str) -> dict[dt.date | None, str]:
    found = {}
    for folder in _listed(spark, f"{path.rstrip('/')}/{date}=*"):
        value = unquote(folder.rstrip("/").rpartition("=")[2])
        found[None if value == NO_VALUE else dt.date.fromisoformat(value)] = folder
    return found


def stored_calendar(spark: SparkSession, path: str, date: str) -> DataFrame:
    """The dates of a table that is partitioned by ``date``, rows without date as NULL; no rows when there is no table."""
    days = sorted(_folders(spark, path, date), key=lambda d: d or dt.date.min)
    return spark.createDataFrame([(d,) for d in days], T.StructType([T.StructField(date, T.DateType())]))


def latest_stored(spark: SparkSession, path: str, date: str) -> dt.date | None:
    """The latest date that has a data file, None when there is none."""
    folders = _folders(spark, path, date)
    for day in sorted((d for d in folders if d), reverse=True):
        if _holds_data(spark, folders[day]):
            return day
    return None


def stored_snapshot(spark: SparkSession, path: str, date: str, schema: T.StructType) -> DataFrame:
    """Rows of the latest stored date; only its partition is read."""
    return read_parquet(spark, path, schema).filter(quoted(date) == F.lit(latest_stored(spark, path, date)).cast("date"))


def stored_freshness(spark: SparkSession, tables: dict[str, tuple[str, str]]) -> DataFrame:
    """Latest date per table, from ``name: (path, date column)``."""
    return spark.createDataFrame([(name, latest_stored(spark, path, date)) for name, (path, date) in tables.items()],
                                 "table_name string, latest_date date")
