"""Key buckets: a second partition level below the date.

A day of a large table is hundreds of gigabytes, so a merge that rewrites whole
days does so for a single changed row.  A bucketed table divides every day by a
hash of key columns, and a merge reads and rewrites only the (date, bucket)
partitions its rows fall in.  The partition column's name says how rows are
dealt (``bucket_of_16_by_cusip,dealer``), so the layout is part of the table,
cannot get out of step with it and needs no file of its own.  Tables without
that level stay as they are; ``rebucket`` gives a table another layout.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spreadlab.functions.scalars import quoted

BUCKET_COLUMN = re.compile(r"bucket_of_(\d+)_by_(.+)")


@dataclass(frozen=True)
class Buckets:
    """Number of buckets of every date, and the columns whose hash deals the rows."""

    count: int
    by: tuple[str, ...]

    def __post_init__(self) -> None:
        if self.count < 1 or not self.by or not all(re.fullmatch(r"[\w .-]+", c) for c in self.by):
            raise ValueError(f"{self} cannot name a partition level")

    @property
    def column(self) -> str:
        return f"bucket_of_{self.count}_by_{','.join(self.by)}"

    def of_row(self) -> Column:
        """The bucket of a row; keys are hashed as text, so that an int and a long key agree."""
        return F.pmod(F.xxhash64(*[quoted(c).cast("string") for c in self.by]), F.lit(self.count)).cast("int")

    def covers(self, keys: Sequence[str]) -> bool:
        """Whether rows of equal ``keys`` always share a bucket."""
        return set(self.by) <= set(keys)


def named_buckets(names: Sequence[str]) -> Buckets | None:
    """The layout that the columns of a stored table tell."""
    for name in names:
        found = BUCKET_COLUMN.fullmatch(name)
        if found:
            return Buckets(int(found[1]), tuple(found[2].split(",")))
    return None


def without_bucket(df: DataFrame) -> DataFrame:
    return df.drop(*[quoted(c) for c in df.columns if BUCKET_COLUMN.fullmatch(c)])


def stored_buckets(spark: SparkSession, path: str, date: str) -> Buckets | None:
    """Layout of the table at ``path``, from the names of one date's folders; no file is read."""
    jvm = spark._jvm.org.apache.hadoop.fs
    root = jvm.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return None
    for day in system.listStatus(root):
        name = day.getPath().getName()
        if day.isDirectory() and name.lower().startswith(f"{date.lower()}="):
            inner = [s.getPath().getName() for s in system.listStatus(day.getPath()) if s.isDirectory()]
            return named_buckets([n.rpartition("=")[0] for n in inner])
    return None


def stored_with_bucket(spark: SparkSession, path: str, buckets: Buckets, schema) -> DataFrame:
    """Stored rows of a bucketed table with its bucket column."""
    try:
        rows = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        rows = spark.createDataFrame([], schema)
    return rows if buckets.column in rows.columns else rows.withColumn(buckets.column, F.lit(None).cast("int"))


def touched(stored: DataFrame, new: DataFrame, buckets: Buckets, date: str, keys: Sequence[str]) -> DataFrame:
    """Rows of ``stored`` in partitions that rows of ``new`` may replace something in.

    The dates and the partitions are scalar subqueries over ``new``, whose
    values prune the listing before any file is read.  Keys without the date may
    replace a row of any touched date; keys that do not fix the bucket, of any bucket.
    """
    day = F.coalesce(quoted(date).cast("string"), F.lit(""))
    bucket = quoted(buckets.column).cast("string")
    dates = new.agg(F.collect_set(day)).scalar()
    rows = stored.filter(F.array_contains(dates, day))
    if not buckets.covers(keys):
        return rows
    place = F.concat(bucket, F.lit("@"), day) if date in keys else bucket
    places = new.withColumn(buckets.column, buckets.of_row()).agg(F.collect_set(place)).scalar()
    return rows.filter(F.array_contains(places, place))


def emptied(stored: DataFrame, new: DataFrame, buckets: Buckets, date: str) -> list[str]:
    """Partition folders of the dates in ``new`` that no row of ``new`` falls in."""
    there = touched(stored, new, buckets, date, ()).select(quoted(date), quoted(buckets.column), F.col("_metadata.file_path"))
    there = there.groupBy(quoted(date).alias("_d"), quoted(buckets.column).alias("_b")).agg(F.min("file_path").alias("_file"))
    kept = new.select(quoted(date).alias("_d"), buckets.of_row().alias("_b")).distinct().withColumn("_kept", F.lit(True))
    same = there["_d"].eqNullSafe(kept["_d"]) & (there["_b"] == kept["_b"])
    gone = there.join(kept, same, "left").filter("_kept IS NULL").select("_file")
    return [r["_file"].rpartition("/")[0] for r in gone.collect()]
