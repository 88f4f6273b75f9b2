"""Merges below the date: which partitions are read and rewritten, and what stands in them."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spreadlab.sinks import tables as sinks
from spreadlab.sinks.buckets import Buckets, named_buckets, stored_buckets
from spreadlab.sources.files import read_parquet
from spreadlab.streaming.ingest import file_stream, merge_new_files

SCHEMA = "d date, k string, t int, v double"


def day(n):
    return dt.date(2024, 3, n)


def rows(spark, n=200, days=(1, 2, 3), t=0):
    return spark.createDataFrame([(day(d), f"k{i}", t, float(i)) for d in days for i in range(n)], SCHEMA)


def files(path):
    """Names of the data files per partition folder."""
    found = {}
    for f in sorted(Path(path).rglob("*.parquet")):
        found.setdefault(str(f.parent.relative_to(path)), set()).add(f.name)
    return found


def content(spark, path):
    return sorted(tuple(r) for r in read_parquet(spark, path).select("d", "k", "t", "v").collect())


def changed(before, after):
    return {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}


@pytest.mark.parametrize("merge", [
    lambda df, path, **kw: sinks.merge_latest(df, path, ["d", "k"], ["t"], "d", **kw),
    lambda df, path, **kw: sinks.upsert(df, path, ["d", "k"], "d", ["t"], **kw)])
def test_few_keys_rewrite_only_their_buckets(spark, tmp_path, merge):
    path = str(tmp_path / "t")
    merge(rows(spark), path, buckets=8)
    before = files(path)
    assert len(before) == 24 and stored_buckets(spark, path, "d") == Buckets(8, ("k",))
    batch = spark.createDataFrame([(day(2), "k7", 9, -1.0), (day(3), "new", 9, -2.0)], SCHEMA)
    merge(batch, path)
    touched = {f"d=2024-03-0{r.d.day}/bucket_of_8_by_k={r.b}" for r in
               batch.select("d", Buckets(8, ("k",)).of_row().alias("b")).collect()}
    assert changed(before, files(path)) == touched and len(touched) == 2
    want = {(r.d, r.k): tuple(r) for r in rows(spark).collect()} | {(r.d, r.k): tuple(r) for r in batch.collect()}
    assert content(spark, path) == sorted(want.values())
    assert "bucket_of_8_by_k" not in read_parquet(spark, path).columns


def test_only_touched_partitions_are_read(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    sinks.merge_latest(rows(spark), path, ["d", "k"], ["t"], "d", buckets=8)
    batch = spark.createDataFrame([(day(2), "k7", 9, -1.0)], SCHEMA)
    layout = stored_buckets(spark, path, "d")
    read = sinks._stored_touched(batch, path, "d", layout, ["d", "k"])
    assert read.select(F.input_file_name().alias("f")).distinct().count() == 1
    assert "PartitionFilters: [isnotnull" in plan(read) or "PartitionFilters: [array_contains" in plan(read)


def test_plain_tables_stay_plain_and_can_be_divided_later(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(rows(spark, 20), path, ["d", "k"], "d")
    sinks.upsert(rows(spark, 2, (1,), t=1), path, ["d", "k"], "d", buckets=8)  # stored layout wins
    assert stored_buckets(spark, path, "d") is None and set(files(path)) == {f"d=2024-03-0{n}" for n in (1, 2, 3)}
    before = content(spark, path)
    sinks.rebucket(spark, path, "d", rows(spark).schema, Buckets(4, ("k",)))
    assert content(spark, path) == before and stored_buckets(spark, path, "d") == Buckets(4, ("k",))
    sinks.insert_absent(rows(spark, 21, (1, 4), t=2), path, ["d", "k"], "d")
    sinks.insert_new_dates(rows(spark, 1, (5,)), path, "d")
    assert [r for r in content(spark, path) if r not in before] == (
        [(day(1), "k20", 2, 20.0)] + sorted((day(4), f"k{i}", 2, float(i)) for i in range(21)) + [(day(5), "k0", 0, 0.0)])
    assert all("bucket_of_4_by_k=" in p for p in files(path))
    sinks.rebucket(spark, path, "d", rows(spark).schema, None)
    assert stored_buckets(spark, path, "d") is None


def test_replaced_dates_leave_no_stale_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_dates(rows(spark, 40), path, "d", buckets=Buckets(8, ("k",)))
    sinks.replace_dates(rows(spark, 1, (2,), t=5), path, "d")
    assert [r for r in content(spark, path) if r[0] == day(2)] == [(day(2), "k0", 5, 0.0)]
    assert sum(p.startswith("d=2024-03-02") for p in files(path)) == 1
    assert sum(r[0] != day(2) for r in content(spark, path)) == 80


def test_missing_dates_wider_types_and_keys_that_do_not_fix_the_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "d date, k int, o int, v double"
    start = [(None, i, 0, 0.0) for i in range(30)] + [(day(1), i, 0, 0.0) for i in range(30)]
    sinks.upsert(spark.createDataFrame(start, schema), path, ["d", "k"], "d", buckets=4)
    wide = spark.createDataFrame([(None, 3, 0, 1.0), (day(1), 4, 0, 2.0)], schema.replace("k int", "k long"))
    sinks.upsert(wide, path, ["d", "k"], "d")
    got = {(r.d, r.k): r.v for r in read_parquet(spark, path, wide.schema).collect()}
    assert len(got) == 60 and got[(None, 3)] == 1.0 and got[(day(1), 4)] == 2.0 and sum(got.values()) == 3.0
    # rows of one (d, o) lie in several buckets: all of the date are read, all but the last go
    other = str(tmp_path / "u")
    sinks.upsert(spark.createDataFrame(start[30:] + [(day(2), 1, 0, 0.0)], schema), other, ["d", "k"], "d", buckets=4)
    layout = stored_buckets(spark, other, "d")
    one = spark.createDataFrame([(day(1), 99, 0, 7.0)], schema)
    assert sinks._stored_touched(one, other, "d", layout, ["d", "o"]).count() == 30


def test_stream_batches_merge_into_buckets(spark, tmp_path):
    feed, target = str(tmp_path / "in"), str(tmp_path / "t")
    rows(spark, 50).write.parquet(feed)
    merge_new_files(file_stream(spark, feed, rows(spark).schema), target, str(tmp_path / "c"), ["d", "k"], ["t"], "d", buckets=8)
    before = files(target)
    rows(spark, 1, (3,), t=4).write.mode("append").parquet(feed)
    merge_new_files(file_stream(spark, feed, rows(spark).schema), target, str(tmp_path / "c"), ["d", "k"], ["t"], "d", buckets=8)
    assert len(changed(before, files(target))) == 1
    assert content(spark, target) == sorted([tuple(r) for r in rows(spark, 50).collect() if (r.d, r.k) != (day(3), "k0")] + [(day(3), "k0", 4, 0.0)])


def test_layout_names(spark):
    assert named_buckets(["d", Buckets(16, ("cusip", "Bid Size")).column]) == Buckets(16, ("cusip", "Bid Size"))
    assert named_buckets(["d", "bucket"]) is None
    for bad in (("a,b",), (), ("a/b",)):
        with pytest.raises(ValueError):
            Buckets(4, bad)
