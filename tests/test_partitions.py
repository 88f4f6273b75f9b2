"""Dates from folder names, headers from first bytes, state as a log."""

from __future__ import annotations

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from spreadlab.plans import feeds
from spreadlab.sinks.buckets import Buckets
from spreadlab.sinks.tables import overwrite, replace_dates
from spreadlab.sources import files
from spreadlab.sources.partitions import latest_stored, stored_calendar, stored_freshness, stored_snapshot

SCHEMA = "d date, k int"


def day(n):
    return dt.date(2024, 1, n)


@pytest.fixture
def path(spark, tmp_path):
    place = str(tmp_path / "t")
    overwrite(spark.createDataFrame([(day(1 + i % 4), i) for i in range(40)] + [(None, 99)], SCHEMA), place, "d")
    return place


def test_dates_come_from_the_listing(spark, path, plan):
    days = stored_calendar(spark, path, "d")
    assert [r.d for r in days.collect()] == [None, day(1), day(2), day(3), day(4)]
    assert "FileScan" not in plan(days) and latest_stored(spark, path, "d") == day(4)
    assert [tuple(r) for r in stored_freshness(spark, {"t": (path, "d")}).collect()] == [("t", day(4))]


def test_only_the_latest_partition_is_read(spark, path, plan):
    rows = stored_snapshot(spark, path, "d", spark.createDataFrame([], SCHEMA).schema)
    assert sorted(r.k for r in rows.collect()) == list(range(3, 40, 4))
    assert "d=2024-01-04" in rows.select(F.input_file_name().alias("f")).first().f
    assert "PartitionFilters: [isnotnull(d" in plan(rows)


def test_empty_folders_and_tables_have_no_date(spark, path, tmp_path):
    os.makedirs(f"{path}/d=2024-01-09")
    assert latest_stored(spark, path, "d") == day(4)
    none = str(tmp_path / "none")
    assert latest_stored(spark, none, "d") is None and stored_calendar(spark, none, "d").count() == 0
    assert stored_snapshot(spark, none, "d", spark.createDataFrame([], SCHEMA).schema).count() == 0


def test_bucketed_tables(spark, tmp_path):
    path = str(tmp_path / "b")
    replace_dates(spark.createDataFrame([(day(1), 1), (day(2), 2)], SCHEMA), path, "d", buckets=Buckets(4, ("k",)))
    assert latest_stored(spark, path, "d") == day(2)
    assert [tuple(r) for r in stored_snapshot(spark, path, "d", spark.createDataFrame([], SCHEMA).schema).select("d", "k").collect()] == [(day(2), 2)]


def test_headers_are_read_from_the_first_bytes(spark, tmp_path, monkeypatch):
    body = "\n".join(f"{i},x" for i in range(50_000))
    (tmp_path / "a.csv").write_text(f"A,B\n{body}")
    (tmp_path / "b c.csv").write_text("﻿A,B\n1,2")
    (tmp_path / "d.csv").write_text('"A","C,D"\n1,2')
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "f.csv.gz").write_bytes(gzip.compress(b"A,B\n7,8\n"))
    names = ["a.csv", "b c.csv", "d.csv", "e.csv", "f.csv.gz"]
    monkeypatch.setattr(type(spark.read), "text", lambda *a, **k: pytest.fail("the text was scanned"))
    found = files.csv_layouts(spark, [f"file:{tmp_path}/{n}" for n in names])
    assert sorted((columns, [os.path.basename(p) for p in paths]) for columns, paths in found) == [
        (["A", "B"], ["a.csv", "f.csv.gz"]), (["A", "B"], ["b c.csv"]), (["A", "C,D"], ["d.csv"])]
    rows = files.read_by_name(spark, [f"file:{tmp_path}/{n}" for n in names], "csv")
    assert rows.count() == 50_003 and set(rows.columns) == {"A", "B", "C,D", "source_file"}


def test_state_is_a_log_of_versions(spark, tmp_path):
    path, schema = str(tmp_path / "state"), "path string, file_name string, modified timestamp, size long"
    at = lambda h: dt.datetime(2024, 1, 1, h)
    one = spark.createDataFrame([("p/a", "a", at(1), 5), ("p/b", "b", at(1), 5)], schema)
    files.save_state(one, path, "r1")
    files.save_state(one, path, "r1")  # repeated
    files.save_state(spark.createDataFrame([("p/a", "a", at(2), 6)], schema), path, "r2")
    state = files.saved_state(spark, path)
    assert sorted((r.file_name, r.modified, r.size) for r in state.collect()) == [("a", at(2), 6), ("b", at(1), 5)]
    back = spark.createDataFrame([("p/a", "a", at(1), 5), ("p/b", "b", at(1), 5)], schema)
    assert [r.file_name for r in files.new_or_changed(back, state).collect()] == ["a"]  # an older version again is a change


# --- rules of the portfolio feed and the quality log -------------------------------


def feed_paths(tmp_path, name):
    folder = tmp_path / name / "files"
    folder.mkdir(parents=True)
    return folder, feeds.FeedPaths(str(folder), *[str(tmp_path / name / p) for p in ("table", "state", "log")])


NOW = "2024-02-01"


def test_portfolio_years_below_fifty_are_of_this_century(spark, tmp_path):
    folder, paths = feed_paths(tmp_path, "p")
    (folder / "API 01.02.55.csv").write_text("SECURITY,CUSIP,QUANTITY\ns,c1,1\n")
    (folder / "API 01.02.49.csv").write_text("SECURITY,CUSIP,QUANTITY\ns,c1,1\n")
    feeds.refresh_portfolio(spark, paths, now=F.lit(NOW).cast("timestamp"))
    assert sorted(str(r.Date) for r in spark.read.parquet(paths.table).collect()) == ["1955-01-02", "2049-01-02"]


def test_a_portfolio_file_without_date_fails_and_is_not_remembered(spark, tmp_path):
    folder, paths = feed_paths(tmp_path, "p")
    (folder / "API latest.csv").write_text("SECURITY,CUSIP,QUANTITY\ns,c1,1\n")
    with pytest.raises(Exception, match="no date in file name"):
        feeds.refresh_portfolio(spark, paths, now=F.lit(NOW).cast("timestamp"))
    assert files.saved_state(spark, paths.state) is None
    (folder / "API latest.csv").rename(folder / "API 01.03.24.csv")
    assert feeds.refresh_portfolio(spark, paths, now=F.lit(NOW).cast("timestamp")).first().rows_written == 1


def test_a_universe_file_without_date_waits(spark, tmp_path):
    folder, paths = feed_paths(tmp_path, "u")
    (folder / "API 01.02.24.csv").write_text("CUSIP,Security,G Sprd\nc1,s,1\n")
    (folder / "API latest.csv").write_text("CUSIP,Security,G Sprd\nc2,s,1\n")
    run = lambda: feeds.refresh_universe(spark, paths, now=F.lit(NOW).cast("timestamp")).first()
    assert run().rows_written == 1 and run().new_files == 0
    assert [r.file_name for r in files.saved_state(spark, paths.state).collect()] == ["API 01.02.24.csv"]
    (folder / "API latest.csv").rename(folder / "API 01.03.24.csv")
    assert run().rows_stored == 2


def test_a_repeated_run_logs_its_checks_once(spark, tmp_path, monkeypatch):
    folder, paths = feed_paths(tmp_path, "u")
    (folder / "API 01.02.24.csv").write_text("CUSIP,Security,G Sprd\nc1,s,1\n")
    run = lambda: feeds.refresh_universe(spark, paths, now=F.lit(NOW).cast("timestamp"))
    with monkeypatch.context() as patched:
        patched.setattr(feeds, "save_state", lambda *a: (_ for _ in ()).throw(RuntimeError("broken")))
        with pytest.raises(RuntimeError):
            run()
    logged = spark.read.parquet(paths.quality_log).count()
    run()
    assert spark.read.parquet(paths.quality_log).count() == logged > 0
    (folder / "API 01.03.24.csv").write_text("CUSIP,Security,G Sprd\nc1,s,1\n")
    run()
    assert spark.read.parquet(paths.quality_log).count() == 2 * logged
