"""Sources, sinks, streams and history loads on temporary folders."""

from __future__ import annotations

import datetime as dt
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadlab import schemas
from spreadlab.plans import feeds, history
from spreadlab.session import checkpointed, scratch_root, staged
from spreadlab.sinks import tables as sinks
from spreadlab.sources import files
from spreadlab.streaming import ingest


def day(n):
    return dt.date(2024, 1, n)


@pytest.fixture
def vendor_folder(tmp_path):
    folder = tmp_path / "vendor files"
    folder.mkdir()
    (folder / "API 01.02.25.csv").write_text("CUSIP,Price,Note\n037833100,1.5,x\nA2,bad,\n")
    (folder / "API 01.03.25.csv").write_text("Price,CUSIP,Extra\n2.5,B1,7\n")
    (folder / "undated.csv").write_text("CUSIP,Price\nC1,3\n")
    return str(folder)


def test_dated_files_with_differing_columns(spark, vendor_folder):
    rows = files.read_dated_folder(spark, vendor_folder, "csv").orderBy("CUSIP").collect()
    assert [(r.CUSIP, r.Price, r.Extra, r.Date) for r in rows] == [
        ("037833100", "1.5", None, dt.date(2025, 1, 2)), ("A2", "bad", None, dt.date(2025, 1, 2)),
        ("B1", "2.5", "7", dt.date(2025, 1, 3))]
    with pytest.raises(Exception, match="no date in file name"):
        files.read_dated_folder(spark, vendor_folder, "csv", on_undated="fail")


def test_feed_with_its_own_date_is_rejected(spark, vendor_folder):
    with open(os.path.join(vendor_folder, "API 01.04.25.csv"), "w") as f:
        f.write("DATE,CUSIP\nx,y\n")
    with pytest.raises(ValueError, match="date column"):
        files.read_dated_folder(spark, vendor_folder, "csv")


def test_new_and_changed_files(spark, vendor_folder):
    state = checkpointed(files.file_inventory(spark, vendor_folder, "*.csv"))
    assert state.count() == 3
    assert files.read_dated_folder(spark, vendor_folder, "csv", state=state) is None
    changed = os.path.join(vendor_folder, "API 01.03.25.csv")
    with open(changed, "a") as f:
        f.write("9.5,B2,8\n")
    os.utime(changed, (time.time() + 10, time.time() + 10))
    again = files.read_dated_folder(spark, vendor_folder, "csv", state=state)
    assert sorted(r.CUSIP for r in again.collect()) == ["B1", "B2"]
    by_name = files.new_or_changed(files.file_inventory(spark, vendor_folder, "*.csv"), state, by=("file_name",))
    assert by_name.count() == 0


def test_dated_parquet_files(spark, tmp_path):
    for name, frame in {"P 06.15.49.parquet": {"CUSIP": ["a"]}, "P 06.15.50.parquet": {"CUSIP": ["b"], "Q": [1.0]}}.items():
        pd.DataFrame(frame).to_parquet(tmp_path / name)
    rows = files.read_dated_folder(spark, str(tmp_path), "parquet", pivot=50).orderBy("Date").collect()
    assert [(r.CUSIP, r.Q, r.Date.year) for r in rows] == [("b", 1.0, 1950), ("a", None, 2049)]


def test_missing_table_is_empty(spark, tmp_path):
    assert files.read_parquet(spark, str(tmp_path / "none"), schemas.PAIR_STATS).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_parquet(spark, str(tmp_path / "none"))


def test_csv_bad_numbers_become_null(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n1.5,x\nbad,y\nNaN,z\n")
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.StringType())])
    assert [r.a for r in files.read_any(spark, str(tmp_path / "f.csv"), schema).collect()] == [1.5, None, None]


ROWS = "d date, k string, t int, v double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def content(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(ROWS).parquet(path).select("d", "k", "t", "v").collect())


def test_merge_upsert_insert(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.merge_latest(frame(spark, (day(1), "a", 2, 1.0), (day(2), "a", 1, 2.0)), path, ["d", "k"], ["t"], "d")
    sinks.merge_latest(frame(spark, (day(1), "a", 1, 9.0), (day(1), "b", 1, 3.0)), path, ["d", "k"], ["t"], "d")
    assert content(spark, path) == [(day(1), "a", 2, 1.0), (day(1), "b", 1, 3.0), (day(2), "a", 1, 2.0)]
    sinks.upsert(frame(spark, (day(1), "a", 1, 7.0)), path, ["d", "k"], "d")
    sinks.insert_absent(frame(spark, (day(1), "a", 5, 5.0), (day(3), "c", 5, 5.0)), path, ["d", "k"], "d")
    sinks.insert_new_dates(frame(spark, (day(1), "z", 0, 0.0), (day(4), "z", 0, 0.0)), path, "d")
    assert content(spark, path) == [(day(1), "a", 1, 7.0), (day(1), "b", 1, 3.0), (day(2), "a", 1, 2.0),
                                    (day(3), "c", 5, 5.0), (day(4), "z", 0, 0.0)]
    sinks.replace_dates(frame(spark, (day(1), "q", 1, 1.0)), path, "d")
    assert [r[:2] for r in content(spark, path)] == [(day(1), "q"), (day(2), "a"), (day(3), "c"), (day(4), "z")]


def test_update_decisions(spark):
    old = frame(spark, *[(day(i), "a", 0, 0.0) for i in range(1, 11)])
    def decide(new_days, stored=old, **kw):
        row = sinks.update_decision(stored, frame(spark, *[(day(i), "a", 0, 0.0) for i in new_days]), "d", **kw).first()
        return row.update_type, row.reason
    assert decide([11]) == ("incremental", "no_date_overlap_detected")
    assert decide([10, 11, 12]) == ("incremental", "minimal_date_overlap")
    assert decide([10, 11]) == ("full_refresh", "significant_date_overlap_requires_full_refresh")
    assert decide([11], force=True) == ("full_refresh", "forced_full_refresh")
    assert decide([11], stored=old.filter("t > 0")) == ("full_refresh", "empty_table_requires_full_refresh")
    undated = sinks.update_decision(old, old.drop("d"), "d").first()
    assert undated.reason == "default_full_refresh"


def test_schema_compatibility(spark):
    df = frame(spark)
    assert sinks.schema_gap(df, ["d", "k", "x"]) == {"missing_in_data": ["x"], "missing_in_target": ["t", "v"]}
    assert sinks.require_compatible(df, ["v", "t", "k", "d"]) is df
    with pytest.raises(ValueError):
        sinks.require_compatible(df, ["d"])


def test_prepare_export(spark):
    df = spark.createDataFrame([(day(1), "09:30:15", float("nan"))], "Date date, Time string, `Bid Yield To Convention` double")
    assert sinks.prepare_export(df).first().asDict() == {"Date": "2024-01-01", "Time": "09:30", "Bid Yield to Convention": None}


def test_stream_sees_only_new_files(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    def run():
        ingest.append_new_files(ingest.file_stream(spark, source, frame(spark).schema), target, state)
    frame(spark, (day(1), "a", 1, 1.0)).write.parquet(source)
    run()
    frame(spark, (day(2), "b", 1, 2.0)).write.mode("append").parquet(source)
    run()
    run()
    assert content(spark, target) == [(day(1), "a", 1, 1.0), (day(2), "b", 1, 2.0)]


def test_stream_merge_is_repeatable(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    frame(spark, (day(1), "a", 1, 1.0), (day(1), "a", 2, 2.0), (day(2), "b", 1, 3.0)).write.parquet(source)
    for state in ("one", "two"):  # a lost checkpoint repeats the batch
        ingest.merge_new_files(ingest.file_stream(spark, source, frame(spark).schema), target, str(tmp_path / state),
                               ["d", "k"], ["t"], "d")
        assert content(spark, target) == [(day(1), "a", 2, 2.0), (day(2), "b", 1, 3.0)]


class _Context:
    def __init__(self, conf, master, checkpoint=None):
        self.conf, self.master, self.checkpoint = conf, master, checkpoint

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


class _Session:
    def __init__(self, *args):
        self.sparkContext = _Context(*args)


def test_scratch_follows_the_session_setting(spark):
    assert scratch_root(_Session({"spark.checkpoint.dir": "s3a://shared/scratch/"}, "yarn")) == "s3a://shared/scratch"
    with pytest.raises(RuntimeError):
        scratch_root(_Session({}, "yarn"))
    assert "spreadlab-" in scratch_root(_Session({}, "local[2]"))
    df = staged(frame(spark, (day(1), "a", 1, 1.0)), "x")
    assert scratch_root(spark).split(":")[-1] in df.inputFiles()[0]


def test_universe_build(spark):
    raw = spark.createDataFrame(
        [(day(1), "A", "10", "0.1", "n/a", 1), (day(1), "A", "11", "8", "5", 2), (day(1), None, "1", "1", "1", 3)],
        "Date date, CUSIP string, `G Sprd` string, `Yrs Since Issue` string, `Yrs (Mat)` string, row int")
    rows = feeds.build_universe(raw, order=["row"]).collect()
    assert len(rows) == 1 and rows[0].asDict() == {
        "Date": day(1), "CUSIP": "A", "G Sprd": 11.0, "Yrs Since Issue": 8.0, "Yrs (Mat)": 5.0,
        "Yrs Since Issue Bucket": ">7", "Yrs (Mat) Bucket": "4.1-5.1"}


def test_incremental_history_load(spark, tmp_path):
    schema = "Date date, CUSIP string, `G Sprd` double"
    path = str(tmp_path / "u")
    first = history.load_universe(spark.createDataFrame([(day(1), "456", 20000.0), (day(2), "A", 1500.0)], schema), path)
    assert first.first().reason == "empty_table_requires_full_refresh"
    second = history.load_universe(spark.createDataFrame(
        [(day(2), "A", 3.0), (day(3), "A", 4.0), (day(4), "A", 5.0)], schema), path)
    assert (second.first().update_type, second.first().stored_rows) == ("incremental", 4)
    rows = {(r.Date, r.CUSIP): (r.cusip_standardized, r["G Sprd"]) for r in spark.read.parquet(path).collect()}
    assert rows[(day(1), "456")] == ("456000000", None) and rows[(day(2), "A")] == ("A", 3.0)


def test_quality_log_feeds_the_dashboard(spark, tmp_path):
    log = spark.createDataFrame([("t", "passed"), ("t", "failed"), ("t", "warning"), ("t", "info")],
                                "table_name string, check_result string").withColumn("checked_at", F.current_timestamp())
    row = history.quality_dashboard(log).first()
    assert (row.total_checks, row.checks_passed, row.checks_failed, row.checks_warning, row.pass_rate_percent) == (4, 1, 1, 1, 25.0)
