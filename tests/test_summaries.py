"""Summaries that follow the loads: equal to full scans, and written from the batch's dates alone."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spreadlab.plans import history, summaries
from spreadlab.sinks.tables import overwrite


def day(n):
    return dt.date(2024, 1, n)


def feed(spark, days, n=4, spread=1.0):
    return spark.createDataFrame([(day(d), f"0000000{d}{k}", "s", spread) for d in days for k in range(n)],
                                 "Date date, CUSIP string, Security string, `G Sprd` double")


def load(spark, path, days, **kw):
    more = {k: kw.pop(k) for k in ("n", "spread") if k in kw}
    return history.load_universe(feed(spark, days, **more), path, now=F.lit("2024-02-01").cast("timestamp"), **kw).first()


def scanned(spark, path):
    df = spark.read.parquet(path)
    return ({r.d: r.n for r in df.groupBy(F.col("Date").alias("d")).agg(F.count("*").alias("n")).collect()},
            {(r.Date, r.cusip_standardized) for r in df.collect()})


def kept(spark, path):
    return ({r.date: r.n_rows for r in summaries.per_date(spark, path).collect()},
            {(r.date, r.identifier) for r in summaries.identifiers(spark, path).collect()})


def test_every_load_leaves_what_a_full_scan_gives(spark, tmp_path):
    path = str(tmp_path / "t")
    for days, more in (((1, 2, 3), {}), ((4,), {}), ((3, 4), {"n": 2}), ((5,), {"n": 7}), ((2,), {"force": True, "n": 3})):
        row = load(spark, path, days, **more)
        assert kept(spark, path) == scanned(spark, path)
        assert row.stored_rows == spark.read.parquet(path).count()


def test_a_load_reads_only_its_dates(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    load(spark, path, (1, 2, 3))
    seen, plain = [], summaries.stored_dates

    def watched(*a):
        rows = plain(*a)  # the batch is gone when the load has ended, so it is looked at here
        seen.append({r.f for r in rows.select(F.input_file_name().alias("f")).distinct().collect()})
        return rows
    monkeypatch.setattr(summaries, "stored_table", lambda *a: pytest.fail("the whole table was read"))
    monkeypatch.setattr(summaries, "stored_dates", watched)
    load(spark, path, (3,), n=2)
    [files] = seen
    assert files and all("Date=2024-01-03" in f for f in files)


def test_a_table_from_before_gets_its_summaries(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, (1, 2))
    other = str(tmp_path / "u")
    overwrite(spark.read.parquet(path), other, "Date")
    row = load(spark, other, (3,), n=1)
    assert kept(spark, other) == scanned(spark, other) and row.stored_rows == 9 and row.update_type == "incremental"


def test_summaries_equal_the_reports_of_whole_tables(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([(day(1 + k % 3), f"c{k % 5}", "matched" if k % 4 else "unmatched") for k in range(40)] + [(None, None, "matched")],
                                 "Date date, cusip_standardized string, universe_match_status string")
    overwrite(rows, path, "Date")
    summaries.follow(rows, path, "Date", "cusip_standardized")
    stored = {"p": (rows, "Date")}
    columns = ["table_name", "total_cusips", "matched_cusips", "unmatched_cusips", "match_rate_percent", "reference_date"]
    assert summaries.match_summary(spark, {"p": path}).select(columns).collect() == history.match_summary(stored).select(columns).collect()
    assert summaries.row_counts(spark, {"p": path}).select("n_rows", "share_pct").first() == (41, 100.0)
    assert summaries.identifier_coverage(spark, {"p": path}, path).first().unique_cusips == 5
    assert summaries.freshness(spark, {"p": path}).first().latest_date == day(3)
    late = rows.filter("Date = '2024-01-02'").withColumn("universe_match_status", F.lit("matched"))
    from spreadlab.sinks.tables import replace_dates
    replace_dates(late, path, "Date")
    summaries.follow(late, path, "Date", "cusip_standardized")
    now = {"p": (spark.read.parquet(path), "Date")}
    assert summaries.match_summary(spark, {"p": path}).select(columns).collect() == history.match_summary(now).select(columns).collect()
