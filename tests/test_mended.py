"""Cases in which data was once lost, coerced wrongly or chosen by chance."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spreadlab.functions.scalars import nan_to_null_all, to_double, to_timestamp
from spreadlab.operators.dedup import first_non_null, last_non_null
from spreadlab.operators.lookups import last_value_mapping
from spreadlab.operators.panel import last_per_cell
from spreadlab.operators.quotes import roll_up
from spreadlab.operators.reshape import without_repeated_headers
from spreadlab.plans import feeds, history
from spreadlab.sinks.tables import insert_absent, insert_new_dates, merge_latest, prepare_export, upsert
from spreadlab.sources.files import read_by_name, read_dated_folder
from spreadlab.streaming.ingest import file_stream, replace_new_dates

def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def days(spark, n, **columns):
    df = spark.range(n).select((F.lit("2024-01-01").cast("date") + F.col("id").cast("int")).alias("Date"),
                               F.col("id").cast("string").alias("CUSIP"), F.lit(1.0).alias("G Sprd"))
    return df.withColumns(columns)


@pytest.mark.parametrize("force, left", [(False, 20), (True, 1)])
def test_a_reloaded_date_leaves_the_history(spark, tmp_path, force, left):
    path = str(tmp_path / "t")
    history.load_universe(days(spark, 20), path, now=now())
    last = days(spark, 20).filter("Date = '2024-01-20'").withColumn("G Sprd", F.lit(2.0))
    assert history.load_universe(last, path, now=now(), force=force).first().stored_rows == left
    stored = spark.read.parquet(path)
    assert stored.count() == left and stored.filter("`G Sprd` = 2").count() == 1


def test_skipped_quotes_are_counted(spark, tmp_path):
    path = str(tmp_path / "t")
    feed = lambda d, c: days(spark, 9).filter(d).withColumns({"Dealer": F.lit(c), "Time": F.lit("09:00")})
    history.load_quotes(feed("Date < '2024-01-04'", "a"), path, now=now())
    said = history.load_quotes(feed("Date >= '2024-01-03'", "b"), path, now=now()).first()
    assert said.stored_rows == 9 and "1 rows of stored dates skipped" in said.reason


@pytest.mark.parametrize("write", [
    lambda df, path: merge_latest(df, path, ["k"], ["o"], "d"), lambda df, path: upsert(df, path, ["k"], "d", ["o"])])
def test_a_narrower_batch_and_missing_dates(spark, tmp_path, write):
    path, day = str(tmp_path / "t"), dt.date(2024, 1, 1)
    write(spark.createDataFrame([("a", day, 1, 7.0), ("b", day, 1, 8.0), ("n", None, 1, 9.0)], "k string, d date, o int, x double"), path)
    write(spark.createDataFrame([("c", day, 2), ("m", None, 2)], "k string, d date, o int"), path)
    rows = {r.k: r.x for r in spark.read.parquet(path).collect()}
    assert rows == {"a": 7.0, "b": 8.0, "n": 9.0, "c": None, "m": None}


def test_appends_keep_the_wider_columns(spark, tmp_path):
    path, day = str(tmp_path / "t"), dt.date(2024, 1, 1)
    wide = spark.createDataFrame([("a", day, 7.0)], "k string, d date, x double")
    insert_absent(wide, path, ["k"], "d")
    insert_absent(spark.createDataFrame([("a", day), ("b", day)], "k string, d date"), path, ["k"], "d")
    assert insert_new_dates(spark.createDataFrame([("c", day), ("e", dt.date(2024, 1, 2))], "k string, d date"), path, "d") == 1
    stored = spark.read.parquet(path)
    assert {r.k: r.x for r in stored.collect()} == {"a": 7.0, "b": None, "e": None}


def test_a_date_as_instant_is_refused(spark, tmp_path):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 3))], "k string, d timestamp")
    with pytest.raises(ValueError, match="date"):
        upsert(df, str(tmp_path / "t"), ["k"], "d")


def test_a_date_in_several_batches(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.range(10).select(F.lit("2024-01-01").cast("date").alias("d"), "id")
    df.repartition(2).write.parquet(folder)
    stream = lambda: file_stream(spark, folder, df.schema, max_files=1)
    replace_new_dates(stream(), target, str(tmp_path / "state"), "d")
    assert spark.read.parquet(target).count() == 10
    replace_new_dates(stream(), target, str(tmp_path / "state"), "d")
    assert spark.read.parquet(target).count() == 10 and not (tmp_path / "state-gathered").exists()


def test_last_does_not_depend_on_partitions(spark):
    rows = [("k", "09:00", float(v % 7), None if v % 3 else float(v)) for v in range(40)]
    df = spark.createDataFrame(rows, "k string, t string, a double, b double")
    forms = [lambda d: last_non_null(d, ["k"], ["t"]), lambda d: first_non_null(d, ["k"], ["t"]),
             lambda d: last_value_mapping(d, "k", "a", ["t"]), lambda d: last_per_cell(d, "t", "k", "a", ["t"], ["b"]),
             lambda d: roll_up(d, ["k"], {"first": ["a", "b"]}, ["t"])]
    for form in forms:
        seen = {tuple(form(df.repartition(n, F.rand(n))).first()) for n in (1, 2, 3, 5, 8)}
        assert len(seen) == 1, seen


def test_only_plain_numbers_are_numbers(spark):
    texts = ["5f", "1d", "0x1p3", "Infinity", "NaN", "n/a", "", None, "1,5", " 2.5 ", "-3", "+.5", "1e3", "7."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(to_double(F.col("t"))).collect()] == [None] * 9 + [2.5, -3.0, 0.5, 1000.0, 7.0]


def test_vendor_dates(spark):
    texts = ["2024-03-15", "03/15/2024", "3/5/24", "15-Mar-2024", "5-mar-99", "03/15/2024 09:30", "13/45/2024", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    at = lambda *a: dt.datetime(*a)
    assert [r[0] for r in df.select(to_timestamp(F.col("t"))).collect()] == [
        at(2024, 3, 15), at(2024, 3, 15), at(2024, 3, 5), at(2024, 3, 15), at(1999, 3, 5), at(2024, 3, 15, 9, 30), None, None, None]


def test_nan_inside_records(spark):
    df = spark.sql("SELECT named_struct('a', double('NaN'), 'b', array(named_struct('c', double('NaN'), 'd', 1))) AS s, "
                   "map('k', double('NaN')) AS m, CAST(NULL AS struct<x: double>) AS n")
    row = nan_to_null_all(df).first()
    assert row.s.a is None and row.s.b[0].c is None and row.s.b[0].d == 1 and row.m == {"k": None} and row.n is None


def test_clock_texts_of_an_export(spark):
    df = spark.createDataFrame([("9:05:30",), ("14:20",), ("noon",), (None,)], "Time string")
    assert [r[0] for r in prepare_export(df).collect()] == ["09:05", "14:20", "noon", None]


def test_repeated_headers(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3)], "`RY 4.125 2030` int, `A` int, `A.1` int")
    assert without_repeated_headers(df).columns == ["RY 4.125 2030", "A"]
    (tmp_path / "a.csv").write_text("DATE,X,x,Y,X\n1,2,3,4,5\n")
    row = read_by_name(spark, [str(tmp_path / "a.csv")], "csv").drop("source_file").first()
    assert row.asDict() == {"DATE": "1", "X": "2", "Y": "4"}


def test_repeated_security_on_the_latest_date(spark):
    day = dt.date(2024, 1, 2)
    universe = spark.createDataFrame([(day, "Alpha 1", "c2"), (day, "Alpha 1", "c1"), (day, "Beta 2", "c3"),
                                      (dt.date(2024, 1, 1), "Gamma 3", "c4")], "Date date, Security string, CUSIP string")
    wide = spark.createDataFrame([("01/02/2024", 1.0, 2.0)], "DATE string, `Alpha 1` double, `Beta 2` double")
    rows = feeds.build_spread_history(wide, universe).collect()
    assert sorted((r.Security, r.CUSIP, r.GSpread) for r in rows) == [("Alpha 1", "c1", 1.0), ("Beta 2", "c3", 2.0)]


def test_a_feed_is_read_once_and_dates_are_whole(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    write = lambda name, rows: (folder / name).write_text("CUSIP,Security,G Sprd\n" + "".join(f"{r}\n" for r in rows))
    write("API 01.02.24 a.csv", ["c1,s1,1", "c2,s2,5f"])
    write("API 01.02.24 b.csv", ["c3,s3,3"])
    write("API 01.03.24.csv", ["c1,s1,9"])
    paths = feeds.FeedPaths(str(folder), *[str(tmp_path / p) for p in ("table", "state", "log")])
    run = lambda **more: feeds.refresh_universe(spark, paths, now=now(), **more).first()
    assert tuple(run())[1:] == (3, 4, 4)
    assert tuple(run())[1:] == (0, 0, 4)
    write("API 01.02.24 b.csv", ["c3,s3,4", "c4,s4,4"])
    assert tuple(run())[1:] == (1, 4, 5)
    stored = {(str(r.Date), r.CUSIP): r["G Sprd"] for r in spark.read.parquet(paths.table).collect()}
    assert stored == {("2024-01-02", "c1"): 1.0, ("2024-01-02", "c2"): None, ("2024-01-02", "c3"): 4.0,
                      ("2024-01-02", "c4"): 4.0, ("2024-01-03", "c1"): 9.0}
    assert tuple(run(full=True))[1:] == (3, 5, 5)
    assert spark.read.parquet(paths.quality_log).select("table_name").distinct().count() == 1
    assert read_dated_folder(spark, str(folder), "csv").count() == 5


def test_loads_leave_no_scratch_tables(spark, tmp_path):
    import pathlib
    from spreadlab.session import scratch_root
    root = pathlib.Path(scratch_root(spark).removeprefix("file:")) / spark.sparkContext.applicationId
    before = set(root.glob("*")) if root.exists() else set()
    for _ in range(2):
        history.load_universe(days(spark, 5), str(tmp_path / "t"), now=now())
    assert set(root.glob("*")) <= before


def test_a_repeated_attempt_is_logged_once(spark, tmp_path):
    from spreadlab.sinks.tables import track_unmatched
    day = dt.date(2024, 1, 2)
    row = lambda table, at: (table, day, "c", "c", "n", at, "f")
    schema = ("source_table string, date date, cusip_original string, cusip_standardized string, security_name string, "
              "universe_match_attempted_date date, source_file string")
    paths = str(tmp_path / "all"), str(tmp_path / "last")
    for rows in ([row("a", day)], [row("a", day)], [row("b", day)], [row("a", dt.date(2024, 1, 3))]):
        track_unmatched(spark.createDataFrame(rows, schema), *paths)
    assert spark.read.parquet(paths[0]).count() == 3 and spark.read.parquet(paths[1]).count() == 2


def test_bands_settle_like_the_greedy_rule(spark):
    import random

    from spreadlab.functions.similarity import best_score
    from spreadlab.operators.mapping import assign_in_bands
    from spreadlab.params import MappingParams
    rng = random.Random(3)
    left = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(6, 10))) for _ in range(40)})
    right = sorted({w[:k] + rng.choice("abcd") + w[k:] for w in left for k in (2,)} - set(left))
    params = MappingParams(threshold=70.0, bands=(95.0, 85.0))
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    pairs = (frame(left).withColumnRenamed("name", "source").crossJoin(frame(right).withColumnRenamed("name", "target"))
             .withColumn("s", best_score(params.methods)("source", "target")).select("source", "target", "s.score").collect())
    want, used = set(), set()
    for p in sorted(pairs, key=lambda p: (-p.score, p.source, p.target)):
        if p.score >= 70 and not {("s", p.source), ("t", p.target)} & used:
            used |= {("s", p.source), ("t", p.target)}
            want.add(p.score)
    got = assign_in_bands(frame(left), frame(right), params).collect()
    assert len(got) == len({r.source for r in got}) == len({r.target for r in got})
    assert {r.score for r in got} == want


def test_summary_of_the_loads(spark):
    flagged = spark.createDataFrame([("matched", dt.date(2024, 1, 1)), ("unmatched", dt.date(2024, 1, 2))],
                                    "universe_match_status string, Date date")
    unmatched = spark.createDataFrame([("portfolio",)], "source_table string")
    log = spark.createDataFrame([("portfolio", "passed", dt.datetime(2024, 1, 1)), ("portfolio", "failed", dt.datetime(2024, 1, 1))],
                                "table_name string, check_result string, checked_at timestamp")
    rows = history.load_summary(history.match_summary({"portfolio": (flagged, "Date")}), history.quality_dashboard(log),
                                history.row_counts({"portfolio": flagged, "runs": unmatched}), unmatched).collect()
    found = {(r.section, r.table_name, r.metric): r.value for r in rows}
    assert found["match", "portfolio", "match_rate_percent"] == 50 and found["rows", "runs", "n_rows"] == 1
    assert found["unmatched", "portfolio", "unmatched_count"] == 1 and found["quality", "portfolio", "checks_failed"] == 1
