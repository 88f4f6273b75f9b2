"""Operators against brute force on small frames, and the shape of their plans."""

from __future__ import annotations

import datetime as dt
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PythonException  # noqa: F401
from pyspark.sql import functions as F

from spreadlab.functions import similarity
from spreadlab.operators import dedup, lookups, mapping, orphans, profiling, quality, reshape, snapshots
from spreadlab.operators.panel import forward_filled, forward_filled_grid, full_grid
from spreadlab.operators.quantiles import exact_quantiles
from spreadlab.operators.quotes import QuoteColumns, best_levels, quotes_with_changes, without_negatives
from spreadlab.params import MappingParams, MonitorParams, PairParams
from spreadlab.plans.pair_zscores import Panel, pair_funnel, pair_zscores


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


# --- one row per key -------------------------------------------------------

QUOTES = [("2024-01-01", "A", "09:00", 1.0, None), ("2024-01-01", "A", "10:00", None, 5.0),
          ("2024-01-01", "B", "09:00", 2.0, 2.0), (None, "B", "09:00", 9.0, 9.0)]
QUOTE_SCHEMA = "d string, k string, t string, x double, y double"


def test_whole_row_and_column_wise_last(spark):
    df = spark.createDataFrame(QUOTES, QUOTE_SCHEMA)
    whole = {(r.d, r.k): (r.x, r.y) for r in dedup.keep_last(df, ["d", "k"], ["t"]).collect()}
    assert whole[("2024-01-01", "A")] == (None, 5.0) and (None, "B") in whole
    mixed = {(r.d, r.k): (r.x, r.y) for r in dedup.last_non_null(df, ["d", "k"], ["t"]).collect()}
    assert mixed == {("2024-01-01", "A"): (1.0, 5.0), ("2024-01-01", "B"): (2.0, 2.0)}
    first = {r.k: r.x for r in dedup.first_non_null(df, ["d", "k"], ["t"]).collect()}
    assert first == {"A": 1.0, "B": 2.0}


def test_ties_do_not_depend_on_input_order(spark):
    rows = [("A", 1, float(i)) for i in range(50)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, t int, v double").repartition(7)
        assert dedup.keep_last(df, ["k"], ["t"]).first().v == 49.0


def test_keep_last_limits_groups_before_the_shuffle(spark, plan):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(dedup.keep_last(df, ["k"], ["id"]))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_unique_lookup_fails_on_repeated_keys(spark):
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    good = spark.createDataFrame([("a", "1"), (None, "9"), (None, "8")], "s string, c string")
    assert sorted((r.s, r.c, r.hit) for r in lookups.many_to_one(df, good, "s", ["c"], "hit").collect()) == [
        ("a", "1", True), ("b", None, False)]
    bad = spark.createDataFrame([("a", "1"), ("a", "2")], "s string, c string")
    with pytest.raises(Exception, match="not unique"):
        lookups.many_to_one(df, bad, "s", ["c"]).collect()


# --- dates -------------------------------------------------------------------

def test_snapshot_filter_prunes_partitions(spark, tmp_path, plan):
    df = spark.createDataFrame([(day(i), i) for i in range(4)], "d date, v int")
    df.write.partitionBy("d").parquet(str(tmp_path / "t"))
    latest = snapshots.latest_snapshot(spark.read.parquet(str(tmp_path / "t")), "d")
    assert [r.v for r in latest.collect()] == [3]
    assert "PartitionFilters: [isnotnull(d" in plan(latest)


def test_as_of_dates_without_history(spark):
    df = spark.createDataFrame([(day(0),), (day(5),)], "d date")
    got = {r.period: r.as_of_date for r in snapshots.reference_dates(df, "d", ("DoD", "WoW", "YTD")).collect()}
    assert got == {"DoD": day(0), "WoW": None, "YTD": None}


# --- panel and pairs -----------------------------------------------------------

def random_history(n_days=60, n_series=7, share=0.8, seed=3):
    rng = random.Random(seed)
    rows, at = [], 0
    for d in range(n_days):
        for s in range(n_series):
            for _ in range(rng.choice([1, 1, 2])):
                if rng.random() < share:
                    at += 1
                    value = None if rng.random() < 0.05 else round(rng.uniform(-50, 50), 2)
                    rows.append((day(d), f"S{s:02d}", f"C{s}{at % 2}", value, at))
    return rows


def pandas_pairs(rows, params):
    """The statistics with a wide matrix, series by series."""
    df = pd.DataFrame(rows, columns=["d", "s", "c", "v", "o"]).dropna(subset=["v"]).sort_values("o")
    m = df.groupby("s").agg(n=("d", "count"), first=("d", "min"), last=("d", "max"))
    latest = df.d.max()
    m = m[(m["first"] <= latest - dt.timedelta(days=params.history_days)) & (m.n >= params.min_observations)
          & (m["last"] >= latest - dt.timedelta(days=params.recency_days))]
    chosen = m.reset_index().sort_values(["n", "s"], ascending=[False, True]).head(params.max_series).s.tolist()
    cells = df[df.s.isin(chosen)].groupby(["d", "s"]).v.last().unstack().ffill(limit=params.fill_limit)
    kept = cells[cells.notna().sum(axis=1) >= params.min_date_coverage * len(chosen)]
    look = kept.tail(params.lookback_rows)
    out = {}
    for a, b in itertools.combinations(sorted(cells.columns), 2):
        if any(kept[x].first_valid_index() is None or kept[x].first_valid_index() > look.index[0] for x in (a, b)):
            continue
        x, y = look[a].dropna(), look[b].dropna()
        diff = (look[a] - look[b]).dropna()
        if not len(diff) or not len(x) or not len(y):
            continue
        last = x.iloc[-1] - y.iloc[-1]
        std = diff.std()
        below, upto = (diff < last).sum(), (diff <= last).sum()
        out[(a, b)] = (last, (last - diff.mean()) / std if std > 0 else 0.0, diff.max(), diff.min(),
                       (below + upto + (upto > below)) * 50.0 / len(diff))
    return out


@pytest.mark.parametrize("seed, share", [(1, 0.9), (2, 0.5), (3, 0.3)])
def test_pair_zscores_against_a_matrix(spark, seed, share):
    rows = random_history(seed=seed, share=share)
    params = PairParams(max_series=6, lookback_rows=25, history_days=20, min_observations=15, fill_limit=2)
    df = spark.createDataFrame(rows, "d date, s string, c string, v double, o int").repartition(5)
    got = pair_zscores(df, Panel("d", "s", "c", "v", ("o",)), params).collect()
    want = pandas_pairs(rows, params)
    assert {(r.Security_1, r.Security_2) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        values = (r.Last_Spread, r.Z_Score, r.Max, r.Min, r.Percentile)
        assert values == pytest.approx(want[(r.Security_1, r.Security_2)], abs=1e-9)
        assert 0 <= r.Percentile <= 100
    scores = [abs(r.Z_Score) for r in got]
    assert scores == sorted(scores, reverse=True)


def test_pair_count_is_complete_and_funnel_adds_up(spark):
    rows = [(day(d), f"S{s:03d}", "c", float((d * 7 + s * s) % 11), d) for d in range(30) for s in range(41)]
    df = spark.createDataFrame(rows, "d date, s string, c string, v double, o int")
    params = PairParams(lookback_rows=20, history_days=10, min_observations=10)
    cols = Panel("d", "s", "c", "v", ("o",))
    pairs = pair_zscores(df, cols, params)
    assert pairs.count() == 41 * 40 // 2 == pairs.select("Security_1", "Security_2").distinct().count()
    funnel = pair_funnel(df, cols, params).first()
    assert funnel.pairs_attempted == 820 == funnel.pairs_kept


def test_pairs_are_compared_in_blocks(spark, plan):
    from spreadlab.operators.pairs import pair_statistics
    series = spark.createDataFrame([(f"s{i}", [1.0 * i, None, 3.0], 1.0) for i in range(9)],
                                   "security string, values array<double>, last_value double")
    df = pair_statistics(series, "security", "values", "last_value", blocks=3)
    text = plan(df)
    assert "FlatMapGroupsInPandas" in text and "inline" not in text and "Join" not in text and text.count("Exchange") == 1
    assert df.count() == 36 and {r.n_common for r in df.collect()} == {2}


def test_top_and_extreme_pairs_are_those_of_all_pairs(spark):
    from spreadlab.operators.pairs import pair_statistics
    rng = np.random.default_rng(8)
    rows = [(f"s{i:03}", [None if rng.random() < 0.3 else float(rng.integers(0, 9)) for _ in range(30)], float(rng.integers(0, 9)), f"g{i % 3}")
            for i in range(70)] + [("alone", [None] * 30, 1.0, "g0"), (None, [1.0], 1.0, "g0"), ("s900", [1.0] * 31, 2.0, None)]
    series = spark.createDataFrame(rows, "security string, values array<double>, last_value double, grp string")

    def pairs(**more):
        got = pair_statistics(series, "security", "values", "last_value", ("grp",), blocks=4, **more).collect()
        return sorted((-abs((r.last_diff - r["mean"]) / r["std"]) if r["std"] else 0.0, r.security_1, r.security_2, r.n_common) for r in got)

    every = pairs()
    assert len(every) == 71 * 70 // 2 and all(a < b for _, a, b, _ in every)
    top = pairs(n=25)
    assert top[:25] == every[:25] and len(top) <= 25 * 10
    assert pairs(above=1.0) == [p for p in every if -p[0] > 1.0]
    inner = [p for p in every if p[1] != "s900" and p[2] != "s900" and int(p[1][1:]) % 3 == int(p[2][1:]) % 3]
    assert pairs(within="grp") == inner


def test_forward_fill_limit_and_edges(spark):
    values = {0: 1.0, 9: 2.0}
    rows = [(day(i), "x", values[i]) for i in values] + [(day(i), "grid", 0.0) for i in range(12)]
    cells = spark.createDataFrame(rows, "d date, s string, v double")
    got = {r.d: (r.v, r.is_filled) for r in forward_filled(cells, "d", "s", "v", 5).filter("s = 'x'").collect()}
    assert sorted(got) == [day(i) for i in (0, 1, 2, 3, 4, 5, 9, 10, 11)]
    assert got[day(5)] == (1.0, True) and got[day(9)] == (2.0, False)
    grid = forward_filled_grid(cells, "d", "s", "v", 5)
    assert grid.count() == 24 and grid.filter("v is null").count() == 3
    assert full_grid(cells, "d", "s", "v").filter("v is null").count() == 10


# --- quotes ------------------------------------------------------------------------

COLS = QuoteColumns("d", "c", "k", ("o",), "b", "a", "bs", "as_")


def test_period_changes_and_best_levels(spark):
    rows = [  # date, cusip, dealer, order, bid, ask, bid size, ask size
        (day(40), "A", "x", 1, 10.0, 9.0, 30.0, 30.0), (day(40), "A", "x", 2, 12.0, None, 30.0, None),
        (day(40), "A", "y", 1, 12.0, 7.0, 50.0, 5.0), (day(40), "B", "x", 1, None, 4.0, 99.0, 99.0),
        (day(39), "A", "x", 1, 5.0, 5.0, 10.0, 10.0), (day(32), "A", "y", 1, 1.0, 1.0, 1.0, 1.0),
        (day(20), "A", "y", 1, 2.0, 2.0, 2.0, 2.0), (day(39), "Z", "x", 1, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "d date, c string, k string, o int, b double, a double, bs double, as_ double")
    params = MonitorParams(min_size=20)
    now = quotes_with_changes(df, COLS, params)
    got = {(r.c, r.k): r.asDict() for r in now.collect()}
    assert set(got) == {("A", "x"), ("A", "y"), ("B", "x")}
    assert got[("A", "x")]["b"] == 12.0 and got[("A", "x")]["a"] == 9.0  # column-wise last
    assert got[("A", "x")]["DoD"] == 7.0 and got[("A", "x")]["DoD Chg Bid Size"] == 20.0
    assert got[("A", "y")]["DoD"] is None and got[("A", "y")]["WoW"] == 11.0 and got[("A", "y")]["MTD"] == 10.0
    assert got[("A", "x")]["1YR"] is None
    best = {r.c: r.asDict() for r in best_levels(now, COLS, params).collect()}
    assert (best["A"]["Best Bid"], best["A"]["Dealer @ Best Bid"], best["A"]["Size @ Best Bid"]) == (12.0, "y", 50.0)
    assert (best["A"]["Best Offer"], best["A"]["Bid/Offer"]) == (9.0, 3.0)
    assert best["B"]["Best Bid"] is None and best["B"]["Bid/Offer"] is None and best["B"]["Best Offer"] == 4.0


def test_monitor_reads_only_the_needed_dates(spark, tmp_path, plan):
    rows = [(day(i), "A", "x", 1, float(i), 1.0, 30.0, 30.0) for i in range(50)]
    spark.createDataFrame(rows, "d date, c string, k string, o int, b double, a double, bs double, as_ double").write.partitionBy(
        "d").parquet(str(tmp_path / "q"))
    df = quotes_with_changes(spark.read.parquet(str(tmp_path / "q")), COLS, MonitorParams())
    row = df.first()
    assert row["DoD"] == 1.0 and row["WoW"] == 7.0
    files = [m for m in plan(df).splitlines() if "PartitionFilters" in m and "bs#" in m]
    assert files and "Subquery" in files[0]


def test_negative_filters(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,), (0.0,)], "p double")
    assert without_negatives(df, ["p", "absent"], True).count() == 3
    assert without_negatives(df, ["p"], False).count() == 2


# --- quantiles and profiles -----------------------------------------------------------

@pytest.mark.parametrize("partitions", [1, 5, 16])
def test_exact_quantiles_with_a_dominant_group_and_value(spark, partitions):
    rng = np.random.default_rng(5)
    groups = {"hot": np.concatenate([np.full(700, 3.25), rng.normal(size=1500)]), "one": np.array([4.5]),
              "few": np.array([1.0, 2.0, 2.0, 5.0])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        probs = {"lo": 0.0, "q1": 0.25, "m": 0.5, "q9": 0.93, "hi": 1.0}
        got = {r.g: r.asDict() for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert set(got) == {"hot", "one", "few"}
    for g, vs in groups.items():
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(vs, p), abs=1e-12)


def test_describe_ignores_text_and_nan(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("NaN",), ("3",)], "v string")
    row = profiling.describe(df, ["v"]).first()
    assert (row.n, row["mean"], row.q50, row["min"], row["max"]) == (2, 2.0, 2.0, 1.0, 3.0)
    assert row["std"] == pytest.approx(math.sqrt(2))


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "a int, Date date")
    assert profiling.duplicate_rows(df).first().duplicate_rows == 0
    assert profiling.overall_missing(df).first().passed is True
    assert quality.reference_contract(df, "a", []).first().violation == "empty_table"
    assert profiling.date_coverage(df, "Date").first().unique_dates == 0


def test_resample_of_the_whole_table(spark):
    rows = [(dt.date(2024, 1, 30), "a", 1.0), (dt.date(2024, 1, 31), "b", None), (dt.date(2024, 2, 1), "a", 3.0)]
    df = spark.createDataFrame(rows, "d date, s string, v double")
    got = {m: [(str(r.month_end), r.v) for r in profiling.monthly(df, "d", "v", m).orderBy("month_end").collect()]
           for m in ("last", "first", "mean", "median")}
    assert all(v == [("2024-01-31", 1.0), ("2024-02-29", 3.0)] for v in got.values())
    with pytest.raises(ValueError):
        profiling.monthly(df, "d", "v", "max")


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, "x", -1.0), (1, "x", -1.0), (2, "7", None)], "k int, t string, p double")
    report = quality.quality_report(df, ["p"], None, None, F.current_date())
    by_check = {(r.check_type, r.column_name): (r.check_value, r.check_result) for r in report.collect()}
    assert by_check[("duplicate_rows", None)] == (1.0, "warning")
    assert by_check[("negative_values", "p")] == (2.0, "failed")
    assert quality.validation_passed(report).first().validation_passed is False
    bad = quality.non_numeric_rows(df, ["t"], ["k"]).collect()
    assert [(r.k, r.value) for r in bad] == [(1, "x"), (1, "x")]
    with pytest.raises(ValueError):
        quality.assert_columns(df, ["k", "zzz"])


# --- reconciliation, reshaping -----------------------------------------------------------

def test_orphans_over_several_identifier_columns(spark):
    universe = spark.createDataFrame([("U1", day(1)), ("U2", day(2)), (None, day(2))], "CUSIP string, Date date")
    pairs = spark.createDataFrame([("U1", "X", "n1", "n2"), ("X", "Y", "n3", None)],
                                  "CUSIP_1 string, CUSIP_2 string, Security_1 string, Security_2 string")
    got = {(r.cusip, r.security_name, r.instances) for r in orphans.orphans({"pairs": pairs}, universe).collect()}
    assert got == {("X", "n2", 2), ("Y", "Unknown", 1)}
    totals = orphans.orphan_totals(orphans.orphans({"p": pairs}, universe), {"p": pairs}, universe).first()
    assert (totals.total_orphaned_instances, totals.unique_orphaned_cusips, totals.universe_cusips) == (3, 2, 2)
    runs = spark.createDataFrame([("U1", day(5)), ("U2", day(4))], "CUSIP string, Date date")
    latest = orphans.latest_orphans({"runs": (runs, "Date")}, universe, "Date").collect()
    assert [r.cusip for r in latest] == ["U1"]


def test_duplicate_columns_after_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert reshape.rename_positions(df, {"b": "a"}).first().asDict() == {"a": 1, "c": 3}
    assert reshape.rename_positions(df, {"b": "a"}, "drop_all").columns == ["c"]
    with pytest.raises(ValueError):
        reshape.rename_positions(df, {"b": "a"}, "fail")


# --- name mapping ----------------------------------------------------------------------------

def vendor_names(n, seed):
    rng = random.Random(seed)
    issuers = ["BELL CANADA", "TD", "RY", "ENBRIDGE INC", "HYDRO ONE", "BMO", "CN", "Q"]
    names = sorted({f"{rng.choice(issuers)} {rng.choice(['2', '3 1/4', '4.5'])} {rng.randint(1, 12):02d}/{rng.randint(1, 28)}/"
                    f"{rng.choice(['25', '2030', '31'])}" for _ in range(n)})

    def spoil(name):
        text = list(name)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(text))
            text[i:i + 1] = rng.choice([[], [text[i], rng.choice("X1 ")], [rng.choice("AB9/")]])
        name = "".join(text)
        return " ".join(reversed(name.split())) if rng.random() < 0.2 else name

    return names, sorted({spoil(x) for x in names} | {"Q", "RY", "TD", ""})


@pytest.mark.parametrize("threshold", [85.0, 70.0])
def test_no_candidate_is_lost(spark, threshold):
    a, b = vendor_names(45, 11)
    a += ["Q", "QX", "T"]
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    params = MappingParams(threshold=threshold)
    got = {(r.source, r.target): (round(r.score, 9), r.method) for r in mapping.scored_pairs(frame(a), frame(b), params).collect()}
    want = {}
    for x, y in itertools.product(set(a), set(b)):
        if not x or not y:
            continue
        best, by = 0.0, None
        for m in params.methods:
            score = similarity.SCORERS[m](x, y)
            if score > best:
                best, by = score, m
        if best >= threshold:
            want[(x, y)] = (round(best, 9), by)
    assert got == want


def test_mapping_is_one_to_one_and_greedy(spark):
    a, b = vendor_names(40, 7)
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    result = mapping.map_names(frame(a), frame(b)).collect()
    assert sorted(r.source for r in result) == sorted(a)
    used = [r.target for r in result if r.target is not None]
    assert len(used) == len(set(used))
    assert {r.source for r in result if r.kind == "exact"} == set(a) & set(b)
    left, right, best = set(a) - set(b), set(b) - set(a), {}
    scored = sorted(((-max(similarity.SCORERS[m](x, y) for m in MappingParams().methods), x, y)
                     for x in left for y in right if y), key=lambda p: (p[0], p[1], p[2]))
    for score, x, y in scored:
        if -score >= 85 and x in left and y in right:
            best[x] = y
            left.discard(x), right.discard(y)
    assert {r.source: r.target for r in result if r.kind == "fuzzy"} == best


def test_orphans_are_collapsed_before_the_universe_is_joined(spark):
    """Not the table's rows but its distinct identifiers meet the universe; a missing date stays."""
    pairs = spark.createDataFrame([("A", "a", "X", "x"), ("A", "a", None, "n"), ("B", None, "", "e"), ("B", None, "X", "y")],
                                  "CUSIP_1 string, Security_1 string, CUSIP_2 string, Security_2 string")
    # of known size, as a file's: Spark moves joins with small tables
    universe = spark.sql("SELECT * FROM VALUES ('A', 1), ('A', 1), (NULL, 1) AS u(CUSIP, d)")
    found = orphans.pair_orphans(pairs, universe, "CUSIP", {"CUSIP_1": "Security_1", "CUSIP_2": "Security_2"})
    counted = orphans.orphans({"pairs": pairs}, universe)
    dated = orphans.dated_orphans(spark.createDataFrame([("A", 1), ("A", 2), ("A", None), (None, 1), ("B", 1), ("B", 1)], "c string, day int"),
                                  universe, "c", "day", "CUSIP", "d")
    for df in (found, counted, dated):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert text.index("Join") < text.index("Aggregate"), text
    assert {tuple(r) for r in found.collect()} == {("B", None), ("X", "x"), ("X", "y")}
    assert {(r.cusip, r.security_name, r.instances) for r in counted.collect()} == {("B", "Unknown", 2), ("X", "x", 2), ("", "e", 1)}
    assert sorted((r.c, str(r.day), r.instances) for r in dated.collect()) == [("A", "2", 1), ("A", "None", 1), ("B", "1", 2)]
