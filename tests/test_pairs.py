"""All-pairs statistics: where series are sent, what memory holds, and sums that cancel."""

from __future__ import annotations

import math
from dataclasses import replace
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from spreadlab.operators import pairs
from spreadlab.operators.pairs import block_statistics, pair_statistics
from spreadlab.params import PairParams
from spreadlab.plans import pair_zscores

SCHEMA = "security string, values array<double>, last_value double, cusip string, grp string"


def expected(rows, same_group=True):
    """Every pair by exact arithmetic, difference by difference as floating numbers."""
    out = {}
    for a in rows:
        for b in rows:
            if a[0] is None or b[0] is None or not a[0] < b[0] or (same_group and (a[4] is None or a[4] != b[4])):
                continue
            diff = [x - y for x, y in zip(a[1], b[1]) if x is not None and y is not None]
            if not diff:
                continue
            exact = [Fraction(d) for d in diff]
            mean = sum(exact) / len(diff)
            std = math.sqrt(sum((d - mean) ** 2 for d in exact) / (len(diff) - 1)) if len(diff) > 1 else None
            last = None if a[2] is None or b[2] is None else a[2] - b[2]
            out[a[0], b[0]] = (len(diff), float(mean), std, min(diff), max(diff), last, sum(d < last for d in diff) if last is not None else 0,
                               sum(d <= last for d in diff) if last is not None else 0, a[3], b[3])
    return out


def found(df):
    got = df.collect()
    out = {(r.security_1, r.security_2): (r.n_common, r["mean"], r["std"], r.min_diff, r.max_diff, r.last_diff, r.below, r.at_or_below,
                                          r.cusip_1, r.cusip_2) for r in got}
    assert len(out) == len(got)
    return out


def assert_same(got, want):
    assert set(got) == set(want)
    for key, row in want.items():
        n, mean, std, *others = got[key]
        assert n == row[0] and others == list(row[3:]), key
        assert mean == pytest.approx(row[1], rel=1e-11, abs=1e-11 * (row[2] or 1)), key
        assert std is None if row[2] is None else std == pytest.approx(row[2], rel=1e-10, abs=1e-14 * (abs(row[3]) + abs(row[4]))), key


def random_series(groups, dates=25, seed=3):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for name, size in groups.items():
        for _ in range(size):
            at += 1
            values = [None if rng.random() < 0.3 else round(float(rng.normal(100, 20)), 1) for _ in range(dates)]
            # some have a single value, some no last one
            values = values[:1] + [None] * (dates - 1) if at % 17 == 0 else values
            rows.append((f"s{at * 7919 % 1000:03}", values, None if at % 13 == 0 else round(float(rng.normal(100, 20)), 1), f"c{at % 5}", name))
    return rows


@pytest.mark.parametrize("blocks", [None, 1, 3, 9])
def test_large_groups_are_split_and_small_ones_bundled(spark, blocks):
    rows = random_series({"big": 45, "middle": 12, "b": 3, "c": 2, "single": 1, None: 4})
    rows += [(None, [1.0] * 25, 1.0, "c", "big"), ("zz", [None] * 25, None, None, "big"), ("zy", [2.0] * 25, 2.0, None, "big")]
    series = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = pair_statistics(series, "security", "values", "last_value", ("cusip",), blocks=blocks, within="grp")
    assert_same(found(got), expected(rows))
    nothing = pair_statistics(series.filter("grp IS NULL"), "security", "values", "last_value", ("cusip",), blocks=blocks, within="grp")
    assert nothing.count() == 0


def test_series_are_copied_to_blocks_of_their_own_group_only(spark):
    """Copies and block pairs once grew with all series, of whatever group; most of a block pair was of no use."""
    series = spark.range(4000).selectExpr("concat('s', id) AS security", "cast(id % 40 AS string) AS _within")
    dealt, cells = pairs._dealt_within(series, "security", 40)
    assert dealt.count() == 4000 and cells <= 80
    assert dealt.filter("_blocks > 0").count() == 0  # 40 groups of a block's size: none is copied
    assert dealt.groupBy("_within").agg({"_own": "min", "_within": "count"}).filter("`count(_within)` <> 100").count() == 0
    dealt, cells = pairs._dealt_within(series, "security", 160)
    assert {r._blocks for r in dealt.select("_blocks").distinct().collect()} == {4}
    assert dealt.select("_split", "_own").distinct().count() == 160
    assert 40 * 10 <= cells <= 160 + 40 * 8


def test_pairs_leave_a_block_pair_in_batches(monkeypatch):
    monkeypatch.setattr(pairs, "_BATCH", 500)
    rng = np.random.default_rng(4)
    rows = pd.DataFrame({"security": [f"s{i:03}" for i in rng.permutation(120)], "values": list(rng.normal(size=(120, 9))),
                         "last_value": rng.normal(size=120), "_own": np.arange(120) % 2, "_one": 0, "_two": 1})
    batches = list(block_statistics(rows, "security", "values", "last_value", (), False))
    assert sum(map(len, batches)) == 60 * 60 and max(map(len, batches)) <= 500 + 60 and len(batches) > 5
    every = pd.concat(batches)
    assert (every.security_1 < every.security_2).all() and not every.duplicated(["security_1", "security_2"]).any()
    most = pd.concat(block_statistics(rows, "security", "values", "last_value", (), False, n=20))
    score = lambda df: ((df.last_diff - df["mean"]) / df["std"]).abs()
    assert sorted(score(most)) == sorted(score(every))[-20:]


def test_sums_that_cancel_are_taken_difference_by_difference(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(0, 1, 60)
    shapes = {
        "equal_1": base, "equal_2": base, "moved": base + 3.0, "parallel": base + rng.normal(0, 1e-7, 60),
        "far_1": 1e9 + rng.normal(0, 1e-3, 60), "far_2": 1e9 + rng.normal(0, 1e-3, 60), "flat_1": np.full(60, 0.1), "flat_2": np.full(60, 0.3),
        "tiny_1": rng.normal(0, 1e-170, 60), "tiny_2": rng.normal(0, 1e-170, 60), "large": rng.normal(0, 1e12, 60), "plain": rng.normal(0, 5, 60)}
    rows = [(name, [None if i % 9 == k % 9 else float(v) for i, v in enumerate(values)], float(values[1]), None, "g")
            for k, (name, values) in enumerate(shapes.items())]
    series = spark.createDataFrame(rows, SCHEMA)
    got = found(pair_statistics(series, "security", "values", "last_value", ("cusip",), blocks=2, within="grp"))
    want = expected(rows)
    # squares of such numbers are below the range of numbers
    assert got.pop(("tiny_1", "tiny_2"))[:2] == pytest.approx(want.pop(("tiny_1", "tiny_2"))[:2], rel=1e-11)
    assert_same(got, want)
    assert got["equal_1", "equal_2"][2] == 0.0


def test_values_without_bounds(spark):
    inf = math.inf
    rows = [("a", [1.0, inf, 3.0, 4.0], 1.0, None, "g"), ("b", [2.0, inf, 5.0, -inf], 2.0, None, "g"), ("c", [3.0, 1.0, 1e200, 2.0], 3.0, None, "g")]
    got = found(pair_statistics(spark.createDataFrame(rows, SCHEMA), "security", "values", "last_value", ("cusip",), blocks=2))
    assert got["a", "b"][0] == 3 and got["a", "b"][3:5] == (-2.0, inf)  # inf - inf is no difference
    assert got["a", "c"][0] == 4 and got["a", "c"][4] == inf
    assert got["a", "c"][6:8] == (1, 2) and got["b", "c"][6:8] == (2, 3)


@pytest.mark.parametrize("group", [None, "grp"])
@pytest.mark.parametrize("flat", [False, True])
def test_many_pairs_are_shuffled_once_to_the_tasks_that_sort_them(spark, monkeypatch, plan, group, flat):
    history = [(day, f"s{i % 40:02d}{'é' if i % 3 else 'z'}", str(i), f"g{i % 3}", 5.0 if flat and i % 5 else float(value))
               for i, values in enumerate(np.random.default_rng(5).normal(100, 9, (40, 6)).round(1)) for day, value in enumerate(values)]
    df = spark.createDataFrame(history, "day int, s string, c string, grp string, v double").selectExpr(
        "date_add(date'2024-01-01', day) AS d", "s", "c", "grp", "v")
    cols = pair_zscores.Panel("d", "s", "c", "v", ("d",), group=group)
    params = replace(PairParams(), max_series=None, min_observations=1, lookback_rows=5, history_days=0, min_coverage=0.0)
    before = pair_zscores.pair_zscores(df, cols, params)
    want = before.collect()
    monkeypatch.setattr(pair_zscores, "MANY_PAIRS", 0)
    monkeypatch.setattr(pairs, "_SAMPLE", 60)
    after = pair_zscores.pair_zscores(df, cols, params)
    assert after.collect() == want and len(want) > 200
    assert after.columns == before.columns
    # all pairs of the series are compared once and shuffled once
    text = plan(after)
    above = text[:text.index("FlatMapGroupsInPandas")]
    assert above.count("Exchange") == 1 and "rangepartitioning" not in text, text


def test_ranges_follow_the_order_of_the_report():
    rng = np.random.default_rng(2)
    rows = pd.DataFrame({"s_1": [f"n{i}" for i in rng.integers(0, 9, 400)], "s_2": [f"n{i}" for i in rng.integers(0, 9, 400)],
                         "std": rng.choice([0.0, 1.0, 2.0, np.nan], 400), "last_diff": rng.choice([1.0, -2.0, np.inf, np.nan, 7.0], 400),
                         "mean": rng.choice([0.0, 1.0, np.inf], 400)})
    ranges = [(-7.0, "n3", "n3"), (-7.0, "n5", "n1"), (-1.0, "n2", "n8"), (-0.0, "n4", "n0"), (-0.0, "n4", "n4")]
    rows["place"] = pairs._places(rows, "s", ranges)
    score = (rows["last_diff"] - rows["mean"]) / rows["std"]
    for at, row in rows.iterrows():
        if not row["std"] > 0:
            key = (1, 0.0)
        elif math.isnan(row["last_diff"]):
            key = (2, 0.0)  # missing in Spark: after all others
        else:
            key = (0, 0.0) if math.isnan(score[at]) else (1, -abs(score[at]))
        assert row["place"] == sum((1, *r) < (*key, row["s_1"], row["s_2"]) for r in ranges)
