"""Exact quantiles by bracketing against numpy, whatever the sketch says."""

from __future__ import annotations

import math

import numpy as np
import pytest

from spreadlab.operators import profiling, quantiles
from spreadlab.operators.quantiles import column_quantiles, exact_quantiles

FIVE = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def want(values):
    return [float(np.quantile(values, p)) for p in FIVE.values()]


def got(row):
    return [row[name] for name in FIVE]


@pytest.fixture
def many(spark):
    """A column of distinct values, one of few values, one constant, one with NULL, one without values."""
    return spark.range(60_000).selectExpr(
        "id * 1.25 + (id * 7919 % 1000) / 7 AS a", "id % 3 AS b", "5 AS c", "CASE WHEN id % 10 = 0 THEN -id END AS d",
        "CAST(NULL AS double) AS e", "CASE WHEN id < 3 THEN id END AS f")


def test_columns_share_passes_and_are_exact(many):
    found = {r["column_name"]: got(r) for r in column_quantiles(many, list("abcdef"), FIVE).collect()}
    data = many.toPandas()
    assert set(found) == set("abcdf")
    for c in found:
        assert found[c] == pytest.approx(want(data[c].dropna().astype(float)), rel=1e-12), c


def test_few_values_are_ranked(many, monkeypatch):
    """Only what lies inside open brackets is grouped by value and shuffled."""
    seen, plain = [], quantiles.values_at
    monkeypatch.setattr(quantiles, "values_at", lambda kept, *a: seen.append(kept.count()) or plain(kept, *a))
    column_quantiles(many, ["a", "b", "c"], FIVE)
    assert sum(seen) < 0.01 * 60_000


def test_a_wrong_sketch_does_not_matter(many, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(quantiles, "cuts", lambda value, p, accuracy=0: F.array(*[F.lit(1.0 + i) for i in range(2 * len(p))]))
    data = many.toPandas()
    for r in column_quantiles(many, ["a", "d"], FIVE).collect():
        assert got(r) == pytest.approx(want(data[r["column_name"]].dropna().astype(float)), rel=1e-12)
    rows = exact_quantiles(many.selectExpr("b", "a"), ["b"], "a", FIVE, group_rows=100).collect()
    for r in rows:
        assert got(r) == pytest.approx(want(data[data["b"] == r["b"]]["a"].astype(float)), rel=1e-12)


@pytest.mark.parametrize("group_rows", [1, 50, 10_000, 1_000_000])
def test_groups_of_any_size(spark, group_rows):
    df = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3000 = 1 THEN NULL ELSE concat('g', id % 40) END AS `a b`",
        "id % 2 AS k", "CASE WHEN id % 11 > 0 THEN (id * 37 % 1009) / 8 END AS v")
    data = df.toPandas().dropna(subset=["v"])
    rows = exact_quantiles(df, ["a b", "k"], "v", FIVE, group_rows=group_rows).collect()
    groups = {(None if not isinstance(a, str) else a, k): g["v"].astype(float) for (a, k), g in data.groupby(["a b", "k"], dropna=False)}
    assert {(r["a b"], r["k"]) for r in rows} == set(groups) and len(rows) == len(groups)
    for r in rows:
        assert got(r) == pytest.approx(want(groups[r["a b"], r["k"]]), rel=1e-12)


def test_not_a_number_is_the_greatest(spark):
    df = spark.createDataFrame([("x", float(v)) for v in (3, 1, 2)] + [("x", math.nan)] * 2, "k string, v double")
    for r in (column_quantiles(df, ["v"], FIVE).first(), exact_quantiles(df, ["k"], "v", FIVE, group_rows=2).first()):
        assert r["min"] == 1 and r["q1"] == 2 and r["median"] == 3 and math.isnan(r["q3"]) and math.isnan(r["max"])


def test_no_rows(spark):
    none = spark.createDataFrame([], "k string, v double")
    assert column_quantiles(none, ["v"], FIVE).count() == 0
    assert exact_quantiles(none, ["k"], "v", FIVE).count() == 0
    assert [tuple(r) for r in profiling.describe(none, ["v"]).select("column_name", "n", "q50").collect()] == [("v", 0, None)]


def test_describe_reads_texts_once(spark):
    """The passes over the numbers read them as numbers: no pass parses a text again."""
    df = spark.range(2_000).selectExpr("id", "CASE WHEN id % 5 = 0 THEN 'n/a' ELSE CAST(id / 8 AS string) END AS text")
    found = profiling.describe(df, ["id", "text"])
    assert "rlike" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    rows = {r["column_name"]: r for r in found.collect()}
    numbers = [k / 8 for k in range(2_000) if k % 5]
    assert rows["text"]["n"] == 1_600 and [rows["text"][q] for q in ("q25", "q50", "q75")] == pytest.approx(list(np.quantile(numbers, [0.25, 0.5, 0.75])))
    assert [rows["id"][q] for q in ("q25", "q50", "q75")] == [499.75, 999.5, 1499.25]
