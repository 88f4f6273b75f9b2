"""Column functions on small frames: NULLs, edges and the identifier cases."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spreadlab.functions import dates, identifiers, predicates, scalars, similarity
from spreadlab.params import ISSUE_AGE_BINS, MATURITY_BINS, PORTFOLIO_OVERRIDES, OutlierRule

CASES = [
    # text, original, standardized, status, message
    ("", "", "", "invalid", "Empty or null CUSIP"),
    (None, "", "", "invalid", "Empty or null CUSIP"),
    ("nan", "", "", "invalid", "Empty or null CUSIP"),
    ("123", "123", "123000002", "mapped", "Special mapping applied"),
    ("789", "789", "789000007", "mapped", "Special mapping applied"),
    ("912810TM0", "912810TM0", "912810TM0", "standardized", "Pattern: standard_9"),
    ("  912810TM0  ", "912810TM0", "912810TM0", "standardized", "Pattern: standard_9"),
    ("912810tm0", "912810TM0", "912810TM0", "standardized", "Pattern: standard_9"),
    ("912810TM", "912810TM", "912810TM0", "standardized", "Pattern: standard_8"),
    ("912810", "912810", "912810000", "standardized", "Pattern: standard_6"),
    ("456", "456", "456000000", "standardized", "Pattern: cdx"),
    ("CASH USD", "CASH USD", "CASHUSD", "standardized", "Pattern: cash"),
    ("INVALID!@#", "INVALID!@#", "INVALID!@#", "invalid", "No pattern match"),
    ("912810TM1", "912810TM1", "912810TM1", "invalid", "Check digit validation failed"),
]


def texts(spark, values, name="CUSIP"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def test_standardize_cases(spark):
    rows = identifiers.standardized_columns(texts(spark, [c[0] for c in CASES])).orderBy("i").collect()
    assert [tuple(r)[2:] for r in rows] == [c[1:] for c in CASES]


def test_check_digit_can_be_off(spark):
    row = identifiers.standardized_columns(texts(spark, ["912810TM1"]), verify_check_digit=False).first()
    assert (row.standardization_status, row.standardization_message) == ("standardized", "Pattern: standard_9")


def test_validate(spark):
    rows = identifiers.validated_columns(texts(spark, ["912810TM0", "INVALID!@#", "123", "912810TM1"])).orderBy("i").collect()
    assert [(r.is_valid, r.cusip_type) for r in rows] == [
        (True, "standard_9"), (False, None), (True, "special_mapping"), (False, "standard_9")]
    assert rows[2].validation_message == "Special CUSIP mapping"


def test_check_digit_lengths(spark):
    c = F.col("CUSIP")
    rows = texts(spark, ["912810TM", "912810", "912810TM0", "12300000", "78900000"]).select(
        identifiers.with_check_digit(c).alias("full"), identifiers.has_valid_check_digit(c).alias("ok")).collect()
    assert [tuple(r) for r in rows] == [("912810TM0", False), ("912810", False), ("912810TM0", True),
                                        ("123000002", False), ("789000007", False)]


def test_statistics(spark):
    df = texts(spark, ["912810TM0", "123", "456", "INVALID!@#", ""])
    row = identifiers.identifier_summary(df).first().asDict()
    assert row == {"total_cusips": 5, "valid_cusips": 2, "invalid_cusips": 2, "standardized_cusips": 3,
                   "validation_rate": 40.0, "standardization_rate": 60.0}
    kinds = {r.cusip_type for r in identifiers.identifier_statistics(df).collect()}
    assert kinds == {"standard_9", "special_mapping", "cdx", "unknown", "empty"}


def test_statistics_of_nothing(spark):
    row = identifiers.identifier_summary(texts(spark, ["x"]).filter("i < 0")).first()
    assert tuple(row) == (0, 0, 0, 0, 0.0, 0.0)


def test_special_identifiers_are_editable():
    base = identifiers.SpecialIdentifiers()
    assert base.added("TEST", "TEST000001").entries["TEST"] == "TEST000001"
    assert "TEST" not in base.entries and "123" not in base.removed("123").entries
    assert base.removed("NONE").entries == base.entries and base.cleared().entries == {}


NULL_ROWS = [(1, 5.0, "abc"), (2, None, None), (3, -7.0, "xbc")]


@pytest.mark.parametrize("condition, kept", [
    (("v", "==", 5.0), [1]), (("v", "!=", 5.0), [2, 3]), (("v", "in", [5.0]), [1]), (("v", "not_in", [5.0]), [2, 3]),
    (("s", "contains", "bc"), [1, 3]), (("s", "startswith", "ab"), [1]), (("v", ">", 0.0), [1]), (("v", "<", 0.0), [3]),
    (("v", ">=", 5.0), [1]), (("v", "<=", -7.0), [3]), (("v", "between", -7.0, 5.0), [1, 3]),
    (("v", "not_between", 0.0, 9.0), [3]), (("v", "abs_>", 6.0), [3]), (("v", "abs_<", 6.0), [1]),
    (("v", "is_null"), [2]), (("v", "not_null"), [1, 3]), (("s", "pair_equal", "s2"), [1]),
    (("s", "pair_not_equal", "s2"), [3]),
])
def test_predicates_on_null(spark, condition, kept):
    df = spark.createDataFrame(NULL_ROWS, "i int, v double, s string").withColumn(
        "s2", F.when(F.col("i") != 3, F.col("s")))
    assert sorted(r.i for r in predicates.matching(df, condition).collect()) == kept
    negated = df.filter(~predicates.predicate(*condition))
    assert sorted(r.i for r in negated.collect()) == sorted({1, 2, 3} - set(kept))


def test_unknown_operator():
    with pytest.raises(ValueError):
        predicates.predicate("v", "like", "x")


def test_buckets(spark):
    values = [None, -0.1, 0.0, 0.2499, 0.25, 1.0, 2.0, 7.0, 100.0, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [tuple(r) for r in df.select(scalars.bucket_label(F.col("v"), ISSUE_AGE_BINS),
                                       scalars.bucket_order(F.col("v"), ISSUE_AGE_BINS)).collect()]
    assert got == [(None, None), (None, None), ("0-0.25", 0), ("0-0.25", 0), ("0.25-0.50", 1), ("1-2", 3), ("2-3", 4),
                   (">7", 7), (">7", 7), (">7", 7)]
    assert len(MATURITY_BINS.labels) == 11


def test_outliers(spark):
    df = spark.createDataFrame([(v,) for v in (None, 10001.0, -10001.0, 10000.0, 5000.0, -1001.0, 12.5)], "v double")
    got = [r[0] for r in df.select(scalars.clamp_outliers(F.col("v"), OutlierRule())).collect()]
    assert got == [None, None, None, 1000.0, 1000.0, -1000.0, 12.5]


def test_numbers_and_fractions(spark):
    df = texts(spark, ["1.5", "n/a", None, "NaN", "5 ⅛ ½ ¾"], "s")
    rows = df.select(scalars.to_double(F.col("s")).alias("n"), scalars.plain_fractions(F.col("s")).alias("t")).collect()
    assert [r.n for r in rows] == [1.5, None, None, None, None]
    assert rows[4].t == "5 1/8 1/2 3/4"


def test_overrides_keep_null_names(spark):
    df = spark.createDataFrame([("BOND", None, "1"), ("CDX", "x", "2"), ("BOND", "CASH USD", None)],
                               "`SECURITY TYPE` string, SECURITY string, CUSIP string")
    got = [tuple(r) for r in scalars.apply_overrides(df, PORTFOLIO_OVERRIDES).collect()]
    assert got == [("BOND", None, "1"), ("CDX", "CDX", "460"), ("BOND", "CASH USD", "789")]


def test_two_digit_years(spark):
    df = texts(spark, ["API 01.02.25.xlsx", "API 12.31.69", "API 02.30.24", "no date", None, "x 06.15.49", "x 06.15.50"], "s")
    got = [tuple(r) for r in df.select(dates.century_date(F.col("s"), 69), dates.century_date(F.col("s"), 50)).collect()]
    d = dt.date
    assert got == [(d(2025, 1, 2), d(2025, 1, 2)), (d(1969, 12, 31), d(1969, 12, 31)), (None, None), (None, None),
                   (None, None), (d(2049, 6, 15), d(2049, 6, 15)), (d(2050, 6, 15), d(1950, 6, 15))]


def test_first_fitting_format_is_used_for_all(spark):
    df = texts(spark, ["2024-01-05", "01/06/2024", "bad", None], "s")
    got = [r.s for r in dates.parse_with_first_fitting(df, "s", ["MM/dd/yy", "yyyy-MM-dd", "MM/dd/yyyy"]).orderBy("i").collect()]
    assert got == [dt.date(2024, 1, 5), None, None, None]
    none = dates.parse_with_first_fitting(texts(spark, ["bad"], "s"), "s", ["MM/dd/yy", "yyyy-MM-dd"])
    assert none.first().s is None


def test_clock(spark):
    df = texts(spark, ["09:30", " 9:5 ", "23:59:59", "24:00", "9.30", None], "s")
    assert [r[0] for r in df.select(dates.clock_text(F.col("s"))).collect()] == ["09:30", "09:05", "23:59", None, None, None]


def test_reference_dates_of_leap_day(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    got = df.select(*[dates.reference_date(F.col("d"), p) for p in ("DoD", "WoW", "MTD", "QTD", "YTD", "1YR")]).first()
    assert [str(x) for x in got] == ["2024-02-28", "2024-02-22", "2024-01-31", "2023-12-31", "2023-12-31", "2023-02-28"]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc 1", max_size=80), st.text("abc 1", max_size=80))
def test_subsequence_against_dynamic_programming(a, b):
    assert similarity.common_subsequence(a, b) == _lcs(a, b)


def test_scores():
    assert similarity.ratio("abcd", "abcd") == 100.0
    assert similarity.ratio("abcd", "abxd") == 75.0
    assert similarity.partial_ratio("bond", "long bond name") == 100.0
    assert similarity.token_sort_ratio("ring small", "small ring") == 100.0
    assert similarity.partial_ratio("abcd", "xxabzz") == 50.0  # windows inside keep their length
    assert similarity.partial_ratio("abcd", "cdzzzz") == pytest.approx(200 * 2 / 6)
