"""Queries for the identifier functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from spreadlab.catalog import query, rounded
from spreadlab.functions import identifiers as ids

_LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digit_sql(c):
    """Check digit of the first eight characters of an SQL text."""
    value = f"((strpos('{_LETTERS}', substr({c}, CAST(i AS INT), 1)) - 1) * CASE WHEN i % 2 = 0 THEN 2 ELSE 1 END)"
    return (f"CAST((10 - list_sum(list_transform(range(1, 9), lambda i: {value} // 10 + {value} % 10)) % 10) % 10 AS INT)")


# the rules once more, as SQL over the view's texts
_RULES = f"""
  WITH texts AS (SELECT row_id, coalesce(upper(trim(cusip)), '') AS x FROM identifiers),
  kinds AS (SELECT *, CASE x WHEN '123' THEN '123000002' WHEN '789' THEN '789000007' END AS special,
      CASE WHEN regexp_matches(x, '^[0-9A-Z]{{9}}$') THEN 'standard_9' WHEN regexp_matches(x, '^[0-9A-Z]{{8}}$') THEN 'standard_8'
           WHEN regexp_matches(x, '^[0-9A-Z]{{6}}$') THEN 'standard_6' WHEN regexp_matches(x, '^[0-9]{{3}}$') THEN 'cdx'
           WHEN regexp_matches(x, '^CASH\\s*[A-Z]{{3}}$') THEN 'cash' END AS kind,
      CASE WHEN length(x) IN (8, 9) THEN CAST({_digit_sql('x')} AS VARCHAR) END AS digit FROM texts),
  rules AS (SELECT *, coalesce(kind = 'standard_9' AND right(x, 1) <> digit, FALSE) AS bad FROM kinds),
  done AS (SELECT row_id, x, special, kind, bad,
      CASE WHEN x = '' THEN '' WHEN special IS NOT NULL THEN special WHEN bad THEN x WHEN kind = 'standard_8' THEN x || digit
           WHEN kind IN ('standard_6', 'cdx') THEN rpad(x, 9, '0') WHEN kind = 'cash' THEN replace(x, ' ', '') ELSE x END AS std,
      CASE WHEN x = '' THEN 'invalid' WHEN special IS NOT NULL THEN 'mapped' WHEN kind IS NULL OR bad THEN 'invalid'
           ELSE 'standardized' END AS status,
      CASE WHEN x = '' THEN 'Empty or null CUSIP' WHEN special IS NOT NULL THEN 'Special mapping applied'
           WHEN kind IS NULL THEN 'No pattern match' WHEN bad THEN 'Check digit validation failed'
           ELSE 'Pattern: ' || kind END AS message FROM rules)
"""


@query("cus_01_standardize", "identifiers", _RULES + """
    SELECT row_id, x AS cusip_original, std AS cusip_standardized, status AS standardization_status,
           message AS standardization_message FROM done""")
def _(t):
    return ids.standardized_columns(t.identifiers, "cusip").drop("cusip")


@query("cus_02_standardize_column", "identifiers", _RULES + """
    SELECT i.cusip, d.x AS cusip_original, d.std AS cusip_standardized, d.status AS standardization_status,
           d.message AS standardization_message, count(*) AS n
    FROM done d JOIN identifiers i USING (row_id) GROUP BY ALL""")
def _(t):
    batch = ids.standardized_columns(t.identifiers, "cusip").drop("row_id")
    return batch.groupBy(*batch.columns).agg(F.count(F.lit(1)).alias("n"))


@query("cus_03_check_digit", "identifiers", f"""
    WITH texts AS (SELECT row_id, coalesce(nullif(upper(trim(cusip)), 'NAN'), '') AS x FROM identifiers),
    plain AS (SELECT *, regexp_matches(x, '^[0-9A-Z]+$') AS fits, CASE WHEN regexp_matches(x, '^[0-9A-Z]+$') THEN rpad(x, 9, '0') ELSE '000000000' END AS y FROM texts)
    SELECT row_id, CASE WHEN fits AND length(x) = 8 THEN x || CAST({_digit_sql('y')} AS VARCHAR) ELSE x END AS completed,
           fits AND length(x) = 9 AND right(x, 1) = CAST({_digit_sql('y')} AS VARCHAR) AS is_valid FROM plain""")
def _(t):
    x = ids.normalized(F.col("cusip"))
    return t.identifiers.withColumn("x", x).select(
        "row_id", ids.with_check_digit(F.col("x")).alias("completed"),
        ids.has_valid_check_digit(F.col("x")).alias("is_valid"))


@query("cus_04_validate", "identifiers", _RULES + """
    SELECT row_id, x AS cusip, x <> '' AND (special IS NOT NULL OR (kind IS NOT NULL AND NOT bad)) AS is_valid,
           CASE WHEN special IS NOT NULL THEN 'special_mapping' ELSE kind END AS cusip_type,
           CASE WHEN x = '' THEN 'Empty or null CUSIP' WHEN special IS NOT NULL THEN 'Special CUSIP mapping'
                WHEN kind IS NULL THEN 'No pattern match' WHEN bad THEN 'Check digit validation failed'
                ELSE 'Valid ' || kind || ' CUSIP' END AS validation_message FROM done""")
def _(t):
    return ids.validated_columns(t.identifiers, "cusip")


@query("cus_05_column_statistics", "identifiers", _RULES + """
    , typed AS (SELECT CASE WHEN x = '' THEN 'empty' WHEN special IS NOT NULL THEN 'special_mapping'
                            ELSE coalesce(kind, 'unknown') END AS cusip_type, status,
                       x <> '' AND special IS NULL AND kind IS NOT NULL AND NOT bad AS valid FROM done),
    totals AS (SELECT count(*) AS total_cusips, count(*) FILTER (valid) AS valid_cusips,
                      count(*) FILTER (NOT valid AND cusip_type <> 'special_mapping') AS invalid_cusips,
                      count(*) FILTER (status <> 'invalid') AS standardized_cusips FROM typed)
    SELECT cusip_type, count(*) AS type_count, any_value(total_cusips) AS total_cusips, any_value(valid_cusips) AS valid_cusips,
           any_value(invalid_cusips) AS invalid_cusips, any_value(standardized_cusips) AS standardized_cusips,
           round(any_value(valid_cusips) * 100.0 / any_value(total_cusips) + 1.37e-9, 6) AS validation_rate,
           round(any_value(standardized_cusips) * 100.0 / any_value(total_cusips) + 1.37e-9, 6) AS standardization_rate
    FROM typed, totals GROUP BY 1""")
def _(t):
    summary = ids.identifier_summary(t.identifiers, "cusip").select(F.struct("*").alias("s")).scalar()
    by_type = ids.identifier_statistics(t.identifiers, "cusip").select("cusip_type", "type_count")
    return by_type.withColumn("s", summary).select("cusip_type", "type_count", "s.*").withColumns(
        {"validation_rate": rounded("validation_rate"), "standardization_rate": rounded("standardization_rate")})


@query("cus_06_special_identifiers", "identifiers", """
    SELECT x AS cusip, CASE x WHEN '123' THEN '123000002' ELSE 'X45000001' END AS mapped_to, count(*) AS n
    FROM (SELECT upper(trim(cusip)) AS x FROM identifiers) WHERE x IN ('123', '045') GROUP BY 1, 2""")
def _(t):
    special = ids.SpecialIdentifiers().added("045", "X45000001").removed("789").removed("no such")
    return ids.special_table(t.identifiers, "cusip", special)


@query("cus_07_fallback_to_original", "identifiers", """
    SELECT row_id, coalesce(nullif(trim(CASE WHEN length(trim(cusip)) > 8 THEN '  ' ELSE upper(trim(cusip)) END), ''), cusip) AS cusip
    FROM identifiers""")
def _(t):
    standardized = F.when(F.length(F.trim("cusip")) > 8, "  ").otherwise(F.upper(F.trim("cusip")))
    return t.identifiers.select("row_id", ids.standardized_or_original(standardized, F.col("cusip")).alias("cusip"))
