"""Security identifier rules: patterns, check digit, standardization.

All rules are column expressions, so a column of any length is standardized
inside the scan stage without Python workers.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spreadlab.functions.scalars import quoted

# Special identifiers with their full form.
DEFAULT_SPECIAL = {"123": "123000002", "789": "789000007"}

# Shapes of an identifier, tried in this order.
PATTERNS = {
    "standard_9": r"^[0-9A-Z]{9}$",
    "standard_8": r"^[0-9A-Z]{8}$",
    "standard_6": r"^[0-9A-Z]{6}$",
    "cdx": r"^[0-9]{3}$",
    "cash": r"^CASH\s*[A-Z]{3}$",
}

EMPTY_MESSAGE = "Empty or null CUSIP"


class SpecialIdentifiers:
    """Editable map of special identifiers; an immutable copy per change."""

    def __init__(self, entries: dict[str, str] | None = None):
        self.entries = dict(DEFAULT_SPECIAL if entries is None else entries)

    def added(self, identifier: str, full: str) -> "SpecialIdentifiers":
        return SpecialIdentifiers({**self.entries, identifier: full})

    def removed(self, identifier: str) -> "SpecialIdentifiers":
        return SpecialIdentifiers({k: v for k, v in self.entries.items() if k != identifier})

    def cleared(self) -> "SpecialIdentifiers":
        return SpecialIdentifiers({})

    def lookup(self, c: Column) -> Column:
        """Full form of a special identifier, NULL for all others."""
        if not self.entries:
            return F.lit(None).cast("string")
        pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(self.entries.items()))])
        return F.try_element_at(pairs, c)


def normalized(c: Column) -> Column:
    """Trimmed upper-case text; missing values become the empty text."""
    text = F.upper(F.trim(c.cast("string")))
    return F.coalesce(F.when(text != "NAN", text), F.lit(""))


def check_digit(c: Column) -> Column:
    """Modulus-10 double-add-double digit over the first eight characters.

    Digits count as themselves, letters from A as 10; every second value is
    doubled and the decimal digits of all values are summed.  Written as a fold
    so that the expression stays small where the optimizer repeats it.
    """
    def add(total, i):
        code = F.ascii(F.substring(c, i, F.lit(1)))
        value = (code - F.when(code < 58, 48).otherwise(55)) * (F.lit(2) - i % 2)
        return total + F.floor(value / 10).cast("int") + value % 10
    total = F.aggregate(F.sequence(F.lit(1), F.lit(8)), F.lit(0), add)
    return (F.lit(10) - total % 10) % 10


def with_check_digit(c: Column) -> Column:
    """Eight digits or capital letters get their digit; other texts stay as they are."""
    return F.when(c.rlike("^[0-9A-Z]{8}$"), F.concat(c, check_digit(c).cast("string"))).otherwise(c)


def has_valid_check_digit(c: Column) -> Column:
    """Nine digits or capital letters of which the last is the digit of the others; other texts are not valid."""
    return F.coalesce(
        c.rlike("^[0-9A-Z]{9}$") & (c.substr(9, 1) == check_digit(c).cast("string")), F.lit(False))


def pattern_type(c: Column) -> Column:
    """Name of the first pattern a normalized text fits, else NULL."""
    found = None
    for name, pattern in PATTERNS.items():
        test = c.rlike(pattern)
        found = F.when(test, name) if found is None else found.when(test, name)
    return found


def _classified(df: DataFrame, column: str, special: SpecialIdentifiers | None,
                verify_check_digit: bool) -> DataFrame:
    """``df`` with the normalized text ``_x``, special form, pattern and verdict.

    Each step is a projection of its own: a value used by several later
    expressions is computed once per row.
    """
    special = special or SpecialIdentifiers()
    x, kind = F.col("_x"), F.col("_kind")
    staged = df.withColumn("_x", normalized(quoted(column)))
    staged = staged.withColumns({"_special": special.lookup(x), "_kind": pattern_type(x)})
    staged = staged.withColumn("_digit", F.when(kind.isin("standard_8", "standard_9"), check_digit(x).cast("string")))
    bad = F.lit(False)
    if verify_check_digit:
        bad = F.coalesce((kind == "standard_9") & (x.substr(9, 1) != F.col("_digit")), F.lit(False))
    return staged.withColumn("_bad", bad)


_STEPS = ("_x", "_special", "_kind", "_digit", "_bad")


def standardized_columns(df: DataFrame, column: str = "CUSIP",
                         special: SpecialIdentifiers | None = None,
                         verify_check_digit: bool = True) -> DataFrame:
    """``df`` with original, standardized form, status and message appended."""
    x, mapped, kind, bad = F.col("_x"), F.col("_special"), F.col("_kind"), F.col("_bad")
    form = (F.when(kind == "standard_8", F.concat(x, F.col("_digit")))
            .when(kind.isin("standard_6", "cdx"), F.rpad(x, 9, "0"))
            .when(kind == "cash", F.regexp_replace(x, r"\s+", ""))
            .otherwise(x))
    status = (F.when(x == "", "invalid").when(mapped.isNotNull(), "mapped")
              .when(kind.isNull() | bad, "invalid").otherwise("standardized"))
    message = (F.when(x == "", EMPTY_MESSAGE).when(mapped.isNotNull(), "Special mapping applied")
               .when(kind.isNull(), "No pattern match").when(bad, "Check digit validation failed")
               .otherwise(F.concat(F.lit("Pattern: "), kind)))
    return _classified(df, column, special, verify_check_digit).select(
        *[quoted(c) for c in df.columns], x.alias("cusip_original"),
        F.when((x == "") | bad, x).otherwise(F.coalesce(mapped, form)).alias("cusip_standardized"),
        status.alias("standardization_status"), message.alias("standardization_message"))


def validated_columns(df: DataFrame, column: str = "CUSIP", special: SpecialIdentifiers | None = None,
                      verify_check_digit: bool = True) -> DataFrame:
    """``df`` with normalized text, validity, type and message appended."""
    x, kind, bad = F.col("_x"), F.col("_kind"), F.col("_bad")
    is_special = F.col("_special").isNotNull()
    message = (F.when(x == "", EMPTY_MESSAGE).when(is_special, "Special CUSIP mapping")
               .when(kind.isNull(), "No pattern match").when(bad, "Check digit validation failed")
               .otherwise(F.concat(F.lit("Valid "), kind, F.lit(" CUSIP"))))
    return _classified(df, column, special, verify_check_digit).select(
        *[quoted(c) for c in df.columns if c != "cusip"], x.alias("cusip"),
        ((x != "") & (is_special | (kind.isNotNull() & ~bad))).alias("is_valid"),
        F.when(is_special, "special_mapping").otherwise(kind).alias("cusip_type"),
        message.alias("validation_message"))


def identifier_statistics(df: DataFrame, column: str = "CUSIP",
                          special: SpecialIdentifiers | None = None) -> DataFrame:
    """Counts per identifier type; there are at most as many rows as types.

    Special identifiers count as standardized but neither valid nor invalid.
    """
    checked = validated_columns(df.select(quoted(column).alias("cusip")), "cusip", special)
    kind = F.when(F.col("cusip") == "", "empty").otherwise(F.coalesce("cusip_type", F.lit("unknown")))
    is_special = F.col("kind") == "special_mapping"
    # what is valid is exactly what standardization accepts
    return checked.withColumn("kind", kind).groupBy(F.col("kind").alias("cusip_type")).agg(
        F.count(F.lit(1)).alias("type_count"),
        F.count_if(F.col("is_valid") & ~is_special).alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
        F.count_if("is_valid").alias("standardized"))


def identifier_summary(df: DataFrame, column: str = "CUSIP",
                       special: SpecialIdentifiers | None = None) -> DataFrame:
    """Totals and rates in a single row (rates are 0 for an empty column)."""
    totals = identifier_statistics(df, column, special).agg(
        F.coalesce(F.sum("type_count"), F.lit(0)).alias("total_cusips"),
        F.coalesce(F.sum("valid"), F.lit(0)).alias("valid_cusips"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_cusips"),
        F.coalesce(F.sum("standardized"), F.lit(0)).alias("standardized_cusips"))
    rate = lambda part: F.coalesce(F.try_divide(F.col(part) * 100.0, F.col("total_cusips")), F.lit(0.0))
    return totals.withColumns({"validation_rate": rate("valid_cusips"),
                               "standardization_rate": rate("standardized_cusips")})


def special_table(df: DataFrame, column: str, special: SpecialIdentifiers | None = None) -> DataFrame:
    """Special identifiers that occur in ``df`` with their full form and row count."""
    special = special or SpecialIdentifiers()
    text = normalized(quoted(column))
    return (df.select(text.alias("cusip"), special.lookup(text).alias("mapped_to"))
            .filter(F.col("mapped_to").isNotNull())
            .groupBy("cusip", "mapped_to").agg(F.count(F.lit(1)).alias("n")))


def standardized_or_original(standardized: Column, original: Column) -> Column:
    """Fallback to the original when standardization yields nothing."""
    return F.coalesce(F.nullif(F.trim(standardized), F.lit("")), original)
