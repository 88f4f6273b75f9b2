"""Identifiers that the universe does not hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadlab.functions.scalars import quoted
from spreadlab.operators.snapshots import latest_snapshot

SECURITY_NAMES = ("Security", "SECURITY", "security")


def identifier_columns(df: DataFrame) -> list[str]:
    """Every column whose name contains CUSIP, in any case."""
    return [c for c in df.columns if "CUSIP" in c.upper()]


def _security_column(df: DataFrame, identifier: str) -> str | None:
    for name in SECURITY_NAMES:
        if name in df.columns:
            return name
    suffix = identifier.upper().rpartition("CUSIP")[2]
    for name in SECURITY_NAMES:
        if suffix and f"{name}{suffix}" in df.columns:
            return f"{name}{suffix}"
    return None


def identifier_counts(df: DataFrame, table: str) -> DataFrame:
    """Instances and one security name per identifier over all its columns.

    Collapsed per identifier before any join, so a frequent identifier is one
    row from every task.
    """
    pairs = []
    for column in identifier_columns(df):
        name = _security_column(df, column)
        pairs.append(F.struct(quoted(column).cast("string").alias("cusip"),
                              (quoted(name).cast("string") if name else F.lit(None).cast("string")).alias("name")))
    return (df.select(F.inline(F.array(*pairs))).filter(F.col("cusip").isNotNull())
            .groupBy("cusip").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name"))
            .select(F.lit(table).alias("table_name"), "cusip",
                    F.coalesce("name", F.lit("Unknown")).alias("security_name"), "n"))


def _members(universe: DataFrame, column: str) -> DataFrame:
    return (universe.select(quoted(column).cast("string").alias("cusip"))
            .filter(F.col("cusip").isNotNull()).distinct())


def _absent(found: DataFrame, members: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not among ``members``, which are distinct.

    An outer join with a mark, as Spark moves an anti join below the aggregate that
    collapsed ``found``, where it meets every row of the table.
    """
    return found.join(members.withColumn("_member", F.lit(True)), keys, "left").filter(F.col("_member").isNull()).drop("_member")


def orphans(tables: dict[str, DataFrame], universe: DataFrame, universe_column: str = "CUSIP") -> DataFrame:
    """Identifiers of each table that are absent from the universe."""
    parts = [identifier_counts(df, name) for name, df in tables.items() if identifier_columns(df)]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return _absent(stacked, _members(universe, universe_column), ["cusip"]).select(
        "table_name", "cusip", "security_name", F.col("n").alias("instances"))


def latest_orphans(tables: dict[str, tuple[DataFrame, str | None]], universe: DataFrame,
                   universe_date: str | None, universe_column: str = "CUSIP") -> DataFrame:
    """The same for the latest snapshot of each table and of the universe."""
    current = {name: latest_snapshot(df, date) if date else df for name, (df, date) in tables.items()}
    members = latest_snapshot(universe, universe_date) if universe_date else universe
    return orphans(current, members, universe_column)


def orphan_summary(found: DataFrame) -> DataFrame:
    """Instances and distinct orphans per table."""
    return found.groupBy("table_name").agg(F.sum("instances").alias("total_instances"),
                                           F.count(F.lit(1)).alias("unique_cusips"))


def orphan_totals(found: DataFrame, tables: dict[str, DataFrame], universe: DataFrame,
                  universe_column: str = "CUSIP") -> DataFrame:
    """One row over all tables."""
    n_universe = _members(universe, universe_column).agg(F.count(F.lit(1)).alias("n")).scalar()
    checked = sum(1 for df in tables.values() if identifier_columns(df))
    return found.agg(F.coalesce(F.sum("instances"), F.lit(0)).alias("total_orphaned_instances"),
                     F.count_distinct("cusip").alias("unique_orphaned_cusips")).withColumns(
        {"universe_cusips": n_universe, "tables_checked": F.lit(checked).cast("bigint")})


def dated_orphans(df: DataFrame, universe: DataFrame, cusip: str, date: str,
                  universe_cusip: str, universe_date: str) -> DataFrame:
    """Identifiers per date that the universe of the same date lacks."""
    members = universe.select(quoted(universe_cusip).alias(cusip), quoted(universe_date).alias(date)).distinct()
    present = df.groupBy(quoted(date), quoted(cusip)).agg(F.count(F.lit(1)).alias("instances"))
    return _absent(present.filter(quoted(cusip).isNotNull()), members, [cusip, date])


def pair_orphans(pairs: DataFrame, universe: DataFrame, universe_column: str, sides: dict[str, str]) -> DataFrame:
    """Orphans on either side of a pair table; ``sides`` maps identifier to name column."""
    members = _members(universe, universe_column)
    both = F.array(*[F.struct(quoted(c).cast("string").alias("cusip"), quoted(n).cast("string").alias("security_name"))
                     for c, n in sides.items()])
    distinct = pairs.select(F.inline(both)).filter(F.col("cusip").isNotNull() & (F.col("cusip") != "")).distinct()
    return _absent(distinct, members, ["cusip"])
