"""Removal of boilerplate lines by their frequency within a site.

A line is boilerplate of a host when more than ``ratio`` of the host's pages
hold it and at least ``min_pages`` of them do.  Counting runs over
(host, line hash) with partial aggregation, one row per page and distinct
line.  Of each host at most ``lines per page / ratio`` lines can exceed the
ratio, so the lines to drop fit one small row per host; hosts are salted by the
document id where that row meets the texts, because one host may hold a third of them.

Edge cases: NULL text and NULL host stay as they are (a NULL host is a host of
its own); lines are cut at line feeds only; empty lines are never dropped; a
text whose lines all go becomes the empty text.  Repeated rows count as pages
each, unless ``copies_vote`` is off: then all copies of a text on a host are one
page, so that a page is never taken for boilerplate because it was copied.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LineParams:
    ratio: float = 0.05
    min_pages: int = 5
    salts: int = 32
    copies_vote: bool = True  # each copy of a text counts as a page of its own


def _keys(lines: Column) -> Column:
    """One 128-bit key per line, as two hashes."""
    return F.transform(lines, lambda line: F.struct(F.xxhash64(line).alias("a"),
                                                    F.xxhash64(F.lit("second"), line).alias("b")))


def _once(text: str) -> list[Column]:
    """Key of a page among the copies of its text on a host; NULL for pages without text."""
    return [F.when(F.col(text).isNotNull(), F.xxhash64(text)).alias("t_a"),
            F.when(F.col(text).isNotNull(), F.xxhash64(F.lit("second"), text)).alias("t_b")]


def boilerplate_lines(pages: DataFrame, host: str, text: str, params: LineParams = LineParams()) -> DataFrame:
    """host, a, b (the line's key), pages, host_pages: the lines to drop."""
    site = F.col(host).cast("string").alias("host")
    keys = F.array_distinct(_keys(F.filter(F.split(text, "\n", -1), lambda x: x != ""))).alias("keys")
    per_page = pages.where(F.col(text).isNotNull())
    if params.copies_vote:
        per_page, voters = per_page.select(site, keys), pages.select(site)
    else:
        # copies go within a task first, so a large group costs one row per task
        once = _once(text)
        per_page = per_page.select(site, *once, keys).groupBy("host", "t_a", "t_b").agg(F.first("keys").alias("keys"))
        voters = pages.select(site, *once).distinct()
    counts = (
        per_page.select("host", F.explode("keys").alias("k"))
        .groupBy("host", F.col("k.a").alias("a"), F.col("k.b").alias("b")).agg(F.count("*").alias("pages"))
        .where(F.col("pages") >= params.min_pages)
    )
    totals = voters.groupBy("host").agg(F.count("*").alias("host_pages")).withColumnRenamed("host", "t_host")
    return (
        counts.join(totals, F.col("host").eqNullSafe(F.col("t_host")))
        .where(F.col("pages") > F.lit(params.ratio) * F.col("host_pages"))
        .select("host", "a", "b", "pages", "host_pages")
    )


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", key: str = "doc_id",
                     params: LineParams = LineParams()) -> DataFrame:
    """``pages`` without its boilerplate lines, plus ``lines_dropped``."""
    names = [c for c in pages.columns if c != "lines_dropped"]
    drops = (
        boilerplate_lines(pages, host, text, params).groupBy("host")
        .agg(F.collect_list(F.struct("a", "b")).alias("__drop"))
        .select(F.coalesce("host", F.lit("")).alias("__host"), F.col("host").isNull().alias("__no_host"), "__drop",
                F.explode(F.sequence(F.lit(0), F.lit(params.salts - 1))).alias("__salt"))
    )
    left = pages.select(
        *[F.col(f"`{c}`") for c in names],
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("__host"), F.col(host).isNull().alias("__no_host"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(params.salts)).cast("int").alias("__salt"))
    joined = left.join(drops, ["__host", "__no_host", "__salt"], "left")
    lines = F.split(F.col(text), "\n", -1)
    kept = F.filter(lines, lambda line: (line == "") | ~F.array_contains(
        F.col("__drop"), F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("second"), line).alias("b"))))
    has = F.col("__drop").isNotNull() & F.col(text).isNotNull()
    # filtered only once: both results come from the kept lines
    shaped = joined.withColumn("__kept", F.when(has, kept))
    cleaned = F.when(has, F.array_join("__kept", "\n")).otherwise(F.col(text))
    return shaped.select(
        *[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in names],
        F.when(has, F.size(lines) - F.size("__kept")).otherwise(0).cast("long").alias("lines_dropped"))


SQL = """
WITH parts AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
counts AS (
  SELECT source, line, count(*) AS pages
  FROM (SELECT source, unnest(list_distinct(lines)) AS line FROM parts) WHERE line <> '' GROUP BY 1, 2),
totals AS (SELECT source, count(*) AS host_pages FROM documents GROUP BY 1),
drops AS (
  SELECT c.source, list(c.line) AS dropped FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.pages >= 5 AND c.pages > 0.05 * t.host_pages GROUP BY 1),
kept AS (
  SELECT p.doc_id, p.text, p.lines, list_filter(p.lines, lambda x: x = '' OR NOT list_contains(coalesce(d.dropped, []), x)) AS keep
  FROM parts p LEFT JOIN drops d ON p.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(keep, chr(10)) END AS text,
       coalesce(len(lines) - len(keep), 0) AS lines_dropped
FROM kept
"""
