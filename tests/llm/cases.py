"""Documents with the awkward rows every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names the operators use inside
CLASHING = ("score", "lang_pred", "lines_dropped", "uid", "row", "id", "body", "__key", "digest", "c", "n", "gram", "sentence")


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = False) -> DataFrame:
    """Rows of (doc_id, text[, lang[, source]])."""
    full = [(r + (None,) * (4 - len(r)))[:4] + (len(r[1]) if r[1] is not None else None,) for r in rows]
    df = spark.createDataFrame(full, DOCUMENT)
    if clashing:
        for k, name in enumerate(CLASHING):
            df = df.selectExpr("*", f"'x{k}' AS `{name}`")
    return df


def awkward(spark: SparkSession, clashing: bool = False) -> DataFrame:
    """NULLs in every column, empty and blank texts, a very long text, ties and repeated rows."""
    long = "Ein sehr langer Text mit vielen Worten und noch mehr Worten. " * 4000
    return documents(spark, [
        (1, "A short plain text about nothing in particular at all.", "en", "a"),
        (1, "A short plain text about nothing in particular at all.", "en", "a"),
        (2, None, "en", "a"), (3, "", "de", "a"), (4, "  \n\t ", None, "b"), (5, long, "de", None),
        (None, "A text without an id, but with words.", "en", "b"), (6, "123 456 !!", "en", "b"), (7, "é́ 日本語 🎉", None, None),
        (8, "A short plain text about nothing in particular at all.", "en", "b"),
    ], clashing)


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [])
