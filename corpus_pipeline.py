"""From raw documents to packed sequences: five stages, each written and read again.

``run(spark, folder)`` applies the stages to the ``documents`` table.  Every
stage takes all that its predecessor kept; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spreadlab.llm import decontaminate, language, lines, overlap, packing
from spreadlab.llm.text import remainder, table
from spreadlab.session import staged

# A document of a learned language scores above this; the kernel of a text is a cosine, so texts like none score near 0.
LEAST_LANGUAGE_SCORE = 0.1


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts without letters and texts like no language go.

    When no row has a language to learn from, only texts without letters go.
    """
    model = language.train(docs, F.coalesce(remainder(F.col("doc_id"), 4) != 2, F.lit(False)))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs, model)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their site's boilerplate lines; a document left without text goes.

    Copies of a text count as one page: the near-duplicate stage needs one of them whole.
    """
    cleaned = lines.drop_boilerplate(docs, params=lines.LineParams(copies_vote=False))
    kept = cleaned.where((F.col("lines_dropped") == 0) | (F.trim("text") != ""))
    counted = F.when(F.col("lines_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", counted).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id stays of every group of near duplicates; of rows with one id all stay."""
    return overlap.keep_one(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    parts = packing.pieces(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(parts)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]

# Language ID, token counts and the packing are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result in the shared scratch folder before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
