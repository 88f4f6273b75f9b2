"""The registered queries ``opN_<name>``, thin over the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spreadlab.llm import decontaminate, language, licenses, lines, negatives, overlap, packing, quality, ranking, secrets, tokens, topk, toxicity
from spreadlab.llm.text import remainder, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = remainder(F.col("doc_id"), 4) == 2
    model = language.train(docs, F.coalesce(~held, F.lit(False)))
    return language.identify(docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score")


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op3_pack(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    base, every = [r.kind for r in secrets.BASE], [r.kind for r in secrets.RULES]
    more = reduce(lambda a, b: a + b, [F.size(kind) for kind in every if kind not in base])
    return found.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(secrets.joined_spans(base), 256).alias("base_sha256"), secrets.joined_spans(every).alias("spans"),
        more.cast("long").alias("n_more"))


def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = remainder(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, table(spark, folder, "labels"), F.coalesce(~held, F.lit(False)))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_token_count(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(docs).select("doc_id", "text", "lines_dropped")


def op9_similar_documents(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.similar_documents(table(spark, folder, "documents").select("doc_id", "text"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    model = quality.train(docs, table(spark, folder, "labels"), ~held)
    return quality.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", shifted), F.col("vec_id") % 50 == 0)


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.search(ranking.build_index(table(spark, folder, "documents")), table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_language_id, op2_license_scan, op3_pack, op4_secret_scan, op5_top_k, op6_toxicity, op7_token_count,
    op8_line_dedup, op9_similar_documents, op10_decontaminate, op11_quality, op12_hard_negatives, op13_ranked_search)}

SQL: dict[str, str] = {
    "op2_license_scan": licenses.SQL,
    "op5_top_k": topk.SQL,
    "op8_line_dedup": lines.SQL,
    "op12_hard_negatives": negatives.SQL,
    "op13_ranked_search": ranking.SQL,
}
