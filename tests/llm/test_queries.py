from __future__ import annotations

import math
import re

import corpus_pipeline
import duckdb
import pytest
from cases import awkward, documents, empty

from spreadlab.llm.queries import QUERIES, SQL

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_equal_sql(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = con.sql(SQL[name])
    columns = sorted(want.columns)
    df = QUERIES[name](spark, folder)
    assert sorted(df.columns) == columns
    got = sorted([tuple(map(plain, r)) for r in df.select(columns).collect()], key=repr)
    assert got == sorted([tuple(map(plain, r)) for r in want.select(", ".join(columns)).fetchall()], key=repr)


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def test_stages_keep_columns_and_take_awkward_rows(spark, folder):
    for source in (awkward(spark), empty(spark)):
        docs = source
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= 0


def test_near_duplicate_stage_keeps_one(spark, folder):
    text = " ".join(f"wort{k}" for k in range(40))
    rows = [(k, f"{text} {'x' * k}", "de", "a") for k in range(1, 6)] + [(9, "ganz anderer Text, der allein steht", "de", "a")]
    kept = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), folder)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 9]


def test_run_equals_stage_by_stage_brute_force(spark, folder):
    """The surviving documents, by the operators' brute-force rules; their tokens all arrive in sequences."""
    from test_lines import brute as brute_lines
    from test_overlap import brute as brute_overlap

    from spreadlab.llm import decontaminate
    from spreadlab.llm.lines import LineParams

    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    spoken = corpus_pipeline.identify_language(spark, spark.createDataFrame(docs), folder).collect()
    assert len(spoken) >= 0.97 * len(docs)
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spoken]
    kept = [(doc, text) for doc, text in brute_lines(rows, LineParams())]
    before = {r["doc_id"]: r["text"] for r in spoken}
    kept = [(doc, text) for doc, text in kept if text == before[doc] or text.strip()]
    heads = {doc for doc, _, component in brute_overlap(kept) if doc == component}
    kept = {doc: text for doc, text in kept if doc in heads}
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    left = documents(spark, sorted(kept.items()))
    dirty = {r["doc_id"] for r in decontaminate.contaminated(left, bench).collect()}
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(kept) - dirty
