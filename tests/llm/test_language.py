from __future__ import annotations

import corpus_pipeline
from cases import awkward, documents, empty
from pyspark.sql import functions as F

from spreadlab.llm import language
from spreadlab.llm.language import LanguageParams
from spreadlab.llm.queries import op1_language_id


def test_held_out_accuracy(spark, folder):
    found = op1_language_id(spark, folder).toPandas()
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").toPandas()
    both = found.merge(truth, on="doc_id")
    assert len(found) == len(truth) and found["score"].between(0, 1).all()
    held = both[both["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() >= 0.95


def test_predictions_use_the_text_alone(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language.train(docs, F.lit(True))
    plain = language.identify(docs.select("doc_id", "text"), model)
    mixed = language.identify(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")), model)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, mixed.select("doc_id", "text", "lang_pred", "score").collect()))


def test_awkward_rows(spark):
    model = language.train(documents(spark, [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "fr")]), F.lit(True))
    rows = language.identify(awkward(spark, clashing=True), model).collect()
    assert len(rows) == 10
    by_text = {r["text"]: (r["lang_pred"], r["score"]) for r in rows}
    for text in (None, "", "  \n\t ", "123 456 !!"):
        assert by_text[text] == ("und", 0.0)
    assert by_text["é́ 日本語 🎉"][0] != "und"
    assert language.identify(empty(spark), model).count() == 0


def test_copies_are_one_text_of_the_sample(spark):
    """5,000 rows of three texts beside many single ones: every language is learned, and no row arrives twice."""
    rows = [(k, ("der Hund läuft im Garten", "die Katze schläft lange", "das Haus ist sehr alt")[k % 3], "de") for k in range(5000)]
    rows += [(9000 + k, f"the cat number {k} sleeps on the warm roof", "en") for k in range(500)] + [(9900, "123 !!", "xx")]
    docs = documents(spark, rows)
    sample = language.labelled_sample(docs, F.lit(True), LanguageParams(rows_per_language=40))
    assert sample.groupby("lang").size().to_dict() == {"de": 3, "en": 40}
    assert len(language.labelled_sample(docs, F.lit(True), LanguageParams(rows_per_language=40, sample_rows=10))) == 10
    model = language.train(docs, F.lit(True))
    assert language.predict(["die Katze im Garten", "the cat on the roof"], model)[0] == ["de", "en"]


def test_nothing_to_learn_from(spark):
    model = language.train(empty(spark), F.lit(True))
    assert {r["lang_pred"] for r in language.identify(awkward(spark), model).collect()} == {"und"}


def test_pipeline_without_languages(spark, folder):
    """Without a single lang the stage keeps every text that has letters."""
    source = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, source, folder)
    assert kept.columns == source.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "5", "7", "8", "None"]
