from __future__ import annotations

import numpy as np
from cases import CLASHING, awkward, documents, empty
from pyspark.sql import functions as F

from spreadlab.llm import quality
from spreadlab.llm.quality import QualityParams
from spreadlab.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def texts(rng, n, junk):
    words = ["alpha", "Beta", "gamma", "delta", "omega", "sigma", "kappa", "tau"]
    rows = [" ".join(rng.choice(words, 30)) + "." for _ in range(n)]
    return [" ".join(f"{w.upper()}!!" for w in r.split()) for r in rows] if junk else rows


def test_held_out_rows_of_the_table(spark, folder):
    rows = QUERIES["op11_quality"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.9 * len(held) > 0
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_votes_equal_brute_force_over_all_labelled_vectors(spark):
    rng = np.random.default_rng(1)
    good, bad = texts(rng, 40, False), texts(rng, 25, True)
    params = QualityParams(rank=12, neighbours=7, rows_per_block=8)
    docs = documents(spark, list(enumerate(good + bad)))
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in range(65)], LABELS)
    model = quality.train(docs, labels, F.lit(True), params=params)
    probes = texts(rng, 5, False) + texts(rng, 5, True) + [good[0][:20] + " " + bad[0][:40]]
    space = quality.weighted(quality.counts(probes, params), model.weights) @ model.basis
    got = quality.votes(probes, model)
    for vector, vote in zip(space, got):
        cosines = [float(vector @ v) / float(np.linalg.norm(vector)) for v in model.vectors.T]
        nearest = sorted(zip(cosines, model.labels), key=lambda x: -x[0])[:7]
        want = sum(max(c, 0) * y for c, y in nearest) / sum(max(c, 0) for c, _ in nearest)
        assert abs(want - vote) < 1e-4
    assert got[:5].min() > 0.8 and got[5:10].max() < 0.2


def test_shapes_and_repeats_are_terms():
    assert [quality.shape(w) for w in ("THE!!!!", "Word,", "élan", "a1B2", "|", "McDonald")] == ["A!!", "Aa,", "a", "a0A0", "|", "Aa"]
    plain, repeated = quality.counts(["eins zwei drei vier", "eins eins eins eins"], QualityParams())
    assert (plain[2048:] != repeated[2048:]).any()


def test_copies_do_not_fill_the_sample(spark):
    rng = np.random.default_rng(4)
    good = texts(rng, 30, False)
    rows = [(i, good[0]) for i in range(500)] + [(500 + i, t) for i, t in enumerate(good)] + [(600, texts(rng, 1, True)[0])]
    labels = spark.createDataFrame([(i, int(i != 600), 0) for i, _ in rows], LABELS)
    sample = quality.labelled_sample(documents(spark, rows), labels, F.lit(True), "quality", QualityParams(rows_per_label=20))
    assert sorted(sample.groupby("label").size().items()) == [(0, 1), (1, 20)]
    assert sample["digest"].nunique() == 21


def test_awkward_rows_clashing_names_and_no_rows(spark):
    docs = awkward(spark, clashing=True)
    assert set(CLASHING) < set(docs.columns)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (5, 0, 0), (2, 1, 0), (None, 1, 0), (6, None, None), (7, 5, 0)], LABELS)
    model = quality.train(docs, labels, F.lit(True))
    rows = quality.score(docs, model).collect()
    assert sorted([r["doc_id"] for r in rows], key=repr) == sorted([r["doc_id"] for r in docs.collect()], key=repr)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (2, 3, 4)} == {float(model.labels.mean())}
    nothing = quality.train(empty(spark), labels, F.lit(True))
    assert {r["score"] for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.score(empty(spark), model).count() == 0


def test_words_longer_than_the_memo_takes(spark):
    long = "Q" * 5000
    assert (quality.counts([long], QualityParams()) > 0).sum() == 2
