from __future__ import annotations

import random

import pytest
from cases import awkward, documents, empty
from pyspark.sql import functions as F

from spreadlab.llm import toxicity
from spreadlab.llm.text import remainder

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    learn = F.coalesce(remainder(F.col("doc_id"), 3) != 1, F.lit(False))
    return toxicity.train(spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet"), learn)


def test_held_out(spark, model):
    scored = toxicity.score(spark.read.parquet(f"{BIG}/documents.parquet"), model).where(remainder(F.col("doc_id"), 3) == 1)
    rows = scored.join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").select("toxic", "score").collect()
    clean = [r["score"] for r in rows if r["toxic"] == 0]
    toxic = [r["score"] for r in rows if r["toxic"] == 1]
    assert sum(s >= 0.7 for s in clean) <= 0.02 * len(clean)
    assert sum(s >= 0.7 for s in toxic) >= 0.6 * len(toxic)  # a part of the labels marks texts without any insult


def test_the_machine_decides(spark, model):
    """With the machine's weights at zero nothing is told apart: there is no other way to a score."""
    from dataclasses import replace

    import numpy as np
    blind = replace(model, direction=np.zeros_like(model.direction))
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    seen, unseen = ({r["doc_id"]: r["score"] for r in toxicity.score(docs, m).collect()} for m in (model, blind))
    assert sum(s >= 0.7 for s in seen.values()) > 0.03 * len(seen)
    assert len({round(blind.text_score(blind.margins([w])), 9) for w in ("idiot", "the", "scum", "zug")}) == 1
    assert sum(s >= 0.7 for s in unseen.values()) == 0 or unseen != seen


def test_features_equal_brute_force_subsequences():
    """Kernel values from the hashed features against all choices of three letters within the window."""
    from itertools import combinations

    import numpy as np
    params = toxicity.ToxicParams(slots=1 << 16)
    words = ["idiot", "idiiot", "i", "ab", "scum", "stupidity", "xxxxxxx", "été"]

    def brute(word):
        counted = {}
        for places in combinations(range(len(word)), params.length):
            width = places[-1] - places[0] + 1
            if width <= params.window:
                key = tuple(word[k] for k in places)
                counted[key] = counted.get(key, 0.0) + params.decay ** (width - params.length)
        return counted

    rows = toxicity.subsequence_features(words, params).astype(np.float64)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            x, y = brute(a), brute(b)
            norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
            want = sum(v * y.get(k, 0.0) for k, v in x.items()) / norm if norm else 0.0
            assert abs(rows[i] @ rows[j] - want) < 1e-3, (a, b)


def test_evidence_of_several_words_adds_up(model):
    one, two = model.text_score(model.margins(["moron"])), model.text_score(model.margins(["moron", "scum", "the"]))
    assert 0.7 <= one < two <= 1 and model.text_score(model.margins([])) == 0.0


def test_gaps_and_inserted_characters(model):
    for text in ("you idiot.", "Such an i d i o t here", "what an i-d-i-o-t", "an idiiot indeed", "the st.u.p.i.d one", "a MORON!", "such cl0wn s"):
        assert max(s for _, s in toxicity.sentence_scores(text, model)) >= 0.7, text
    for text in ("of the and in", "Der Text ist nicht lang. Noch ein Satz."):
        assert max(s for _, s in toxicity.sentence_scores(text, model)) < 0.7, text


def test_long_words_are_scored_whole(model):
    assert max(s for _, s in toxicity.sentence_scores("x" * 500 + " idiot " + "y" * 500, model)) >= 0.7
    assert len(toxicity.pieces("a" * 100, 24)) * 12 + 12 >= 100


def test_awkward_rows(spark, model):
    rows = toxicity.score(awkward(spark, clashing=True), model).collect()
    assert len(rows) == 10 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] < 0.1 for r in rows if r["doc_id"] in (2, 3, 4, 6))
    assert toxicity.score(empty(spark), model).count() == 0


def test_nothing_to_learn_from(spark):
    labels = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, toxic int")
    model = toxicity.train(awkward(spark), labels, F.lit(True))
    assert {r["score"] for r in toxicity.score(awkward(spark), model).collect()} == {0.0}
    assert toxicity.train(empty(spark), labels, F.lit(True)).slope == 0.0


def test_label_of_a_copied_passage(spark):
    """A word that only belongs to one copied toxic passage is no witness."""
    body = " ".join(f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60))
    rows = [(k, f"{body}. some plain words number {k} stand here at the end") for k in range(40)] + [(100 + k, f"some plain words number {k} stand here at the end") for k in range(40)]
    labels = spark.createDataFrame([(r[0], int(r[0] < 100)) for r in rows], "doc_id long, toxic int")
    assert toxicity.train(documents(spark, rows), labels, F.lit(True)).slope == 0.0


def test_long_tail_of_insults(spark):
    """About 200 insults of Zipf-like frequency are all learned, the rarest from a handful of documents."""
    rng = random.Random(8)
    letters = lambda: "".join(rng.choice("abcdefghijklmnoprstuvwz") for _ in range(rng.randrange(5, 9)))
    words = list(dict.fromkeys(letters() for _ in range(800)))
    insults, ordinary = words[:200], words[200:]
    spoken = [insult for rank, insult in enumerate(insults) for _ in range(max(8, 600 // (rank + 1)))]
    rng.shuffle(spoken)
    rows = []
    for k in range(0, len(spoken), 2):
        body = [rng.choice(ordinary) for _ in range(12)]
        for insult in spoken[k:k + 2]:
            body.insert(rng.randrange(len(body)), insult)
        rows.append((k // 2, " ".join(body)))
    toxic = len(rows)
    rows += [(10_000 + k, " ".join(rng.choice(ordinary) for _ in range(14))) for k in range(2 * toxic)]
    labels = spark.createDataFrame([(doc, int(doc < 10_000)) for doc, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(documents(spark, rows), labels, F.lit(True))
    caught = dict(zip(words, model.scores(model.margins(words)) >= 0.7))
    assert sum(caught[w] for w in insults[64:]) >= 0.9 * len(insults[64:])
    assert sum(caught[w] for w in insults[:64]) >= 0.95 * 64 and sum(caught[w] for w in ordinary) <= 0.01 * len(ordinary)


@pytest.mark.parametrize(("toxic", "clean"), [(300, 300), (400, 150)])
def test_toxic_documents_as_many_as_clean_ones(spark, toxic, clean):
    """A sample of each label bounds the greater side, so words of toxic documents may be most of all words."""
    rng = random.Random(5)
    ordinary = ["".join(rng.choice("abcdefghijklmnoprstuvwz") for _ in range(rng.randrange(4, 9))) for _ in range(300)]
    insults = ["moron", "scum", "idiot", "worthless"]
    text = lambda extra: " ".join([*(rng.choice(ordinary) for _ in range(12)), *extra, *(rng.choice(ordinary) for _ in range(6))])
    rows = [(k, text([rng.choice(insults)])) for k in range(toxic)] + [(10_000 + k, text([])) for k in range(clean)]
    labels = spark.createDataFrame([(doc, int(doc < 10_000)) for doc, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(documents(spark, rows), labels, F.lit(True))
    fresh = [(20_000 + k, text([rng.choice(insults)])) for k in range(50)] + [(30_000 + k, text([])) for k in range(50)]
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(documents(spark, fresh), model).collect()}
    assert sum(scores[20_000 + k] >= 0.7 for k in range(50)) >= 48 and sum(scores[30_000 + k] >= 0.7 for k in range(50)) <= 2
