from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from cases import CLASHING, awkward, documents, empty

from spreadlab.llm import ranking
from spreadlab.llm.ranking import RankingParams

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counted = [(i, Counter(cut(t))) for i, t in docs if cut(t)]
    total = sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, c in counted:
            m = 100 - 75 + (75 * c.total() * len(counted)) // total
            s = sum(weight[t] * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in cut(text) if t in c)
            if s > 0 and i is not None:
                scored.append((-s, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, **params):
    asked = spark.createDataFrame(items, "item_id long, text string")
    index = ranking.build_index(docs, params=RankingParams(**params))
    return sorted(map(tuple, ranking.search(index, asked, params=RankingParams(**params)).collect()), key=repr)


@pytest.mark.parametrize("params", [
    {}, {"stratum_postings": 40, "shard_postings": 300}, {"stratum_postings": 40, "shard_postings": 300, "item_block": 3, "broadcast_rows": 0}])
def test_brute_force_over_strata_shards_and_blocks(spark, params):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(1, 40)), p=None))) for i in range(160)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # copies: ties by id
    items = [(i, " ".join(rng.choice(vocabulary, 12))) for i in range(10)] + [(3, "w1 w1 w1 w2"), (90, "unheard"), (91, None), (92, "")]
    assert found(spark, documents(spark, rows), items, **params) == brute(rows, items)


def test_terms_of_awkward_texts(spark):
    rows = [(1, "Straße ÉTÉ été 日本語 x_y A.B a1B2"), (2, "été\x00x\x7fy ÉTÉ"), (3, "a b a b a"), (None, "été without an id"), (4, "  "), (5, None),
            (6, "w" * 500), (6, "été été")]
    items = [(1, "été X"), (2, "日本語!"), (None, "b a"), (3, "w" * 500), (4, "ÉTÉ")]
    assert found(spark, documents(spark, rows), items) == brute(rows, items)


def test_awkward_rows_clashing_names_and_no_rows(spark):
    items = [(1, "plain text"), (1, "plain text"), (2, "Ein Text")]
    docs = awkward(spark, clashing=True)
    for name in ("m", "part", "tf", "term", "ids", "df", "shard", "block"):
        docs = docs.selectExpr("*", f"1 AS `{name}`")
    assert set(CLASHING) < set(docs.columns)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(spark, docs, items) == brute(rows, items)
    for bound in (0, 1000):
        assert found(spark, empty(spark), items, broadcast_rows=bound) == []
        assert found(spark, docs, [], broadcast_rows=bound) == []


def test_strata_hold_equal_normalisers_and_every_document(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    index = ranking.build_index(docs, params=RankingParams(stratum_postings=2000))
    rows = index.strata.collect()
    assert sum(len(r["ids"]) for r in rows) == index.documents
    assert sum(len(r["at"]) for r in rows) == index.postings
    for r in rows:
        assert list(r["ids"]) == sorted(r["ids"]) and list(r["term"]) == sorted(set(r["term"]))
        ends = [*r["first"][1:], len(r["tf"])]
        assert all(list(r["tf"][a:b]) == sorted(set(r["tf"][a:b]), reverse=True) for a, b in zip(r["first"], ends))


def test_visiting_ends_below_the_tenth_score(monkeypatch):
    """One stratum holds the winners; strata whose bound is lower are not scored."""
    import pandas as pd

    params, visits, plain = RankingParams(k=2), [], ranking.Stratum.scores
    strata = pd.concat([ranking.stratum(m, 0, pd.DataFrame({
        "id": [m, m + 1, m + 2], "term": [np.array([5, 9])] * 3, "tf": [np.array([1, 1])] * 3})) for m in (30, 400, 900)])
    monkeypatch.setattr(ranking.Stratum, "scores", lambda self, *a: visits.append(self.ids[0]) or plain(self, *a))
    items = pd.DataFrame({"row": [0, 0], "id": [7, 7], "term": [5, 9], "weight": [10, 20]})
    out = ranking.search_shard(strata, items, params)
    assert visits == [30] and out["doc_id"].tolist() == [30, 31]
