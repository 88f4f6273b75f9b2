from __future__ import annotations

import random

import numpy as np
import pytest
from cases import awkward, documents, empty

from spreadlab.llm import overlap
from spreadlab.llm.overlap import JoinParams
from spreadlab.llm.text import words


def brute(rows, size=5, percent=80):
    """{(doc_id, n, component)} by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= percent * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows))


def found(df, params=JoinParams()):
    return sorted(tuple(r) for r in overlap.similar_documents(df, params=params).collect())


def family(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.random()}"
    return " ".join(out)


def corpus(seed):
    """Families of near copies at many distances, exact copies, a passage in a third of the rest, short texts."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    passage, texts = fresh(55), []
    for size, n, most in ((40, 120, 5), (80, 100, 14), (25, 60, 3), (12, 300, 12), (6, 30, 2)):
        base = fresh(n)
        texts += [family(rng, base, rng.randrange(0, most)) for _ in range(size)]
    texts += [" ".join(fresh(20) + passage + fresh(rng.randrange(5, 60))) for _ in range(60)]
    texts += [" ".join(passage + fresh(rng.randrange(0, 8))) for _ in range(30)]
    texts += [" ".join(fresh(rng.randrange(1, 200))) for _ in range(40)] + ["same text here"] * 9 + ["Same  TEXT\nhere", "one", "one", ""]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("params", [JoinParams(), JoinParams(long_list=3), JoinParams(long_list=6, full_window=10, first_pairs=1, block=7)])
def test_against_all_pairs(spark, seed, params):
    rows = corpus(seed)
    assert found(documents(spark, rows), params) == brute(rows)


def test_given_documents(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert found(documents(spark, rows)) == brute(rows)


def test_border_of_the_similarity(spark):
    """9 of 11 shingles are 81 percent, 8 of 10 are exactly 80, 7 of 9 are below."""
    for n, linked in ((13, True), (12, True), (11, False)):
        base = [f"w{k}" for k in range(n + 1)]
        rows = [(1, " ".join(base[:-1] + ["x"])), (2, " ".join(base[:-1] + ["y"]))]
        both = len(base) - 5
        assert (100 * both >= 80 * (both + 2)) == linked
        assert (len({r[2] for r in found(documents(spark, rows))}) == 1) == linked


def test_divide_skip():
    rng = np.random.default_rng(5)
    for _ in range(200):
        lists = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(rng.integers(1, 12))]
        for least in range(1, len(lists) + 1):
            docs, counts = np.unique(np.concatenate(lists), return_counts=True)
            found, shared = overlap.occurring(lists, least)
            assert found.tolist() == docs[counts >= least].tolist() and shared.tolist() == counts[counts >= least].tolist()


def test_awkward_rows(spark):
    rows = overlap.similar_documents(awkward(spark, clashing=True)).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert len(rows) == 10 and by_id[1] == [(6, 1), (6, 1)] and by_id[8] == [(6, 1)]
    assert by_id[2] == [(0, 2)] and by_id[3] == [(0, 3)] and by_id[4] == [(0, 4)]
    assert overlap.similar_documents(empty(spark)).count() == 0
    kept = overlap.keep_one(awkward(spark, clashing=True))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "1", "2", "3", "4", "5", "None", "6", "7"])


def test_marked_ids_are_found_by_bits(spark):
    rng = random.Random(4)
    ids = sorted({(rng.randrange(4) << 33) + rng.choice([0, 7, 8, 4095, 4096, rng.randrange(20_000)]) for _ in range(3000)})
    some = set(rng.sample(ids, len(ids) // 3))
    bits = overlap.bitmaps(spark.createDataFrame([(i,) for i in some for _ in "12"], "c long"))
    assert bits.count() <= 20
    for keep in (True, False):
        got = overlap.marked(spark.createDataFrame([(i,) for i in ids], "c long"), "c", bits, keep)
        assert got.columns == ["c"] and sorted(r.c for r in got.collect()) == [i for i in ids if (i in some) == keep]


def test_no_row_per_document_is_sent_to_all_tasks(spark, monkeypatch):
    sent, plain = [], overlap.join_small
    monkeypatch.setattr(overlap, "join_small", lambda left, small, keys, rows, *more: sent.append(rows) or plain(left, small, keys, rows, *more))
    rows = [(k, f"{' '.join(f'w{k // 4}.{j}' for j in range(20))}{' end' * (k % 2)}") for k in range(800)]
    assert found(documents(spark, rows)) == brute(rows)
    assert len(sent) == 3 and max(sent) < 50  # 400 rows are copies, 400 documents have a candidate
