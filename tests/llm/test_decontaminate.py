from __future__ import annotations

import random

import pandas as pd
from cases import awkward, documents, empty

from spreadlab.llm import decontaminate
from spreadlab.llm.decontaminate import SeedParams


def test_planted_passages(spark):
    rng = random.Random(4)
    fresh = lambda n: [f"w{rng.randrange(100000)}" for _ in range(n)]
    items = [fresh(rng.randrange(14, 60)) for _ in range(60)]
    rows, want = [], set()
    for k, item in enumerate(items):
        rows.append((k, " ".join(fresh(30) + item + fresh(30))))
        changed = list(item)
        for at in range(3, len(item), 8):
            changed[at] = "other"
        rows.append((100 + k, " ".join(fresh(300) + changed + fresh(5)).upper() + "."))
        rows.append((200 + k, " ".join(fresh(4) + item[:13])))
        rows.append((300 + k, " ".join(item[:6] + fresh(200))))
        want |= {(k, k), (100 + k, k), (200 + k, k)}
    bench = spark.createDataFrame([(k, ", ".join(item)) for k, item in enumerate(items)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(documents(spark, rows, clashing=True), bench).collect()}
    assert found == want


def test_given_documents_hold_their_items(spark, folder):
    """Every document that holds an item's words in a row is found."""
    docs = [(r["doc_id"], b" ".join(decontaminate.tokens(r["text"]))) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], b" ".join(decontaminate.tokens(r["text"]))) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    exact = {(d, i) for d, text in docs for i, item in items if b" " + item + b" " in b" " + text + b" "}
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(
        spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    assert exact and exact <= found


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "mit vielen worten und noch mehr worten ein sehr langer text"), (1, "mit vielen worten und noch mehr worten ein sehr langer text"),
                                   (2, None), (3, ""), (4, "too short"), (None, "a b c")], "item_id long, text string")
    rows = [tuple(r) for r in decontaminate.contaminated(awkward(spark, clashing=True), bench).collect()]
    assert rows == [(5, 1, 11, 11)]
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    assert decontaminate.contaminated(awkward(spark), bench.limit(0)).count() == 0


def test_a_crowded_bit_table_loses_nothing(spark):
    text = " ".join(f"w{k}" for k in range(40))
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = documents(spark, [(1, "x y z " + text), (2, " ".join(f"v{k}" for k in range(500)))])
    found = decontaminate.contaminated(docs, bench, params=SeedParams(max_filter_bits=6)).collect()
    assert [(r["doc_id"], r["words"]) for r in found] == [(1, 40)]


def test_words_are_hashed_like_tokens(monkeypatch):
    bodies = [None, "", "...", "One two, ONE-two\nthree", "naïve ÜBER \u4e2d\u6587 x\u0130y \ud800 z", "a" * 50 + " b", "one", " ".join(f"w{k}" for k in range(400))]
    for size in (1 << 17, 16):  # the second cuts within texts
        monkeypatch.setattr(decontaminate, "TOGETHER", size)
        seen, count = {}, 0
        for ids, some in decontaminate.together(pd.DataFrame({"id": range(len(bodies)), "body": bodies})):
            hashes, first = decontaminate.hashed_words(some)
            for body, a, b in zip(some, first, first[1:]):
                words = decontaminate.tokens(body)
                assert len(words) == b - a
                assert all(seen.setdefault(w, h) == h for w, h in zip(words, hashes[a:b].tolist()))
                count += 1
        assert count == len(bodies) and len(set(seen.values())) == len(seen) > 400


def test_few_regions_pass_without_a_passage(spark, monkeypatch):
    rng = random.Random(9)
    fresh = lambda n: " ".join(f"w{rng.randrange(100000)}" for _ in range(n))
    bench = spark.createDataFrame([(k, fresh(40)) for k in range(200)], "item_id long, text string")
    found, plain = {}, decontaminate.staged
    monkeypatch.setattr(decontaminate, "staged", lambda df, label: found.setdefault(label, plain(df, label)))
    docs = documents(spark, [(k, fresh(500)) for k in range(300)], clashing=True)
    assert decontaminate.contaminated(docs, bench).count() == 0
    assert found["regions"].count() <= 15
