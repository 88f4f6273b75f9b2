from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import awkward, documents, empty
from tokenizers import Tokenizer

from spreadlab.llm import packing
from spreadlab.llm.packing import Bins, PackParams, best_fit, crossover
from spreadlab.llm.queries import op3_pack

PATH = public_tokenizers.path("word_bpe_49k.json")
STRANGE = ["a  b\n\n c <|endoftext|>x", "", " " * 100, "aaaaaaaaaaaaaaaa" * 30, "it's I'll ünïcödé 日本語 🎉🎉 \t\r\n x İstanbul é ́ x y",
           "----====____....!!!!", "<|endoftext|><|startoftext|>A.B.", "Wort, Wort. wort"]


def library_ids(texts):
    return [x.ids for x in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_ids_are_the_librarys(spark, folder):
    texts = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()] + STRANGE
    found = [np.frombuffer(x, "<u4").tolist() for x in packing.TokenIds(PATH)(texts)]
    assert found == library_ids(texts)


def check_packing(rows, expected, limit=4096):
    """Pieces equal those cut from the expected ids; sequences are gapless and within the limit."""
    want = sorted((doc, k, k * limit, len(ids[k * limit:(k + 1) * limit]),
                   zlib.crc32(np.asarray(ids[k * limit:(k + 1) * limit], "<u4").tobytes()))
                  for doc, ids in expected for k in range(-(-len(ids) // limit)))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(bins), -(-sum(w[3] for w in want) // limit)


def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = op3_pack(spark, folder).collect()
    used, floor = check_packing(rows, list(zip([d["doc_id"] for d in docs], [i + [1] for i in library_ids([d["text"] or "" for d in docs])])))
    assert used <= floor * 1.01 + 1


@pytest.mark.parametrize("district", [16, 100000])
def test_rounds_and_districts(spark, folder, district):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    params = PackParams(district=district, well_filled=0.97)
    rows = packing.pack(packing.pieces(docs, PATH, params=params), params).collect()
    ids = [(d["doc_id"], i + [1]) for d, i in zip(docs.collect(), library_ids([d["text"] or "" for d in docs.collect()]))]
    check_packing(rows, ids)


def test_awkward_rows(spark):
    source = awkward(spark, clashing=True)
    rows = packing.pack(packing.pieces(source, PATH)).collect()
    assert sum(r["piece"] == 0 for r in rows) == 10
    assert {r["length"] for r in rows if r["doc_id"] in (2, 3, 4)} == {1}
    assert {r["doc_id"] for r in rows} == {None, 1, 2, 3, 4, 5, 6, 7, 8} and max(r["piece"] for r in rows) > 3
    assert packing.pack(packing.pieces(empty(spark), PATH)).count() == 0


def test_crossover_keeps_every_piece_once():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 900, 300).tolist()
    one = Bins(lengths, 1000, best_fit(lengths, 1000, list(range(300)), []))
    two = Bins(lengths, 1000, [(lengths[i], (i,)) for i in range(300)])
    for a, b in ((one, two), (two, one)):
        child = crossover(a, b, rng)
        assert sorted(i for _, m in child.bins for i in m) == list(range(300))
        assert all(load == sum(lengths[i] for i in m) <= 1000 for load, m in child.bins)


def test_a_repeated_run_gives_the_same_packing(spark, folder):
    docs = documents(spark, [(k, "wort " * (k % 700 + 1)) for k in range(400)])
    runs = [sorted(map(tuple, packing.pack(packing.pieces(docs, PATH)).collect())) for _ in range(2)]
    assert runs[0] == runs[1]


def triplets(n, limit, rng):
    """Lengths that fill ``n`` sequences exactly, three in each; long pieces first is a poor order for them."""
    out = []
    for _ in range(n):
        a = int(rng.integers(int(0.38 * limit), int(0.49 * limit)))
        b = int(rng.integers(int(0.25 * limit), (limit - a) // 2 + 1))
        out += [a, b, limit - a - b]
    return [int(x) for x in rng.permutation(out)]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("n", [20, 40])
def test_generations_improve_on_best_fit(seed, n):
    """Where best fit stays above the bound, crossover closes sequences, and no generation loses a piece."""
    rng, params = np.random.default_rng(seed), PackParams(limit=1000)
    lengths = triplets(n, 1000, rng)
    alone = len(best_fit(lengths, 1000, list(range(len(lengths))), []))
    population = packing.first_population(lengths, params, rng)
    sizes = [min(len(p.bins) for p in population)]
    for _ in range(6):
        population = packing.evolve(lengths, population, params, rng)
        sizes.append(len(population[0].bins))
        for p in population:
            assert sorted(i for _, m in p.bins for i in m) == list(range(len(lengths)))
            assert all(load == sum(lengths[i] for i in m) <= 1000 for load, m in p.bins)
    assert n <= sizes[-1] < alone and sizes == sorted(sizes, reverse=True)


def test_islands_and_redeal_improve_on_best_fit(spark):
    """The whole operator on triplets: elites migrate between the islands of a district."""
    rng, params = np.random.default_rng(1), PackParams(limit=1000)
    lengths = triplets(200, 1000, rng)
    rows = spark.createDataFrame([(k, 0, 0, n, k) for k, n in enumerate(lengths)], packing.PIECE)
    used = packing.pack(rows, params).select("sequence_id").distinct().count()
    assert 200 <= used < len(best_fit(lengths, 1000, list(range(len(lengths))), []))
