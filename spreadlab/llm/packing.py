"""Packing of token sequences with a grouping genetic algorithm.

Documents become pieces of at most ``limit`` tokens (only longer documents are
cut).  Full pieces are sequences of their own.  The others are dealt by hash to
districts of a bounded number of pieces; in a district, islands evolve
populations of packings.  A packing is a list of bins (the groups); crossover
injects whole well-filled bins of one parent into the other, removes the bins
that then hold duplicates, and puts the displaced pieces back by best fit.
After an epoch each island's elite migrates to the next island of its district,
through a written table, and evolves there together with the local elite.
The bins of the best island that are not well filled are dealt anew to fewer
districts until one district holds them all or nothing is gained.

Everything is seeded by the district and island number, so a repeated task
gives the same packing.  Edge cases: NULL text counts as empty, and an empty
text is a piece of one token (the end id); repeated rows are pieces each;
an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spreadlab.llm.text import Memo, shared
from spreadlab.session import staged

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class PackParams:
    limit: int = 4096
    end_id: int = 1
    district: int = 8192     # pieces per district at most, on average
    islands: int = 2
    population: int = 4
    generations: int = 6
    epochs: int = 2
    well_filled: float = 0.999


class TokenIds:
    """Ids of a text by a tokenizer that never joins characters across white space.

    Such a text's ids are those of its white-space separated chunks in turn, so
    chunks met before come from a bounded memo; new ones go to the tokenizer
    together.  A plain word with or without signs behind it is one word of the
    tokenizer and maybe one run of signs, so plain words are encoded as one
    text and told apart by the vocabulary's end-of-word sign.
    """

    SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, np.bool_)
        self.ends[[number for token, number in vocab.items() if token.endswith("</w>")]] = True
        self.marks = Memo(self.each, 10_000)
        self.words = Memo(self.plain, 400_000)
        self.chunks = Memo(self.encoded, 600_000)

    def each(self, chunks: list[str]) -> list[bytes]:
        return [np.array(coded.ids, "<u4").tobytes()
                for coded in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def plain(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            return self.each(words)
        data, cuts = ids.tobytes(), [0, *(4 * stops).tolist()]
        return [data[i:j] for i, j in zip(cuts, cuts[1:])]

    def encoded(self, chunks: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each chunk."""
        bare = [chunk.rstrip(self.SIGNS) for chunk in chunks]
        # letters up to U+00FF are words of their own to the tokenizer, whatever their case
        plain = [word.isalpha() and max(word) < "\u0100" for word in bare]
        words = self.words.holding(set(compress(bare, plain)))
        ends = [chunk[len(word):] for chunk, word in zip(chunks, bare)]
        marks = self.marks.holding(set(compress(ends, plain)))
        odd = iter(self.each([chunk for chunk, is_plain in zip(chunks, plain) if not is_plain]))
        return [words[word] + marks[end] if is_plain else next(odd) for word, end, is_plain in zip(bare, ends, plain)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        # lower case first, as the tokenizer does: fewer different chunks (a final sigma alone depends on its place)
        split = [(text if "Σ" in text else text.lower()).replace("\n", " ").split(" ") for text in texts]
        known = [list(map(self.chunks.young.get, chunks)) for chunks in split]
        new = {chunk for chunks, ids in zip(split, known) if None in ids for chunk, x in zip(chunks, ids) if x is None}
        if new:
            found = self.chunks.holding(new)
            known = [[found[chunk] if x is None else x for chunk, x in zip(chunks, ids)] if None in ids else ids
                     for chunks, ids in zip(split, known)]
        return list(map(b"".join, known))


def shared_ids(path: str) -> TokenIds:
    """One per Python worker, whose memo serves all its tasks."""
    return shared(("ids", path), lambda: TokenIds(path))


def pieces(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
           params: PackParams = PackParams()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids with the end id, cut at the limit."""
    end, limit = np.asarray([params.end_id], "<u4").tobytes(), params.limit

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids = shared_ids(tokenizer_path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part, rows = batch.iloc[at:at + 256], []
                for doc, coded in zip(part["id"], ids([t or "" for t in part["body"]])):
                    coded += end
                    for number, start in enumerate(range(0, len(coded), 4 * limit)):
                        piece = coded[start:start + 4 * limit]
                        rows.append((doc, number, start // 4, len(piece) // 4, zlib.crc32(piece)))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("body"))
    return source.mapInPandas(cut, PIECE)


class Bins:
    """A packing of pieces 0..n-1: a list of (load, members)."""

    def __init__(self, lengths: list[int], limit: int, bins: list[tuple[int, tuple[int, ...]]]) -> None:
        self.lengths, self.limit, self.bins = lengths, limit, bins

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then fuller ones (mean squared fill)."""
        return -len(self.bins), sum((load / self.limit) ** 2 for load, _ in self.bins)


def best_fit(lengths: list[int], limit: int, todo: list[int], open_bins: list[tuple[int, tuple[int, ...]]]) -> list:
    """Put each piece into the fullest bin that can take it; long pieces first."""
    loads = [load for load, _ in open_bins]
    members = [list(m) for _, m in open_bins]
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set when some bin has r tokens of room
    for k, load in enumerate(loads):
        by_room.setdefault(limit - load, []).append(k)
        rooms |= 1 << (limit - load)
    for piece in sorted(todo, key=lambda i: -lengths[i]):
        size = lengths[piece]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            same = by_room[room]
            k = same.pop()
            if not same:
                rooms &= ~(1 << room)
        else:
            room, k = limit, len(loads)
            loads.append(0)
            members.append([])
        loads[k] += size
        members[k].append(piece)
        by_room.setdefault(room - size, []).append(k)
        rooms |= 1 << (room - size)
    return [(load, tuple(m)) for load, m in zip(loads, members)]


def crossover(one: Bins, two: Bins, rng: np.random.Generator) -> Bins:
    """Whole well-filled bins of ``two`` enter ``one``; what they displace is best-fitted."""
    full = sorted(two.bins, reverse=True)
    wanted = full[:max(1, int(len(full) * rng.uniform(0.3, 0.9)))]
    taken = {piece for _, members in wanted for piece in members}
    kept, loose = list(wanted), []
    # bins of the first parent without a duplicate stay; of the others the rest is displaced,
    # and so are the emptiest ones, so that they can be closed
    for load, members in one.bins:
        if not taken.isdisjoint(members):
            loose += [piece for piece in members if piece not in taken]
        elif load < 0.98 * one.limit and rng.random() < 0.5:
            loose += members
        else:
            kept.append((load, members))
    return Bins(one.lengths, one.limit, best_fit(one.lengths, one.limit, loose, kept))


def evolve(lengths: list[int], population: list[Bins], params: PackParams, rng: np.random.Generator) -> list[Bins]:
    """Generations of one island; the best packings are kept, best first."""
    floor = -(-sum(lengths) // params.limit)
    ranked = sorted(population, key=Bins.fitness, reverse=True)
    for _ in range(params.generations):
        if len(ranked[0].bins) <= floor:
            break
        children = []
        for _ in range(params.population):
            a, b = rng.integers(0, len(ranked), 2)
            children.append(crossover(ranked[min(a, b)], ranked[max(a, b)], rng))
        ranked = sorted(ranked + children, key=Bins.fitness, reverse=True)[:params.population]
    return ranked


def first_population(lengths: list[int], params: PackParams, rng: np.random.Generator) -> list[Bins]:
    """One best-fit-decreasing packing and others from randomly emptied bins."""
    start = Bins(lengths, params.limit, best_fit(lengths, params.limit, list(range(len(lengths))), []))
    out = [start]
    for _ in range(params.population - 1):
        keep = [b for b in start.bins if rng.random() < 0.7]
        held = {i for _, m in keep for i in m}
        loose = [i for i in range(len(lengths)) if i not in held]
        jitter = rng.permutation(loose)
        half = best_fit(lengths, params.limit, list(jitter[:len(jitter) // 2]), keep)
        out.append(Bins(lengths, params.limit, best_fit(lengths, params.limit, list(jitter[len(jitter) // 2:]), half)))
    return out


def _assigned(group: pd.DataFrame, packing: Bins) -> pd.DataFrame:
    bin_of = np.empty(len(group), np.int64)
    for k, (_, members) in enumerate(packing.bins):
        bin_of[list(members)] = k
    return group.assign(bin=bin_of)


def _packing(group: pd.DataFrame, lengths: list[int], limit: int) -> Bins:
    bins: dict[int, list[int]] = {}
    for i, k in enumerate(group["bin"].tolist()):
        bins.setdefault(k, []).append(i)
    return Bins(lengths, limit, [(sum(lengths[i] for i in m), tuple(m)) for m in bins.values()])


ISLAND = "uid long, length long, district int, island int, origin int, bin long"


def _epoch(params: PackParams, epoch: int, round_: int):
    """One epoch of one island; the rows hold the elites that arrived (none at first)."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        district, island = int(key[0]), int(key[1])
        rng = np.random.default_rng([round_, epoch, district, island])
        rows = rows.sort_values(["origin", "uid"], ignore_index=True)
        population, group = [], None
        for _, part in rows.groupby("origin", sort=True):
            part = part.reset_index(drop=True)
            lengths = part["length"].tolist()
            group = part
            if epoch:
                population.append(_packing(part, lengths, params.limit))
        if not population:
            population = first_population(lengths, params, rng)
        best = evolve(lengths, population, params, rng)[0]
        return _assigned(group, best).assign(island=island, origin=island)

    return run


def _pack_round(todo: DataFrame, count: int, round_: int, params: PackParams) -> DataFrame:
    """Pieces with ``district`` and ``bin``: the best island's packing of every district."""
    districts = max(1, -(-count // params.district))
    dealt = todo.withColumn("district", F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(districts)).cast("int"))
    rows = dealt.select("uid", "length", "district",
                        F.explode(F.array(*[F.lit(i) for i in range(params.islands)])).alias("island"),
                        F.lit(0).alias("origin"), F.lit(0).cast("long").alias("bin"))
    for epoch in range(params.epochs):
        solved = staged(rows.groupBy("district", "island").applyInPandas(_epoch(params, epoch, round_), ISLAND), "islands")
        # the elite stays and also moves on to the next island of the ring
        rows = solved.withColumn("island", F.explode(F.array(
            *([F.col("island")] + [F.pmod(F.col("island") + 1, F.lit(params.islands))] * (params.islands > 1)))))
    scored = (solved.groupBy("district", "island", "bin").agg(F.sum("length").alias("load"))
              .groupBy("district", "island").agg(F.count("*").alias("bins"),
                                                 F.sum(F.col("load") * F.col("load")).alias("fill")))
    best = scored.groupBy("district").agg(
        F.max_by("island", F.struct(-F.col("bins"), "fill", -F.col("island"))).alias("island"))
    return solved.join(best, ["district", "island"]).select("uid", "length", "district", "bin")


def pack(parts: DataFrame, params: PackParams = PackParams(), max_rounds: int = 4) -> DataFrame:
    """``parts`` (see ``pieces``) with ``sequence_id`` and ``offset``."""
    parts = staged(parts.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    # a sequence's id holds round, district and bin; full pieces take their own number, below 0
    placed = parts.where(F.col("length") >= params.limit).select("uid", "length", (-1 - F.col("uid")).alias("sequence_id"))
    todo = parts.where(F.col("length") < params.limit).select("uid", "length")
    count = todo.count()
    for round_ in range(1, max_rounds + 1):
        if not count:
            break
        packed = staged(_pack_round(todo, count, round_, params), "packed")
        well = (packed.groupBy("district", "bin").agg(F.sum("length").alias("load"))
                .where(F.col("load") >= params.well_filled * params.limit).select("district", "bin"))
        loose = staged(packed.join(well, ["district", "bin"], "left_anti").select("uid", "length"), "displaced")
        left = loose.count()
        # nothing to gain from another deal: one district held all, or hardly a bin was well filled
        last = count <= params.district or round_ == max_rounds or left > 0.9 * count
        stay = packed if last else packed.join(well, ["district", "bin"])
        placed = placed.unionByName(stay.select("uid", "length", (
            F.lit(round_ << 60) + F.col("district").cast("long") * F.lit(1 << 28) + F.col("bin")).alias("sequence_id")))
        if last:
            break
        todo, count = loose, left
    before = Window.partitionBy("sequence_id").orderBy("uid")
    offsets = placed.select("uid", "sequence_id", (F.sum("length").over(before) - F.col("length")).alias("offset"))
    return parts.join(offsets, "uid").drop("uid")
