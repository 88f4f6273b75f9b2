"""Exact token counts of every prefix, by dynamic programming.

Byte-pair encoding has one valid segmentation of a string, and it is the only
one whose neighbouring tokens are all *compatible* (encoding the two tokens'
bytes gives the two tokens back).  So the last token of a prefix is the one
suffix token that is compatible with the last token of what precedes it, and

    count(prefix) = count(prefix without its last token) + 1.

One pass over a chunk therefore gives the token count of each of its prefixes
without encoding any of them.  Texts are first cut by the vocabulary's own
pattern; chunks never share a token, so a text's prefix counts are the running
sums of its chunks' counts plus the counts inside one chunk.  Chunk results are
kept in a bounded memo.

``prefix_counts`` answers truncation and budget questions: the tokens of the
text cut after any character, with the cut made in the given segmentation of
the whole text.  ``count_tokens`` is its last entry.

Edge cases: NULL counts as empty (0 tokens); the special string counts as one
token wherever it stands, as is the library's default; texts of any length are
processed whole; repeated rows are counted each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadlab.llm.text import MEMO_ENTRIES, Memo, shared


NO_TOKEN, PRODUCED, NOT_TRIED = range(3)


def byte_symbols() -> dict[str, int]:
    """The printable symbols that stand for bytes in the vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class PrefixCounter:
    """Token counts of the prefixes of texts under one byte-level BPE vocabulary."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbol = byte_symbols()
        coded = {token: bytes(symbol[c] for c in token) for token in spec["model"]["vocab"]
                 if all(c in symbol for c in token)}
        self.rank: dict[tuple[bytes, bytes], int] = {}
        for number, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[coded[left], coded[right]] = number
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pattern = regex.compile(pattern)
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.known = Memo(lambda new: [self.chunk_prefixes(c.encode("utf-8", "surrogatepass"))[-1] for c in new], 800_000)
        special = set(self.special)
        tokens = {b for t, b in coded.items() if t not in special}
        # every ending of a token, and whether it is a token itself that encoding can produce
        self.endings: dict[bytes, int] = {t[k:]: NO_TOKEN for t in tokens for k in range(len(t))}
        self.endings.update(dict.fromkeys(tokens, NOT_TRIED))

    def merged(self, parts: list[bytes]) -> list[bytes]:
        """Plain byte-pair merging of a short byte string."""
        while len(parts) > 1:
            best = min(((self.rank.get(pair, 1 << 60), k) for k, pair in enumerate(zip(parts, parts[1:]))))
            if best[0] == 1 << 60:
                break
            k = best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def is_produced(self, token: bytes) -> bool:
        produced = len(self.merged([token[k:k + 1] for k in range(len(token))])) == 1
        self.endings[token] = PRODUCED if produced else NO_TOKEN
        return produced

    def compatible(self, left: bytes, right: bytes) -> bool:
        found = self.fits.get((left, right))
        if found is None:
            if len(self.fits) > MEMO_ENTRIES:
                self.fits.clear()
            both = left + right
            found = self.fits[left, right] = self.merged([both[k:k + 1] for k in range(len(both))]) == [left, right]
        return found

    def chunk_prefixes(self, chunk: bytes) -> list[int]:
        """Token counts of the prefixes of 1, 2, … bytes of a chunk."""
        endings, fits = self.endings, self.fits
        counts, last = [0], [b""]
        for end in range(1, len(chunk) + 1):
            found, start = [], end - 1
            while start >= 0:
                piece = chunk[start:end]
                kind = endings.get(piece)
                if kind is None:
                    break  # ends no token, so nothing longer does
                if kind == PRODUCED or (kind == NOT_TRIED and self.is_produced(piece)):
                    found.append((start, piece))
                start -= 1
            for start, token in reversed(found):
                if not start:
                    break
                pair = (last[start], token)
                if fits[pair] if pair in fits else self.compatible(*pair):
                    break
            counts.append(counts[start] + 1)
            last.append(token)
        return counts[1:]

    def chunks(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text's chunks in turn, and whether each is a special string."""
        at = 0
        for found in self.cut_special.finditer(text) if self.cut_special else ():
            yield from ((c, False) for c in self.pattern.findall(text[at:found.start()]))
            yield found[0], True
            at = found.end()
        yield from ((c, False) for c in self.pattern.findall(text[at:] if at else text))

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of the text cut after each character (a character's bytes belong together)."""
        out, total = [], 0
        for chunk, special in self.chunks(text):
            if special:
                out += [total + 1] * len(chunk)
                total += 1
                continue
            inner, at = self.chunk_prefixes(chunk.encode("utf-8", "surrogatepass")), 0
            for character in chunk:
                at += len(character.encode("utf-8", "surrogatepass"))
                out.append(total + inner[at - 1])
            total += inner[-1]
        return out

    def longest_prefix(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        counts = self.prefix_counts(text)
        return max((k + 1 for k, n in enumerate(counts) if n <= budget), default=0)

    def count(self, text: str) -> int:
        """The last prefix count, with the chunks' own last counts from the memo."""
        if self.cut_special and any(s in text for s in self.special):
            parts = self.cut_special.split(text)
        else:
            parts = [text]
        total = len(parts) - 1
        for part in parts:
            found = self.pattern.findall(part)
            total += sum(map(self.known.holding(set(found)).__getitem__, found))
        return total


def shared_counter(path: str, pattern: str) -> PrefixCounter:
    """One counter per Python worker, whose memo serves all its tasks."""
    return shared(("counter", path, pattern), lambda: PrefixCounter(path, pattern))


def count_tokens(docs: DataFrame, path: str, pattern: str, budget: int = 512, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = shared_counter(path, pattern)
        for batch in batches:
            bodies = [t or "" for t in batch["body"]]
            yield pd.DataFrame({"doc_id": batch["id"],
                                "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in bodies],
                                "n_tokens": [counter.count(t) for t in bodies]})

    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("body"))
    return source.mapInPandas(run, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > budget)


def budget_cuts(docs: DataFrame, path: str, pattern: str, budget: int, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """doc_id, cut_text, cut_tokens: every text cut to its longest prefix within the budget."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = shared_counter(path, pattern)
        for batch in batches:
            rows = []
            for doc, body in zip(batch["id"], batch["body"]):
                counts = counter.prefix_counts(body or "")
                cut = max((k + 1 for k, n in enumerate(counts) if n <= budget), default=0)
                rows.append((doc, (body or "")[:cut], counts[cut - 1] if cut else 0))
            yield pd.DataFrame(rows, columns=["doc_id", "cut_text", "cut_tokens"])

    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("body"))
    return source.mapInPandas(run, "doc_id long, cut_text string, cut_tokens long")
