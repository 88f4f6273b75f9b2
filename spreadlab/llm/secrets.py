"""Secret scanning over a trigram inverted index.

From each rule's pattern a Boolean query over trigrams is derived: a
disjunction of alternatives, each a conjunction of the trigrams every match of
that alternative must hold.  The index has a posting (trigram, document) for
every trigram that some rule asks for; postings are intersected by counting
those of a document per alternative, and only the candidates are verified with
the pattern.  A rule with an alternative without mandatory trigram, such as a
long run of hexadecimal digits, scans every text.

Verification finds the leftmost non-overlapping matches: the matches and the
stretches between them give code-point positions.  All of it is built-in
Spark functions.

Edge cases: NULL text counts as empty and gives zeros; texts are scanned
whole; repeated rows are reported each; further columns are ignored.
"""

from __future__ import annotations

import re
import re._parser as grammar  # the standard library's own pattern parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spreadlab.llm.text import is_set, join_small
from spreadlab.session import staged


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str          # read alike by Java and Python
    measured: int = 0     # group whose length counts
    least: int = 0        # shorter matches are dropped


# The base kinds of the contract, in its order.
BASE = (
    Rule("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]+", 0, 32),
)
# further kinds of this library
MORE = (
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", "gh[opsru]_[A-Za-z0-9]+", 0, 40),
)
RULES = BASE + MORE
FEW = 8  # a choice of more characters than this ends a literal


def _alternatives(tree) -> list[list[str]] | None:
    """Literal runs of every way through the pattern; '' marks a break between runs."""
    ways: list[list[str]] = [[""]]

    def extend(parts: list[list[str]]) -> None:
        nonlocal ways
        ways = [a[:-1] + [a[-1] + b[0]] + b[1:] for a in ways for b in parts]

    for op, value in tree:
        if op is grammar.LITERAL:
            extend([[chr(value).lower()]])
        elif op is grammar.SUBPATTERN:
            extend(_alternatives(value[3]))
        elif op is grammar.BRANCH:
            extend([way for branch in value[1] for way in _alternatives(branch)])
        elif op is grammar.IN and all(o is grammar.LITERAL for o, _ in value) and len(value) <= FEW:
            extend([[chr(v).lower()] for _, v in value])
        elif op is grammar.MAX_REPEAT and value[:2] == (0, 1):
            extend([[""]] + _alternatives(value[2]))
        elif op is grammar.MAX_REPEAT and value[0] >= 1:
            inner = _alternatives(value[2])
            extend(inner if value[1] == 1 else [way + [""] for way in inner])
        else:
            extend([["", ""]])
    return ways


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """The alternatives' mandatory trigrams, or None when some alternative has none."""
    found = {frozenset(run[k:k + 3] for run in way for k in range(len(run) - 2))
             for way in _alternatives(grammar.parse(pattern))}
    if not all(found):
        return None
    return sorted((q for q in found if not any(other < q for other in found)), key=sorted)


def postings(docs: DataFrame, text: Column, vocabulary: list[str]) -> DataFrame:
    """The index: a row per wanted trigram and document that holds it, in any case."""
    low = docs.withColumn("__low", F.lower(text))
    present = F.array(*[F.when(F.contains(F.col("__low"), F.lit(t)), F.lit(t)) for t in vocabulary])
    return low.select("__key", F.explode(F.array_compact(present)).alias("trigram"))


def candidates(docs: DataFrame, text: Column, rules: tuple[Rule, ...]) -> tuple[DataFrame | None, dict[str, int]]:
    """__key and a bit per rule for the documents that satisfy the rule's query; the bits of the rules that have one."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    bits = {kind: 1 << n for n, (kind, q) in enumerate(queries.items()) if q}
    if not bits:
        return None, bits
    wanted = [(t, bits[kind], n, len(q)) for kind in bits for n, q in enumerate(queries[kind]) for t in sorted(q)]
    plan = docs.sparkSession.createDataFrame(wanted, "trigram string, bit int, way int, need long")
    index = postings(docs, text, sorted({w[0] for w in wanted})).distinct()
    whole = (index.join(F.broadcast(plan), "trigram")  # as many rows as the rules have trigrams
             .groupBy("__key", "bit", "way", "need").agg(F.count("*").alias("n")).where("n = need"))
    return whole.groupBy("__key").agg(F.bit_or("bit").alias("__rules")), bits


def _spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of the rule's matches that are long enough."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    sized = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.measured)) if rule.measured else whole,
                        lambda m: F.length(m))
    gaps = F.split(text, rule.pattern, -1)
    steps = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(whole)).alias("gap"), whole.alias("hit"), sized.alias("size"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)").alias("out"))

    def step(state: Column, m: Column) -> Column:
        begin = state["at"] + F.length(m["gap"])
        end = begin + F.length(m["hit"])
        span = F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end"))
        return F.struct(end.cast("long").alias("at"), F.when(
            m["size"] >= rule.least, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    return F.aggregate(steps, start, step, lambda state: state["out"])


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, and a column per kind: the array of its spans (code points, end exclusive), in the rules' order."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), is_set(F.col(text)).alias("__text"))
    rows = rows.withColumn("__key", F.struct(F.col("doc_id").cast("string").alias("id"), F.xxhash64("__text").alias("h")))
    rows = rows.withColumn("__key", F.xxhash64(F.col("__key")))
    found, bits = candidates(rows, F.col("__text"), rules)
    if found is not None:
        found = staged(found, "candidates")
        rows = join_small(rows, found, ["__key"], found.count())
    none = F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)")
    columns = []
    for rule in rules:
        if rule.kind in bits:
            look = F.coalesce(F.col("__rules").bitwiseAND(F.lit(bits[rule.kind])) != 0, F.lit(False))
        else:  # no mandatory trigram: every text is scanned, here for one long enough match
            look = F.col("__text").rlike(re.sub(r"\+$", f"{{{rule.least}}}", rule.pattern)) if rule.least else F.lit(True)
        columns.append(F.when(look, _spans(F.col("__text"), rule)).otherwise(none).alias(rule.kind))
    return rows.select("doc_id", *columns)


def joined_spans(kinds: list[str]) -> Column:
    """kind:start:end of all spans of these kinds, by start, then in the given order, comma-joined."""
    def tagged(n: int, kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(
            s["start"].alias("start"), F.lit(n).alias("n"), F.concat_ws(":", F.lit(kind), s["start"], s["end"]).alias("said")))

    every = F.concat(*[tagged(n, kind) for n, kind in enumerate(kinds)])
    return F.array_join(F.transform(F.array_sort(every), lambda s: s["said"]), ",")
