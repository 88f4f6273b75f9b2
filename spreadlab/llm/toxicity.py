"""Toxicity scores from a subsequence string kernel and a linear machine.

A word is described by its gap-weighted subsequences of three letters: every
choice of three letters within a short window counts, the less the wider the
window (weight ``decay`` per letter left out).  Words that share many such
subsequences are similar, also with letters inserted, doubled or left out.
Letters written apart (``i d i o t``) are joined first, other signs between
letters are dropped, digits that stand for letters are read as these.

Training uses labelled sentences only.  Every sentence of a clean document is
clean; of a toxic document it is only known that some sentence is toxic, so the
support vector machine (squared hinge loss, Newton steps) is trained in rounds: the words of sentences that occur in
toxic and never in clean documents are positive examples, each as heavy as the
documents that hold it beyond what chance and clean documents explain, the words of clean documents are negative ones; then the
machine itself adds positive words, those of toxic documents beyond a
border that few clean documents reach.  Ordinary words it takes for toxic join the
negative examples.  A bounded draw of either side (the words most typical of
toxic sentences, the most frequent ordinary ones and those most like the former) are the
landmarks, which are a basis only.  A word's margin becomes a probability by a
logistic curve, and a sentence or document is toxic when any of its distinct
words is; the curve is the likeliest one for documents put aside, a third, when
the machine is trained on the others.

Edge cases: NULL and empty texts, and texts without letters, get the score of
the smallest margin (near 0); without toxic training sentences, or when the
documents put aside are not told apart, every score is 0; long words are scored in overlapping pieces, so no part of a text is left
out; repeated rows are scored each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spreadlab.llm.text import Memo, shared
from spreadlab.session import staged

SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
LETTERS_APART = re.compile(r"(?<![^\W_])[^\W_](?:[^\w]{1,3}[^\W_]){2,}(?![^\W_])")
READ_AS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
NOT_LETTER = re.compile(r"[\W\d_]+")
LOWEST = -1000.0
BEGIN, END = "\x02", "\x03"
INNER_SIGN = re.compile(r"(?<=[^\W_])[013457@$!](?=[^\W_])")


@dataclass(frozen=True)
class ToxicParams:
    length: int = 3              # letters of a subsequence
    window: int = 6              # letters it may span
    decay: float = 0.8           # per letter left out
    slots: int = 2048            # hashed subsequences, a power of two
    piece: int = 24              # longer words are scored in pieces of so many letters
    sample_documents: int = 4000  # bound of the training documents, per label
    examples: int = 20000        # words of toxic sentences that may be positive to start with, the most frequent ones
    false_share: float = 0.05    # of them that may be expected to be so by chance
    selections: int = 3          # rounds in which the machine adds positive words
    foremost: int = 12           # words of a text put aside that are looked at for the calibration
    clean_share: float = 0.1     # of the clean pages that may hold words like those it adds
    basis: int = 512             # landmarks from the words most typical of toxic sentences
    ordinary: int = 64           # landmarks from the most frequent ordinary words
    hard_basis: int = 448        # landmarks from the ordinary words most like toxic ones
    sample_words: int = 12000    # ordinary words to train on
    hard_words: int = 1000       # of them the ones most like toxic ones
    rounds: int = 30
    regular: float = 1e-4


def raw_words(text: str) -> list[str]:
    """Lower-cased words between white space, letters written apart joined."""
    return LETTERS_APART.sub(lambda m: NOT_LETTER.sub("", m[0].translate(READ_AS)), text.lower()).split()


def plain_word(word: str) -> str:
    """The letters of a word, read through tricks of spelling."""
    return word if word.isalpha() else NOT_LETTER.sub("", INNER_SIGN.sub(lambda m: m[0].translate(READ_AS), word))


def plain_words(text: str) -> list[str]:
    return [word for word in map(plain_word, raw_words(text)) if word]


def pieces(word: str, size: int) -> list[str]:
    """The word between marks of its begin and end, cut into overlapping pieces when it is long."""
    word = f"{BEGIN}{word}{END}"
    if len(word) <= size:
        return [word]
    return [word[k:k + size] for k in range(0, len(word) - size // 2, size // 2)]


def subsequences(words: list[str], params: ToxicParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and weight of the gap-weighted subsequences of words of at most ``piece`` letters; rows have unit length."""
    span, slots = params.window, params.slots
    size = max(map(len, words), default=0)
    text = "".join(w.ljust(size + span, "\0") for w in words)
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64).reshape(len(words), size + span)
    base = (np.arange(len(words), dtype=np.int64) * slots)[:, None]
    widths = span - params.length + 1
    codes, found = {(): letters[:, :size]}, [np.empty(0, np.int64)]
    for count in range(1, params.length):
        for offsets in combinations(range(1, span), count):
            other = letters[:, offsets[-1]:offsets[-1] + size]
            codes[offsets] = codes[offsets[:-1]] * np.uint64(0x100000001B3) + other
            if count == params.length - 1:
                there = other > 0  # letters are missing at the end only
                slot = ((codes.pop(offsets)[there] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (slots - 1)
                # sorted by row, slot and width with one key
                found.append((slot + np.broadcast_to(base, there.shape)[there]) * widths + offsets[-1] + 1 - params.length)
    key = np.concatenate(found)
    if len(words) * slots * widths < 1 << 31:
        key = key.astype(np.int32)  # sorts in half the time
    key.sort()
    place, width = np.divmod(key, widths)
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.empty(0, np.int64)
    weight = (params.decay ** np.arange(widths))[width]
    weight = np.add.reduceat(weight, starts) if len(place) else weight
    row, slot = np.divmod(place[starts], slots)
    length = np.sqrt(np.bincount(row, weight * weight, minlength=len(words)))
    return row, slot, weight / np.maximum(length[row], 1e-6)


def subsequence_features(words: list[str], params: ToxicParams) -> np.ndarray:
    """The same as a dense matrix."""
    out = np.zeros((len(words), params.slots), np.float32)
    row, slot, weight = subsequences(words, params)
    out[row, slot] = weight
    return out


@dataclass(frozen=True)
class ToxicModel:
    direction: np.ndarray    # slots: landmarks, Nyström map and machine folded into one
    bias: float
    slope: float             # of the logistic fit
    shift: float
    params: ToxicParams

    def margins(self, words: list[str]) -> np.ndarray:
        """The largest margin of each word's pieces."""
        cut = [pieces(word, self.params.piece) for word in words]
        flat = [p for c in cut for p in c]
        found = np.empty(len(flat), np.float32)
        alike = np.argsort([len(p) for p in flat], kind="stable")  # pieces of like length make narrow arrays
        for at in range(0, len(flat), 4096):
            these = alike[at:at + 4096]
            row, slot, weight = subsequences([flat[k] for k in these], self.params)
            found[these] = np.bincount(row, weight * self.direction[slot], minlength=len(these)) + self.bias
        if len(flat) != len(words):
            found = np.maximum.reduceat(found, np.cumsum([0] + [len(c) for c in cut[:-1]]))
        return found

    def raw_margins(self, words: list[str]) -> np.ndarray:
        """Margins of words as they stand in a text; one without a letter has the lowest."""
        plain = [plain_word(word) for word in words]
        margins = np.full(len(words), LOWEST, np.float32)
        at = [k for k, word in enumerate(plain) if word]
        if at:
            margins[at] = self.margins([plain[k] for k in at])
        return margins

    def scores(self, margins: np.ndarray) -> np.ndarray:
        """Score of each word that stands alone."""
        return 1.0 - np.exp(-self.evidence(margins))

    def evidence(self, margins: np.ndarray) -> np.ndarray:
        """Minus the logarithm of the probability that a word is not toxic; evidence of several words adds up."""
        if not self.slope:
            return np.zeros(len(margins))
        return np.logaddexp(0.0, self.slope * (np.minimum(margins, 1.0).astype(np.float64) - self.shift))

    def text_score(self, margins: np.ndarray) -> float:
        """Score of a text from the margins of its distinct words."""
        return float(1.0 - np.exp(-self.evidence(margins).sum())) if len(margins) else 0.0


def shared_memo(model: ToxicModel) -> Memo:
    """The margins of raw words under a model, one memo per Python worker, which serves all its tasks."""
    return shared(("margins", model.direction.tobytes(), model.bias), lambda: Memo(model.raw_margins, 200_000))


def training_documents(docs: DataFrame, labels: DataFrame, learn: Column, params: ToxicParams) -> DataFrame:
    """text, toxic, weight, page (hash of the text) of at most about ``sample_documents`` documents of each label, drawn by a hash of the id.

    ``weight`` is the number of labelled documents a drawn one stands for.
    """
    known = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(learn)
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    share = F.lit(1.0)
    for toxic, n in counts.items():
        share = F.when(F.col("toxic") == toxic, F.lit(min(1.0, params.sample_documents / n))).otherwise(share)
    # about sample_documents rows of each label, whatever the number of documents: a bounded side
    chosen = F.broadcast(known.where(draw < share).withColumn("weight", 1.0 / share))
    return docs.select("doc_id", "text").where("text IS NOT NULL").join(chosen, "doc_id").select(
        "text", "toxic", "weight", F.xxhash64("text").alias("page"))


def chance(bad: np.ndarray, pages: np.ndarray, share: float) -> np.ndarray:
    """Probability of at least ``bad`` toxic ones among ``pages`` documents, when each is toxic with probability ``share``."""
    logs = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, max(pages, default=0) + 1)))))
    out = np.ones(len(bad))
    if 0 < share < 1:
        for at, (k, n) in enumerate(zip(bad, pages)):
            i = np.arange(k, n + 1)
            out[at] = np.exp(logs[n] - logs[i] - logs[n - i] + i * np.log(share) + (n - i) * np.log1p(-share)).sum()
    return np.minimum(out, 1.0)


def beyond_chance(words: list[str], bad: np.ndarray, pages: np.ndarray, tested: int, share: float, params: ToxicParams) -> list[str]:
    """The words whose toxic documents chance does not explain, most certain first; ``tested`` words were looked at in all."""
    likely = chance(bad, pages, share)
    order = sorted(range(len(words)), key=lambda k: (likely[k], words[k]))
    passed = np.flatnonzero(likely[order] <= params.false_share * np.arange(1, len(order) + 1) / max(tested, 1))
    return [words[k] for k in order[:passed[-1] + 1]] if len(passed) else []


def least_loss(x: np.ndarray, y: np.ndarray, cost: np.ndarray, params: ToxicParams) -> np.ndarray:
    """Weights of the support vector machine with squared hinge loss, by Newton steps over the rows within the margin."""
    def loss(weight: np.ndarray) -> float:
        return float(params.regular * (weight @ weight) + cost @ np.maximum(0.0, 1.0 - y * (x @ weight)) ** 2)

    weight = np.zeros(x.shape[1])
    best = loss(weight)
    for _ in range(params.rounds):
        active = np.flatnonzero(y * (x @ weight) < 1)
        rows = x[active] * np.sqrt(cost[active])[:, None].astype(np.float32)
        gram = (rows.T @ rows).astype(np.float64) + params.regular * np.eye(x.shape[1])
        step = np.linalg.solve(gram, rows.T @ (np.sqrt(cost) * y)[active]) - weight
        rate = 1.0
        while rate > 1e-3 and loss(weight + rate * step) > best:
            rate /= 2
        after = loss(weight + rate * step)
        if after > best * (1 - 1e-4):
            break
        weight, best = weight + rate * step, after
    return weight


def dense_pieces(words: list[str], params: ToxicParams) -> np.ndarray:
    """Features of words as examples: the first piece of each."""
    return subsequence_features([pieces(w, params.piece)[0] for w in words], params)


def nystroem(landmarks: list[str], params: ToxicParams) -> np.ndarray:
    """The map from features to the space the landmarks span, where inner products are kernel values."""
    marks = dense_pieces(list(dict.fromkeys(landmarks)), params)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    return marks.T.astype(np.float64) @ (vectors[:, good] / np.sqrt(values[good]))


def bent(words: list[str], plain: set[str]) -> list[str]:
    """The words with a letter inserted or doubled, unless that is an ordinary word."""
    rng = np.random.default_rng(11)
    out = [w[:k] + str(rng.choice(list("aeinrstx*"))).replace("*", w[k - 1]) + w[k:] for w in words for k in range(1, len(w))]
    return [w for w in out if w not in plain]


def fit(positive: dict[str, float], ordinary: dict[str, float], hard: dict[str, float], lift: np.ndarray, params: ToxicParams) -> ToxicModel:
    """The machine on words of toxic against words of clean sentences, each with its pages, whose root is its weight.

    Positive words of several pages stand beside bent spellings of theirs, which weigh half as much;
    ordinary words weigh as much as all these, and the hard ones among them their own weight besides.
    """
    sure = [w for w, pages in positive.items() if pages >= 2]
    positive, hard = ({w: pages ** 0.5 for w, pages in side.items()} for side in (positive, hard))
    spelled = bent(sure, {*ordinary, *hard})
    heavy = sum(positive[w] for w in sure)
    words = [*positive, *spelled, *ordinary, *hard]
    x = np.vstack([(dense_pieces(words[k:k + 1024], params) @ lift).astype(np.float32) for k in range(0, len(words), 1024)])
    cost = np.r_[np.fromiter(positive.values(), np.float64, len(positive)), np.full(len(spelled), 0.5 * heavy / max(1, len(spelled)))]
    plain = np.fromiter(ordinary.values(), np.float64, len(ordinary))
    other = np.r_[plain * (cost.sum() / plain.sum()), np.fromiter(hard.values(), np.float64, len(hard))]
    y = np.r_[np.ones(len(cost)), -np.ones(len(other))]
    solved = least_loss(np.hstack([x, np.ones((len(x), 1), np.float32)]), y, np.r_[cost, other] / cost.sum(), params)
    return ToxicModel((lift @ solved[:-1]).astype(np.float32), float(solved[-1]), 1.0, 0.0, params)


def foremost(sentences: DataFrame, model: ToxicModel, above: float | None = None) -> DataFrame:
    """page, margin of the foremost word of each page, or page, word of every word beyond a margin."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(page, w) for page, s in zip(batch["page"], batch["sentence"]) for w in set(s.split(" "))]
            part = pd.DataFrame(rows, columns=["page", "word"])
            if len(part):
                at, distinct = pd.factorize(part["word"])
                part["margin"] = model.margins(list(distinct))[at]
                yield part[part["margin"] > (LOWEST if above is None else above)]

    words = sentences.mapInPandas(run, "page long, word string, margin float")
    return words.groupBy("page").agg(F.max("margin").alias("margin")) if above is None else words.select("page", "word").distinct()


def selected(words: DataFrame, toxic: DataFrame, clean: DataFrame, model: ToxicModel, params: ToxicParams) -> dict[str, float]:
    """The words the machine finds in toxic pages beyond what it finds in most clean ones, with the pages that explains.

    The border is the margin that ``clean_share`` of the clean pages reach; a word counts the toxic
    pages that hold it less those to be expected from the clean ones.
    """
    margins = foremost(clean, model).select("margin").toPandas()["margin"]  # at most sample_documents numbers
    border = float(np.quantile(margins, 1 - params.clean_share)) if len(margins) else 0.0
    pages = {name: max(1, df.select("page").distinct().count()) for name, df in (("toxic", toxic), ("clean", clean))}
    found = foremost(toxic, model, border).groupBy("word").agg(F.count("*").alias("n")).join(words, "word", "left")
    excess = F.col("n") - F.coalesce("good", F.lit(0)) * (pages["toxic"] / pages["clean"])
    # a few words of each of sample_documents pages
    return {r["word"]: float(r["x"]) for r in found.select("word", excess.alias("x")).where("x > 0").orderBy("word").collect()}


def machine(words: DataFrame, toxic: DataFrame, clean: DataFrame, params: ToxicParams) -> ToxicModel | None:
    """The machine from the words of sentences (word, bad, good: pages that hold it) and the sentences of either side."""
    held = words.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    if not held["bad"] or not held["good"]:
        return None
    share = held["bad"] / (held["bad"] + held["good"])
    # to start with: words that stand in more toxic pages than chance explains; most words of a page stand in no other one
    tested = words.where(F.col("bad") + F.col("good") > 1)
    # twice the odds of the sample, a bound that words of toxic pages can pass whatever their share of it
    often = tested.where((F.col("bad") > 1) & (F.col("bad") * (1 - share) > 2 * share * F.col("good")))
    seen = often.orderBy(F.desc("bad"), F.xxhash64("word"), "word").limit(params.examples).select("word", "bad", "good").toPandas()
    bad, pages = seen["bad"].to_numpy(np.int64), (seen["bad"] + seen["good"]).to_numpy(np.int64)
    first = beyond_chance(seen["word"].tolist(), bad, pages, tested.count(), share, params)
    drawn = words.where("good > 0").orderBy(F.xxhash64("word"), "word").limit(params.sample_words).select("word", "good").collect()
    common = words.where("good > 0").orderBy(F.desc("good"), "word").limit(params.ordinary).select("word", "good").collect()
    if not first or not drawn:
        return None
    known = dict(zip(seen["word"], bad - share * pages))
    positive = sure = {w: float(known[w]) for w in first}
    ordinary = {r["word"]: 1.0 + np.log(r["good"]) for r in [*drawn, *common]}
    basis = list(positive)[:params.basis]
    lift = nystroem([*basis, *[r["word"] for r in common]], params)
    model, hard = fit(positive, ordinary, {}, lift, params), {}
    for _ in range(params.selections):
        # all ordinary words of the sample are judged; the likeliest mistakes join the training and the basis
        worst = (words.where("good > 0").mapInPandas(lambda batches: judged(batches, model), "word string, good long, margin float")
                 .orderBy(F.desc("margin"), "word").limit(params.hard_words).collect())
        hard |= {r["word"]: float(r["good"]) for r in worst}
        positive = selected(words, toxic, clean, model, params) | sure
        lift = nystroem([*basis, *[r["word"] for r in worst[:params.hard_basis]], *[r["word"] for r in common]], params)
        model = fit(positive, ordinary, hard, lift, params)
    return model


def judged(batches: Iterator[pd.DataFrame], model: ToxicModel) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch[["word", "good"]].assign(margin=model.margins(batch["word"].tolist()))


def calibrated(margins: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a word's probability, under which a text is toxic when any of its words is.

    The likeliest pair on a grid, from the greatest margins of texts (one row each), beside a share
    of texts that are marked toxic whatever their words; slope 0 when it explains the labels no better than
    their share does.
    """
    # as if five more texts had been seen that are toxic by a single sure word, and five without one
    alone = np.full((2, margins.shape[1]), LOWEST)
    alone[:, 0] = 1.0, -0.5
    x, toxic, weight = np.minimum(np.vstack([margins, alone]), 1.0), np.r_[toxic, 1.0, 0.0], np.r_[weight, 5.0, 5.0]
    share = np.clip((weight * toxic).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    least, best = -(weight * np.where(toxic > 0, np.log(share), np.log(1 - share))).sum() * 0.98, (0.0, 0.0)
    for slope in np.geomspace(2.0, 40.0, 16):
        for shift in np.linspace(-0.5, 1.5, 41):
            clean = -np.logaddexp(0.0, slope * (x - shift)).sum(axis=1)  # logarithm of the probability
            for besides in (0.0, 0.01, 0.02, 0.04, 0.08, 0.16):
                none = clean + np.log1p(-besides)
                loss = -(weight * np.where(toxic > 0, np.log(np.maximum(-np.expm1(none), 1e-9)), none)).sum()
                if loss < least:
                    least, best = loss, (float(slope), float(shift))
    return best


def train(docs: DataFrame, labels: DataFrame, learn: Column, params: ToxicParams = ToxicParams()) -> ToxicModel:
    """Fit on the labelled documents for which ``learn`` (over doc_id) holds.  Only bounded lists of words and margins reach the driver."""
    nothing = ToxicModel(np.zeros(params.slots, np.float32), -1.0, 0.0, 0.0, params)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(s, toxic, page) for text, toxic, page in zip(batch["text"], batch["toxic"], batch["page"])
                    for s in dict.fromkeys(" ".join(plain_words(part)) for part in SENTENCE.split(text)) if s]
            yield pd.DataFrame(rows, columns=["sentence", "toxic", "page"])

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(w, toxic, page) for s, toxic, page in zip(batch["sentence"], batch["toxic"], batch["page"]) for w in set(s.split(" "))]
            yield pd.DataFrame(rows, columns=["word", "toxic", "page"])

    chosen = staged(training_documents(docs, labels, learn, params), "labelled")
    # a sentence of copies belongs to one page, and is clean when any clean document holds it
    sentences = staged(chosen.mapInPandas(split, "sentence string, toxic int, page long").groupBy("sentence").agg(
        F.min("toxic").alias("toxic"), F.min("page").alias("page")), "sentences")
    counts = staged(sentences.mapInPandas(spread, "word string, toxic int, page long").distinct(), "words")

    def trained(kept: Column) -> ToxicModel | None:
        words = staged(counts.where(kept).groupBy("word").agg(
            F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good")), "word-counts")
        return machine(words, *[sentences.where(kept & (F.col("toxic") == k)) for k in (1, 0)], params)

    aside = F.pmod(F.xxhash64("page"), F.lit(3)) == 0
    probe = trained(~aside)
    if probe is None:
        return nothing

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            top = []
            for text in batch["text"]:
                words = list(set(plain_words(text)))
                found = np.sort(probe.margins(words))[::-1][:params.foremost] if words else np.empty(0)
                top.append(np.r_[found, np.full(params.foremost - len(found), LOWEST)])
            yield batch[["toxic", "weight"]].assign(margins=top)

    # copies of a text are one document put aside; a few margins of at most two times sample_documents
    seen = (chosen.where(aside).groupBy("page").agg(F.min("toxic").alias("toxic"), F.min("text").alias("text"), F.max("weight").alias("weight"))
            .mapInPandas(weigh, "toxic int, weight double, margins array<double>").toPandas())
    if seen["toxic"].nunique() < 2:
        return nothing
    slope, shift = calibrated(np.stack(seen["margins"].to_list()), seen["toxic"].to_numpy(np.float64), seen["weight"].to_numpy(np.float64))
    model = trained(F.lit(True))
    return replace(model, slope=slope, shift=shift) if model is not None and slope > 0 else nothing


def score(docs: DataFrame, model: ToxicModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = shared_memo(model)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                cut = [raw_words(t) if t else [] for t in part["body"]]
                known = memo.holding(set().union(*cut)).__getitem__
                scores = [model.text_score(np.fromiter(map(known, set(w)), np.float32)) for w in cut]
                yield pd.DataFrame({"doc_id": part["id"], "score": scores})

    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("body"))
    return source.mapInPandas(run, "doc_id long, score double")


def sentence_scores(text: str, model: ToxicModel) -> list[tuple[str, float]]:
    """The sentences of a text with their scores."""
    out = []
    for part in SENTENCE.split(text):
        words = plain_words(part)
        if words:
            out.append((part, model.text_score(model.margins(list(set(words))))))
    return out
