"""Toxicity by a weighted lexicon, matched in folded text."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import written

# Letters of other scripts that look like a Latin one.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i",
    "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t",
    "ѵ": "v", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ſ": "s",
}
# Digits and signs that stand for a letter inside a word.
SUBSTITUTES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i",
}
# Phrases in which a lexicon word is harmless, besides those that are learned.
EXCEPTIONS = ("trash can", "trash bin", "pond scum", "clown fish", "class clown", "loser bracket")

PREFIX_CHARS = range(3, 9)
LEXICON_SIZE = 20_000
CANDIDATES = 200_000
# Learned phrases of a lexicon word and a neighbour: as many at most.
PHRASES = 10_000
# A model is learned from about so many labelled rows at most.
LEARNED_ROWS = 50_000

_SUSPECT = re.compile(r"[013457@$!][^\W\d_]")
_INNER = re.compile(
    r"(?<=[^\W\d_])[013457@$!]+(?=[^\W\d_])|(?<![\w@$!])[013457@$!](?=[^\W\d_])"
)
_SUBSTITUTE = str.maketrans(SUBSTITUTES)
_INVISIBLE = {0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF}


class _Folded(dict):
    """Code point to its folded form, filled as characters are met."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        if 0xFF21 <= code <= 0xFF5A:  # full-width letters
            char = chr(code - 0xFEE0)
        char = char.lower()
        char = HOMOGLYPHS.get(char, char)
        self[code] = "" if code in _INVISIBLE else char if char.isalpha() else " "
        return self[code]


_FOLDED = _Folded()


def fold(text: str | None) -> list[str]:
    """The words of a text: letters only, lower case, look-alikes replaced.

    A digit or sign is read as a letter between two letters, or as the one
    character before a word's first letter.
    """
    text = text or ""
    if _SUSPECT.search(text):
        text = _INNER.sub(lambda found: found[0].translate(_SUBSTITUTE), text)
    return text.translate(_FOLDED).split()


@dataclass(frozen=True)
class Model:
    """Word beginnings with weights, harmless phrases, and the logistic curve."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    slope: float
    intercept: float


class Matcher:
    """The automaton of a model: beginnings and phrases, each after a space."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...]) -> None:
        entries: dict[str, tuple[float, bool]] = {}
        for prefix, weight in weights.items():
            entries[f" {prefix}"] = (weight, False)
        for phrase in exceptions:
            entries[f" {phrase} "] = (entries.get(f" {phrase} ", (0.0,))[0], True)
        self.search = ahocorasick.Automaton()
        for entry, (weight, harmless) in entries.items():
            self.search.add_word(entry, (weight, len(entry), harmless))
        self.filled = bool(entries)
        if entries:
            self.search.make_automaton()

    def hits(self, words: list[str]) -> dict[int, float]:
        """By place of a word in the joined text its largest weight, exceptions left out."""
        if not self.filled or not words:
            return {}
        found: dict[int, float] = {}
        harmless: list[tuple[int, int]] = []
        for end, (weight, size, excepted) in self.search.iter(" " + " ".join(words) + " "):
            start = end - size + 1
            if excepted:
                harmless.append((start, end))
            elif weight > found.get(start, 0.0):
                found[start] = weight
        for a, b in harmless:
            for at in [x for x in found if a <= x < b]:
                del found[at]
        return found

    def strength(self, text: str | None) -> float:
        """Total weight of the hits, toned down slowly as the text grows."""
        words = fold(text)
        return sum(self.hits(words).values()) / (1.0 + math.log1p(len(words) / 100.0))


def held_out(doc_id: Column) -> Column:
    """One in five ids, kept from learning; a null id counts as an empty one, which is."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def _beginnings(rows: DataFrame, wanted: frozenset[str] | None = None) -> DataFrame:
    """prefix, n0 and n1: in how many documents of either half a word begins so.

    With `wanted`, only for the beginnings in it. A task adds up its own documents
    before anything moves.
    """
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, asked = (Counter(), Counter()), shared.value

        def found() -> pd.DataFrame:
            keys = [*counts[0], *counts[1]]
            frame = pd.DataFrame(
                {
                    "prefix": pd.Series(keys, dtype=object),
                    "half": [0] * len(counts[0]) + [1] * len(counts[1]),
                    "n": [*counts[0].values(), *counts[1].values()],
                }
            )
            counts[0].clear(), counts[1].clear()
            return frame

        for frame in frames:
            for text, half in zip(frame["text"], frame["half"], strict=True):
                words = set(fold(text))
                starts = {w[:k] for k in PREFIX_CHARS for w in words if k <= len(w)}
                counts[half].update(starts if asked is None else starts & asked)
                if len(counts[0]) + len(counts[1]) > 400_000:
                    yield found()
        yield found()

    return (
        rows.mapInPandas(tally, "prefix string, half int, n bigint")
        .groupBy("prefix")
        .agg(*[F.sum(F.when(F.col("half") == h, F.col("n")).otherwise(0)).alias(f"n{h}") for h in (0, 1)])
    )


def _phrases(rows: DataFrame, weights: dict[str, float]) -> DataFrame:
    """phrase, and in how many documents it occurs by half and label: n00, n01, n10, n11.

    A phrase is a word that the lexicon hits with the word before or after it. A task
    adds up its own documents before anything moves.
    """
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher, counts = Matcher(shared.value, ()), Counter()

        def found() -> pd.DataFrame:
            keys = pd.DataFrame(list(counts), columns=["phrase", "half", "toxic"])
            keys["n"] = list(counts.values())
            counts.clear()
            return keys

        for frame in frames:
            for text, half, toxic in zip(frame["text"], frame["half"], frame["toxic"], strict=True):
                words = fold(text)
                hits, at = matcher.hits(words), 0
                phrases = set()
                for n, word in enumerate(words):
                    if at in hits:
                        phrases.update(f"{a} {b}" for a, b in zip(words[max(n - 1, 0) : n + 1], words[max(n, 1) : n + 2], strict=False))
                    at += len(word) + 1
                counts.update((phrase, half, toxic) for phrase in phrases)
                if len(counts) > 400_000:
                    yield found()
        yield found()

    return (
        rows.mapInPandas(tally, "phrase string, half int, toxic int, n bigint")
        .groupBy("phrase")
        .agg(
            *[
                F.sum(F.when((F.col("half") == h) & (F.col("toxic") == t), F.col("n")).otherwise(0)).alias(f"n{h}{t}")
                for h in (0, 1) for t in (0, 1)
            ]
        )
    )


def harmless_phrases(rows: DataFrame, weights: dict[str, float], others: int, toxic: int) -> tuple[str, ...]:
    """Phrases in which a lexicon word speaks against toxicity, in either half of the rows.

    That is, at most a quarter as frequent in toxic documents as in the others. The
    `PHRASES` that most documents have, which bounds the model.
    """
    least = max(2, math.ceil(0.0005 * others))
    speaks_against = [
        (F.col(f"n{h}0") >= least) & (4 * F.col(f"n{h}1") * (others + 1) <= F.col(f"n{h}0") * (toxic + 1))
        for h in (0, 1)
    ]
    chosen = (
        _phrases(rows, weights)
        .where(speaks_against[0] & speaks_against[1])
        .orderBy(F.desc(F.col("n00") + F.col("n10")), "phrase")
        .limit(PHRASES)
    )
    return tuple(r["phrase"] for r in chosen.collect())


def _logistic(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and intercept fitted to (strength, others, toxic) by damped Newton steps."""
    if not bins:
        return 1.0, -3.0
    x, n0, n1 = (np.array(column, dtype=float) for column in zip(*bins, strict=True))
    total, beta = n0 + n1, np.zeros(2)
    features = np.stack([x, np.ones_like(x)], axis=1)
    ridge = np.diag([1e-2, 1e-3])
    for _ in range(60):
        p = 1.0 / (1.0 + np.exp(-np.clip(features @ beta, -30, 30)))
        gradient = features.T @ (n1 - total * p) - ridge @ beta
        hessian = (features * (total * p * (1 - p))[:, None]).T @ features + ridge
        step = np.linalg.solve(hessian, gradient)
        beta += step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def learn(labelled: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """A model from the rows of `labelled`: doc_id, text and toxic (0 or 1).

    Entries are word beginnings. One is taken if it speaks for toxic documents in
    one half of the rows and does so again in the other, which it wasn't picked
    from. Its weight is its log-odds. The lexicon holds the `LEXICON_SIZE`
    heaviest entries at most, out of the `CANDIDATES` most frequent in toxic
    documents; that bounds the model, not the rows it is learned from. To the given
    exceptions come the phrases of `harmless_phrases`. Rows without
    a label are left out; without any, every score is low.
    """
    rows = written(
        labelled.where("toxic in (0, 1)").select(
            "text",
            F.col("toxic").cast("int").alias("toxic"),
            F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half"),
        ),
        "toxicity-rows",
    )
    known = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    others, toxic = known.get(0, 0), known.get(1, 0)
    least = max(2, math.ceil(0.002 * toxic))
    supported = (
        _beginnings(rows.where("toxic = 1"))
        .where((F.col("n0") + F.col("n1") >= 2 * least) & (F.least("n0", "n1") >= least - 1))
        .orderBy(F.desc(F.col("n0") + F.col("n1")), "prefix")
        .limit(CANDIDATES)
    )
    speaks_for = {r["prefix"]: (r["n0"], r["n1"]) for r in supported.collect()}
    elsewhere = _beginnings(rows.where("toxic = 0"), frozenset(speaks_for))
    against = {r["prefix"]: (r["n0"], r["n1"]) for r in elsewhere.collect()}
    weights = {}
    for prefix, pro in speaks_for.items():
        con = against.get(prefix, (0, 0))
        if all(p >= 4 * c for p, c in zip(pro, con, strict=True)):
            odds = (sum(pro) + 0.5) / (toxic + 1.0) / ((sum(con) + 0.5) / (others + 1.0))
            if odds > math.e:
                weights[prefix] = math.log(odds)
    heaviest = sorted(weights, key=lambda prefix: (-weights[prefix], prefix))[:LEXICON_SIZE]
    weights = {prefix: weights[prefix] for prefix in heaviest}
    exceptions = (*exceptions, *harmless_phrases(rows, weights, others, toxic))
    strengths = _strengths(rows, Model(weights, exceptions, 1.0, 0.0), "toxic")
    bins = (
        strengths.groupBy(F.floor(F.least(F.col("strength"), F.lit(100.0)) * 20).alias("bin"))
        .agg(
            F.avg("strength").alias("x"),
            F.count_if(F.col("toxic") == 0).alias("others"),
            F.count_if(F.col("toxic") == 1).alias("toxic"),
        )
        .orderBy("bin")
        .collect()
    )
    slope, intercept = _logistic([(r["x"], r["others"], r["toxic"]) for r in bins])
    return Model(weights, exceptions, slope, intercept)


def _strengths(docs: DataFrame, model: Model, *columns: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.exceptions))
    ready: list[Matcher] = []

    @F.pandas_udf("double")
    def strength(texts: pd.Series) -> pd.Series:
        if not ready:
            ready.append(Matcher(*shared.value))
        return pd.Series([ready[0].strength(text) for text in texts], dtype=float)

    return docs.select(*columns, strength("text").alias("strength"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted.

    The score depends on the text alone. Null and empty texts, and such without a
    letter, have the score of no hit. Repeated rows get a row each.
    """
    value = 1.0 / (1.0 + F.exp(-(F.col("strength") * model.slope + model.intercept)))
    return (
        _strengths(docs, model, "doc_id")
        .withColumn("score", value)
        .select(
            "doc_id",
            held_out(F.col("doc_id")).alias("held_out"),
            "score",
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
        )
    )


def training_rows(
    docs: DataFrame, labels: DataFrame, most_rows: int = LEARNED_ROWS
) -> DataFrame:
    """The labelled documents that may be learned from, about `most_rows` at most.

    Above that a pseudo-random share of the labelled ids is taken. A label given twice
    counts once; ids that have both labels, or none that is 0 or 1, teach nothing.
    """
    usable = (
        labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
        .where("toxic = other")
        .drop("other")
    )
    share = most_rows / max(usable.count(), most_rows)
    chosen = usable.where(F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    # Broadcast: the labels chosen are no more than `most_rows`, or nearly so.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
