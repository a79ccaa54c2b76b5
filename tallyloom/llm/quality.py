"""Quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import written
from tallyloom.llm.text import words_of

# Words over which the variety rule counts distinct ones.
VARIETY_WORDS = 1000


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, also inside lambdas of the body."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, the first included.

    A text whose window hashes are all distinct has none. Otherwise a window is its
    hash, its words and its place: sorted, equal windows are neighbours at any length
    of text. A repeated window covers its three words, less what the one before has
    covered already. The work is that of a sort, also for a text that repeats itself
    throughout.
    """

    def hashes(bound: Column) -> Column:
        return F.transform(
            F.slice(bound, 1, F.greatest(F.size(bound) - 2, F.lit(0))),
            lambda word, i: F.xxhash64(word, F.get(bound, i + 1), F.get(bound, i + 2)),
        )

    def windows(bound: Column, hashed: Column) -> Column:
        return F.transform(
            hashed,
            lambda window, i: F.struct(
                window.alias("hash"),
                *[F.get(bound, i + k).alias(f"word{k}") for k in range(3)],
                i.alias("at"),
            ),
        )

    def places_in(ordered: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            equal = x["hash"] == y["hash"]
            for k in range(3):
                equal = equal & (x[f"word{k}"] == y[f"word{k}"])
            return equal

        pairs = F.zip_with(
            F.slice(ordered, 1, F.greatest(F.size(ordered) - 1, F.lit(0))),
            F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0))),
            lambda x, y: F.when(same(x, y), F.array(x["at"], y["at"])),
        )
        return F.sort_array(F.flatten(F.filter(pairs, lambda pair: pair.isNotNull())))

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.transform(
                places,
                lambda at, i: F.least(F.lit(3), F.coalesce(at - F.get(places, i - 1), F.lit(3))),
            ),
            F.lit(0),
            lambda total, words: total + words,
        )

    def counted(bound: Column):
        return lambda hashed: F.when(
            F.size(F.array_distinct(hashed)) == F.size(hashed), F.lit(0)
        ).otherwise(let(let(F.sort_array(windows(bound, hashed)), places_in), covered))

    return let(words, lambda bound: let(hashes(bound), counted(bound))).cast("bigint")


def _counted(text: Column, pattern: str) -> Column:
    """Characters that match; the pattern must match one character each."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The base measures of a text that isn't null, and its words."""
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": _counted(text, r"[#*$%&|<>]").cast("bigint"),
        "n_dup_lines": let(
            lines_with_words(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))
        ).cast("bigint"),
        "n_repeat_words": repeated_words(words),
    }


def base_rules(m: Mapping[str, Column]) -> dict[str, Column]:
    """True where a document fails."""
    return {
        "few_words": m["n_words"] < 50,
        "repeated_words": 100 * m["n_repeat_words"] > 50 * m["n_words"],
    }


def further_rules(m: Mapping[str, Column], text: Column, words: Column) -> dict[str, Column]:
    """True where a document fails. Whole-number conditions, the same in any engine."""
    return {
        # less than 2 or more than 15 characters in the mean word
        "word_length": (m["word_chars"] < 2 * m["n_words"])
        | (m["word_chars"] > 15 * m["n_words"]),
        # a symbol for every two words
        "symbols": 2 * m["n_symbols"] > m["n_words"],
        # three lines in ten are repeats
        "repeated_lines": 10 * m["n_dup_lines"] > 3 * F.size(lines_with_words(text)),
        # half of what stands in words is capitals
        "capitals": 2 * _counted(text, r"\p{Lu}") > m["word_chars"],
        # fewer than six words in ten have a letter
        "letters": 10 * F.size(F.filter(words, lambda word: word.rlike(r"\p{L}")))
        < 6 * m["n_words"],
        # fewer than one word in twenty is new, stretch by stretch
        "variety": little_variety(words),
    }


def cascade_order(
    docs: DataFrame,
    rules: Callable[[Column, Column], Mapping[str, Column]],
    sample_rows: int = 2000,
    seed: int = 3,
) -> list[str]:
    """The rules by what they reject per second, both measured on a sample.

    The sample, about `sample_rows` documents, is written once with its words, and
    every rule is timed over it. It decides about order only, never about a
    document: any order gives the same verdicts.
    """
    share = min(1.0, sample_rows / max(docs.count(), 1))
    text = F.coalesce("text", F.lit(""))
    sample = written(
        docs.sample(share, seed).select(text.alias("text"), words_of(text).alias("words")),
        "quality-sample",
    )
    sample.agg(F.max(F.length("text")), F.max(F.size("words"))).collect()
    gain = {}
    for name, fails in rules(F.col("text"), F.col("words")).items():
        began = time.perf_counter()
        rejected = sample.agg(F.count_if(fails)).collect()[0][0]
        gain[name] = rejected / max(time.perf_counter() - began, 1e-6)
    return sorted(gain, key=lambda name: -gain[name])


def first_failure(rules: Mapping[str, Column], order: list[str]) -> Column:
    """The first rule in order that rejects; later ones aren't computed. Null: kept."""
    verdict = F.lit(None).cast("string")
    for name in reversed(order):
        verdict = F.when(rules[name], F.lit(name)).otherwise(verdict)
    return verdict


def little_variety(words: Column, length: int = VARIETY_WORDS) -> Column:
    """Whether fewer than one word in twenty is new within its stretch of `length` words.

    The share of distinct words falls with the length of any text; over stretches it
    doesn't, so that length alone rejects nothing.
    """
    last = F.floor(F.greatest(F.size(words) - 1, F.lit(0)) / length).cast("int")
    distinct = F.aggregate(
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.size(F.array_distinct(F.slice(words, i * length + 1, length))),
        ),
        F.lit(0),
        lambda total, n: total + n,
    )
    return 20 * distinct.cast("bigint") < F.size(words)


def _all_rules(text: Column, words: Column) -> dict[str, Column]:
    m = measures(text, words)
    return base_rules(m) | further_rules(m, text, words)


def _further_rules(text: Column, words: Column) -> dict[str, Column]:
    return further_rules(measures(text, words), text, words)


def passing(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """The documents that no rule, base or further, rejects. Columns as they came.

    The base rules take their place in the cascade like the others. A null text counts as
    empty and is rejected; an empty table stays empty.
    """
    order = cascade_order(docs, _all_rules, sample_rows)
    text = F.coalesce("text", F.lit(""))
    verdict = let(words_of(text), lambda words: first_failure(_all_rules(text, words), order))
    return docs.where(verdict.isNull())


def report(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """Per document: doc_id, the base measures, base_failed and kept.

    A document that fails the base isn't given to the cascade. Null text: no
    words. Repeated rows get a row each.
    """
    order = cascade_order(docs, _further_rules, sample_rows)
    text = F.coalesce("text", F.lit(""))

    def judged(words: Column) -> Column:
        found = measures(text, words)

        def verdict(bound: Column) -> Column:
            m = {name: bound[name] for name in found}
            failed = F.lit(False)
            for fails in base_rules(m).values():
                failed = failed | fails
            kept = F.when(failed, F.lit(False)).otherwise(
                first_failure(further_rules(m, text, words), order).isNull()
            )
            return F.struct(
                *[value.alias(name) for name, value in m.items()],
                failed.alias("base_failed"),
                kept.alias("kept"),
            )

        return let(F.struct(*[value.alias(name) for name, value in found.items()]), verdict)

    return docs.select("doc_id", let(words_of(text), judged).alias("q")).select("doc_id", "q.*")
