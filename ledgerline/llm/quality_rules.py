"""Quality rules: a threshold table compiled into Spark projections, with built-in functions only.

Nulls count as empty texts. A text without words has zero counts and fails the base rule. Rows are
judged one by one, so ties, repeated rows and other columns do not matter; an empty table stays empty.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BREAKS, WORD_BREAK


class Rule(NamedTuple):
    """A document passes when ``low <= numerator / denominator <= high``."""

    name: str
    numerator: str
    denominator: str
    low: float
    high: float


# frequent function words of English, German, French and Spanish
STOP_WORDS = (
    "the of and to in is that for it with was as be by on are this from at or an a "
    "der die das und in zu den von ist mit des auf für dem nicht ein eine sich auch "
    "de la le et les des en un une du que est pour dans qui par pas au sur ce "
    "el los y del las por con para su al lo como más se no una"
).split()

RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 20.0),
    Rule("symbols_per_word", "n_symbols", "n_words", 0.0, 0.25),
    Rule("shouts_per_word", "n_shouts", "n_words", 0.0, 0.5),
    Rule("stop_word_share", "n_stop_words", "n_words", 0.005, 1.0),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", 0.0, 0.5),
    Rule("repeated_word_share", "n_repeat_words", "n_words", 0.0, 0.5),
)


def repeated_words(words: Column) -> Column:
    """Words inside a three-word window that occurs twice or more, the first time included.

    Windows become (64-bit hash, position), sorted so that equal ones are neighbours; n log n per text.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        return F.sort_array(
            F.transform(
                F.slice(h, 1, F.size(h) - 2),
                lambda x, i: F.struct(
                    F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)).alias("h"), i.alias("i")
                ),
            )
        )

    def covered(s: Column) -> Column:
        hit = F.filter(
            s,
            lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]),
        )
        return F.size(
            F.array_distinct(
                F.flatten(F.transform(hit, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
            )
        ).cast("long")

    def bound(value: Column, body) -> Column:
        """Evaluate ``value`` once and use it several times in ``body``."""
        return F.transform(F.array(value), body)[0]

    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(
        bound(hashes, lambda h: bound(windows(h), covered))
    )


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts the rules use; names of the input that clash are replaced."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.col("_words")
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    stops = sorted(set(STOP_WORDS))
    return (
        docs.withColumn("_trimmed", F.btrim(body, F.lit(BREAKS)))
        .withColumn(
            "_words",
            F.when(F.col("_trimmed") == "", F.array().cast("array<string>")).otherwise(
                F.split("_trimmed", WORD_BREAK, -1)
            ),
        )
        .withColumn("_lines", lines)
        .withColumns(
            {
                "n_words": F.size(words).cast("long"),
                "word_chars": F.length(F.array_join(words, "")).cast("long"),
                "n_symbols": (F.size(F.split(body, "[#*$%&|<>]", -1)) - 1).cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": repeated_words(words),
                "n_lines": F.size("_lines").cast("long"),
                "n_shouts": (F.size(F.split(body, "!", -1)) - 1).cast("long"),
                "n_stop_words": F.size(
                    F.filter(words, lambda w: F.lower(w).isin(stops))
                ).cast("long"),
            }
        )
        .drop("_trimmed", "_words", "_lines")
    )


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules in one expression; an empty denominator counts as ratio zero."""

    def passes(rule: Rule) -> Column:
        ratio = F.coalesce(
            F.try_divide(F.col(rule.numerator).cast("double"), F.col(rule.denominator)), F.lit(0.0)
        )
        return (ratio >= rule.low) & (ratio <= rule.high)

    return reduce(lambda a, b: a & b, [passes(rule) for rule in rules], F.lit(True))


def quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every row of ``docs``, with all its other columns."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        measures(docs, text)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & verdict(rules))
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """Only rows that pass, with the columns of ``docs`` alone."""
    marked = docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    judged = quality(marked.select("_row", F.col(f"`{text}`").alias("_text")), "_text")
    # a plain filter would be pushed below the counts and compute them again for every rule
    row = F.explode_outer(F.when(F.col("kept"), F.array("_row"))).alias("_row")
    return judged.select(row).where("_row is not null").select("_row.*")
