"""Word frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def words(lines: DataFrame) -> DataFrame:
    """Lower-cased words of more than one character (counted before lower-casing)."""
    return (
        lines.select(F.explode(F.split("value", r"\s+")).alias("word"))
        .where(F.length("word") > 1)
        .select(F.lower("word").alias("word"))
    )


def _counts(lines: DataFrame) -> DataFrame:
    return words(lines).groupBy("word").agg(F.count("word").alias("count"))


def word_count(lines: DataFrame) -> DataFrame:
    """``(word, count)``, most frequent first, ties in alphabetical order.

    Words are counted per task before the shuffle, so a word that makes up a
    third of the text still arrives as one row per task.  The tie-break is what
    lets the sort spread: about half of all distinct words occur once, and by
    count alone they would all fall into one range.
    """
    return _counts(lines).orderBy(F.desc_nulls_last("count"), "word")


def top_words(lines: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows of the word count."""
    return word_count(lines).limit(n)
