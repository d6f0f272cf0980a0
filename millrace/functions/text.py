"""Splitting phrases into words."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a word is a run of letters and digits.
NOT_A_WORD = r"[^\p{L}\p{N}]+"


def words(text: str | Column) -> Column:
    """Distinct words of one phrase, lower case; a word counts once per phrase."""
    text = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.lower(text), NOT_A_WORD)
    return F.array_distinct(F.filter(parts, lambda w: w != ""))


def segmenter(split: Callable[[str], Iterable[str]]) -> Callable[[Column], Column]:
    """Wrap a word segmenter (for text without blanks) for use in place of ``words``.

    Phrases reach it in Arrow batches; words are made distinct afterwards.
    """

    @F.pandas_udf("array<string>")
    def run(phrases: pd.Series) -> pd.Series:
        return phrases.map(lambda p: None if p is None else list(split(p)))

    return lambda text: F.array_distinct(run(text))


def explode_words(df: DataFrame, text: str, into: str = "keyword", split=words) -> DataFrame:
    """One row per distinct word; phrases without words give none."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.explode(split(F.col(text))).alias(into))


def explode_tokens(df: DataFrame, text: str = "value", sep: str = ",") -> DataFrame:
    """One ``(word, 1)`` row per separated token, repeats included."""
    return df.select(F.explode(F.split(text, sep)).alias("word"), F.lit(1).cast("bigint").alias("n"))


def word_count(df: DataFrame, text: str = "value", sep: str = ",") -> DataFrame:
    return explode_tokens(df, text, sep).groupBy("word").agg(F.sum("n").alias("n"))
