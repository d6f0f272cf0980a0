"""Mixing sources to target weights.

Every document gets a hash-random key; documents are ordered by it within their
source, word counts are summed up along that order, and each source is cut at
its exact budget. A budget above the source's size takes whole epochs first.

Defined cases: a null text counts no words; a null source is a source of its
own, ranked last; a document without words takes nothing; repeated rows are
separate documents, and of equal rows any may stand first (their results are
equal as a set); an empty table gives an empty mix.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import ASCII_SPACE, settle
from millrace.operators.scale import join_per_key, with_position

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SLICE_ROWS = 4096
SOURCE = ["_unnamed", "_source"]


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(ASCII_SPACE)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS
) -> DataFrame:
    """Target of every source: its part by weight of ``share`` times all sizes, at most ``epochs`` times its own.

    ``sizes`` has a row per source: the two source columns, ``source_size`` and
    ``n_docs``. What a capped source leaves is dealt to the others by weight.
    With a common level L each target is min(cap, weight * L); L rises until no
    further source is capped, which takes one small aggregate per step.
    """
    name = F.concat(F.when(F.col("_unnamed"), "1").otherwise("0"), F.col("_source"))
    ranked = with_position(sizes.withColumn("_name", name), [], ["_name"], into="_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = settle(
        ranked.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * float(epochs)), "sources"
    )
    budget = share * float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = F.col("_cap") <= F.col("_weight") * level
        taken, weight_left, now = ranked.agg(
            F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_weight"))), F.count(F.when(full, 1))
        ).first()
        if now == capped or not weight_left:
            break
        level, capped = max(0.0, budget - (taken or 0.0)) / weight_left, now
    target = F.least("_cap", F.col("_weight") * level)
    return ranked.select(*SOURCE, "source_size", "n_docs", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: float = EPOCHS,
    seed: int = 17,
    keep: Sequence[str] = (),
) -> DataFrame:
    """What the mix takes of every document: (doc_id, size, source_size, target, taken) and the ``keep`` columns.

    A source's order is cut into slices of about SLICE_ROWS keys, so a source
    that holds much of the corpus is summed by many tasks. Keys are uniform,
    hence so are the slices, and slice bounds depend on the key alone.
    """
    rows = docs.select(
        "doc_id",
        F.col("source").isNull().alias("_unnamed"),
        F.coalesce("source", F.lit("")).alias("_source"),
        word_count(F.col("text")).alias("size"),
        F.xxhash64("doc_id", F.lit(seed)).alias("_key"),
        *keep,
    )
    light = settle(rows.drop(*keep), "mix")
    sizes = light.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    targets = settle(source_targets(sizes, weights, share, epochs), "targets")
    place = F.floor((F.col("_key") / 2.0**64 + 0.5) * F.ceil(F.col("n_docs") / SLICE_ROWS))

    def placed(df: DataFrame) -> DataFrame:
        return join_per_key(df, targets, SOURCE).withColumn("_slice", place).drop("n_docs")

    # Kept columns may be whole texts: they are read again and moved once, with their slice.
    rows = placed(rows if keep else light)
    slices = placed(light).groupBy(*SOURCE, "_slice").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy(*SOURCE).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    within = Window.partitionBy(*SOURCE, "_slice").orderBy("_key", "doc_id", "size")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(slices, [*SOURCE, "_slice"]).withColumn(
        "_before", F.col("_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    )
    budget = F.floor("target")
    epoch = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epoch * F.col("source_size") - F.col("_before")
    taken = epoch * F.col("size") + F.greatest(F.lit(0), F.least("size", rest))
    return rows.select("doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"), *keep)


def _first_words(texts: pd.Series, counts: pd.Series) -> pd.Series:
    """The text up to the end of its n-th word."""
    word = re.compile(ASCII_SPACE)

    def cut(text: str | None, n: int) -> str | None:
        last = next(islice(word.finditer(text), n - 1, None), None) if text is not None else None
        return None if last is None else text[: last.end()]

    return pd.Series([cut(t, int(n)) for t, n in zip(texts, counts)], dtype=object)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is taken.

    A document that is cut keeps its first words, as many as its source's budget
    still had room for, and the white space between them.
    """
    drawn = mix(docs.withColumn("_row", F.struct(*[F.col(c).alias(c) for c in docs.columns])), keep=["_row"], **options)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0)
    part = F.col("taken") - whole * F.col("size")
    times = F.concat(
        F.array_repeat(F.lit(-1).cast("bigint"), whole.cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>"))
    )
    copies = drawn.select("_row", F.explode(times).alias("_words"))
    cut = F.pandas_udf(_first_words, "string")(F.when(F.col("_words") >= 0, F.col("_row.text")), "_words")
    text = F.when(F.col("_words") < 0, F.col("_row.text")).otherwise(cut)
    return copies.select(*[text.alias(c) if c == "text" else F.col(f"_row.{c}").alias(c) for c in docs.columns])
