"""Pluggable relevance scoring."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink.functions import text
from recordlink.functions.bind import let

Scorer = Callable[[Column], Column]


def keyword_scorer(weights: dict[str, tuple[str, float]]) -> Scorer:
    """Score = sum of the weights of the distinct known words in the text, at most 1; themes by weight."""
    themes = sorted({theme for theme, _ in weights.values()})

    def score(body: Column) -> Column:
        return let(F.array_distinct(text.clean_words(body)), score_words)

    def score_words(words: Column) -> Column:
        def weight(theme: str | None) -> Column:
            parts = [
                F.when(F.array_contains(words, w), F.lit(Decimal(str(x))).cast("decimal(9,4)")).otherwise(F.lit(0).cast("decimal(9,4)"))
                for w, (t, x) in weights.items()
                if theme is None or t == theme
            ]
            total = parts[0]
            for p in parts[1:]:
                total = total + p
            return total.cast("decimal(18,4)")

        scored = F.array(*[F.struct((-weight(t)).alias("w"), F.lit(t).alias("t")) for t in themes])
        present = F.array_sort(F.filter(scored, lambda s: s["w"] < 0))
        return F.struct(
            F.least(weight(None), F.lit(Decimal(1)).cast("decimal(18,4)")).cast("double").alias("score"),
            F.transform(present, lambda s: s["t"]).alias("themes"),
        )

    return score


def score_with(df: DataFrame, body: str, scorer: Scorer) -> DataFrame:
    """Add `score` and `themes`; the scorer maps a column to struct<score double, themes array<string>>.

    A pandas UDF with that return type fits as well as a plain expression.
    """
    return df.withColumn("__s", scorer(F.col(body))).withColumn("score", F.col("__s.score")).withColumn("themes", F.col("__s.themes")).drop("__s")
