"""Top-k, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions import dates


def staleness(df: DataFrame, ts: str, as_of: str, max_age_days: int) -> DataFrame:
    """Add `age_days` (NULL = never) and `is_stale`."""
    return df.withColumn("age_days", dates.age_days(F.col(ts), as_of)).withColumn("is_stale", F.col("age_days") >= max_age_days)


def top_quotes(df: DataFrame, score: str | None, tie: list[str], threshold: float = fv.SCORE_THRESHOLD, n: int = fv.MAX_QUOTES) -> DataFrame:
    """The n best rows at or above the threshold; without a score the first n in order."""
    if score is None:
        return df.orderBy(*tie).limit(n)
    return df.filter(F.col(score) >= threshold).orderBy(F.col(score).desc(), *tie).limit(n)


def claimable(queue: DataFrame, as_of: str, n: int, available_at: str, tie: list[str], status: str = "status") -> DataFrame:
    """Pending rows that may run now, oldest first, at most n (rows without a time come first)."""
    due = F.col(available_at).isNull() | (F.col(available_at) <= F.lit(as_of).cast("timestamp_ntz"))
    return queue.filter((F.col(status) == "pending") & due).orderBy(F.col(available_at).asc_nulls_first(), *tie).limit(n)


def failing_list(streaks: DataFrame, threshold: int = 3, streak: str = "streak") -> DataFrame:
    """Keys whose failure streak reached the threshold, longest first."""
    return streaks.filter(F.col(streak) >= threshold).orderBy(F.col(streak).desc())


def dead_letter_list(dead: DataFrame, n: int = 100, item_type: str | None = None) -> DataFrame:
    """Unresolved dead letters, latest failure first."""
    open_items = dead.filter(F.col("resolved_at").isNull())
    if item_type is not None:
        open_items = open_items.filter(F.col("item_type") == item_type)
    return open_items.orderBy(F.col("last_failed_at").desc(), "item_type", "item_key").limit(n)


def authority_order(df: DataFrame, authority: str, ord_col: str) -> DataFrame:
    """Highest authority first, then the given unique order."""
    return df.orderBy(F.col(authority).desc(), F.col(ord_col))


def unprocessed_list(df: DataFrame, processed_at: str, date: str, json_col: str, json_type: str = "map<string,string>") -> DataFrame:
    """Rows never processed, newest first, with their JSON column parsed."""
    return (
        df.filter(F.col(processed_at).isNull())
        .withColumn(json_col, F.from_json(json_col, json_type))
        .orderBy(F.col(date).desc())
    )


def union_sources(*dfs: DataFrame) -> DataFrame:
    """Bag union of record sets that need not have the same columns."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def union_precedence(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """All rows of a, then the rows of b whose key a does not have; `precedence` keeps the order."""
    rest = b.join(a.select(key).distinct(), key, "left_anti")
    return a.withColumn("precedence", F.lit(0)).unionByName(rest.withColumn("precedence", F.lit(1)), allowMissingColumns=True)


def token_set_ops(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """(common, all, only in a) of two token arrays, sorted."""
    return F.array_sort(F.array_intersect(a, b)), F.array_sort(F.array_union(a, b)), F.array_sort(F.array_except(a, b))


def registry_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two registries has."""
    left, right = a.select(key), b.select(key)
    only_a = left.subtract(right).withColumn("missing_in", F.lit("b"))
    return only_a.unionByName(right.subtract(left).withColumn("missing_in", F.lit("a")))
