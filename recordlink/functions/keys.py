"""Expressions over dotted group keys, package ids and codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FALLBACK_PREFIX = "govinfo"


def group_of_key(key: Column, fallback: str = FALLBACK_PREFIX) -> Column:
    """First part of a dotted key; for a fallback key the second part."""
    first = F.split_part(key, F.lit("."), F.lit(1))
    second = F.nullif(F.split_part(key, F.lit("."), F.lit(2)), F.lit(""))
    return F.when(first == fallback, F.coalesce(second, F.lit("unknown"))).otherwise(first)


def group_of_package(package_id: Column) -> Column:
    """Group named by a package id, `unknown` when it names none."""
    low = F.lower(package_id)
    return F.when(low.contains("hhrg"), "house").when(low.contains("shrg"), "senate").otherwise("unknown")


def parent_code(code: Column) -> Column:
    """Code of the parent unit: first four characters and `00`."""
    return F.concat(F.substring(code, 1, 4), F.lit("00"))


def stream_name(df: DataFrame, code: str, group: str, date: str, existing: str, only_group: str = "senate") -> DataFrame:
    """Add `stream_comm` and `stream_file` (`{code}{MMDDYY}`) where they can be derived and are not set yet."""
    old = F.nullif(F.col(existing), F.lit(""))
    derivable = old.isNull() & F.nullif(F.col(code), F.lit("")).isNotNull() & (F.col(group) == only_group) & F.col(date).isNotNull()
    return df.withColumn("stream_comm", F.when(derivable, F.col(code)).otherwise(old)).withColumn(
        "stream_file", F.when(derivable, F.concat(F.col(code), F.date_format(date, "MMddyy")))
    )
