"""Row filters and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions import dates, text


def tier_filter(df: DataFrame, tier: str, max_tier: int | None = None, key_col: str | None = None, key: str | None = None) -> DataFrame:
    """One key if given (an unknown key is an error), else rows up to a tier (default 2; missing tier counts as 3)."""
    if key is not None:
        chosen = df.filter(F.col(key_col) == key)
        if chosen.isEmpty():
            raise ValueError(f"unknown key: {key}")
        return chosen
    return df.filter(F.coalesce(F.col(tier), F.lit(3)) <= (2 if max_tier is None else max_tier))


def procedural_filter(df: DataFrame, title: str, has_video: Column, phrases: list[str] = fv.PROCEDURAL_PHRASES) -> DataFrame:
    """Drop procedural titles unless the row has a video."""
    return df.filter(~text.contains_any(F.col(title), phrases) | F.coalesce(has_video, F.lit(False)))


def route_clips(
    df: DataFrame, title: str, duration: str, phrases: list[str] = fv.CLIP_PHRASES, min_s: int = fv.MIN_RECORD_SECONDS
) -> tuple[DataFrame, DataFrame]:
    """(records, clips): clip phrases and short videos go to the second output."""
    clip = text.contains_any(F.col(title), phrases) | (F.coalesce(F.col(duration), F.lit(0)) < min_s)
    return df.filter(~clip), df.filter(clip)


def prefix_blocklist(
    df: DataFrame, title: str, duration: str, prefixes: list[str] = fv.PROGRAM_PREFIXES, min_s: int = fv.MIN_STREAM_SECONDS
) -> DataFrame:
    """Drop titles with a blocked prefix and videos that are too short."""
    return df.filter(~text.starts_with_any(F.col(title), prefixes) & (F.col(duration) >= min_s))


def placeholder_filter(
    df: DataFrame, status: str, title: str, date: str, cutoff: str, as_of: str,
    dropped: tuple[str, ...] = ("Canceled", "Postponed"), min_title: int = 5, ahead: int = 30,
) -> DataFrame:
    """Drop cancelled rows, stub titles, rows without a date and dates outside [cutoff, as_of + ahead]."""
    trimmed = F.trim(F.coalesce(F.col(title), F.lit("")))
    return df.filter(
        ~F.coalesce(F.col(status), F.lit("")).isin(*dropped)
        & (F.length(trimmed) >= min_title)
        & F.col(date).between(dates.as_date(cutoff), F.date_add(dates.as_date(as_of), ahead))
    )


def needs_work(
    records: DataFrame, steps: DataFrame, record_id: str, processed: Column, pairs: list[tuple[str, str]], reprocess: bool = False
) -> DataFrame:
    """Rows not processed yet, or with a source whose fetch step is not done.

    `pairs` lists (source column of `records`, step name); `steps` has (record_id, step, status).
    """
    if reprocess:
        return records
    wanted = [step for _, step in pairs]
    done = (
        steps.filter((F.col("status") == "done") & F.col("step").isin(wanted))
        .groupBy(record_id)
        .agg(*[F.max((F.col("step") == s).cast("int")).alias(f"__done_{i}") for i, s in enumerate(wanted)])
    )
    joined = records.join(done, record_id, "left")
    gained = F.lit(False)
    for i, (source, _) in enumerate(pairs):
        gained = gained | (F.nullif(F.col(source), F.lit("")).isNotNull() & (F.coalesce(F.col(f"__done_{i}"), F.lit(0)) == 0))
    return joined.filter(~F.coalesce(processed, F.lit(False)) | gained).select(*records.columns)


def split_by_date(df: DataFrame, date: str, as_of: str) -> DataFrame:
    """Add `is_past`: today counts as past."""
    return df.withColumn("is_past", F.col(date) <= dates.as_date(as_of))


def lookback_window(df: DataFrame, date: str, as_of: str, days: int, floor_days: int = 0) -> DataFrame:
    """Rows of the last N days; the bound is a literal, so it reaches the file scan."""
    import datetime

    start = datetime.date.fromisoformat(as_of) - datetime.timedelta(days=max(days, floor_days))
    bound = F.lit(start.isoformat()).cast(df.schema[date].dataType)
    return df.filter(F.col(date) >= bound)


def key_lookup(df: DataFrame, key: str, value, json_cols: dict[str, str] | None = None) -> DataFrame:
    """Rows of one key (pushed to the scan), JSON columns parsed."""
    hit = df.filter(F.col(key) == F.lit(value).cast(df.schema[key].dataType))
    for name, schema in (json_cols or {}).items():
        hit = hit.withColumn(name, F.from_json(name, schema))
    return hit
