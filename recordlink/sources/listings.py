"""Registries, delimited listings and paged JSON answers as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink.operators.ordered import first_per_key


def registry_explode(df: DataFrame, json_col: str, value_schema: str) -> DataFrame:
    """One row per key of a JSON object of objects; missing fields are NULL."""
    parsed = F.from_json(json_col, f"map<string, struct<{value_schema}>>")
    kept = [c for c in df.columns if c != json_col]
    return df.select(*kept, F.explode(parsed).alias("key", "__v")).select(*kept, "key", "__v.*")


def delimited_listing(
    df: DataFrame, line: str, cutoff: str, order: list[str], sep: str = "\t", bad_duration: str = "zero"
) -> DataFrame:
    """Listing lines `id, title, yyyymmdd, duration` to (id, title, event_date, duration_s).

    Short lines go. The first line of an id decides, and goes too when its date is missing, `NA`, short
    or before the cutoff. An unreadable duration counts as zero, or drops the row (`bad_duration="drop"`).
    """
    parts = F.split(line, sep, 4)
    staged = df.select(*order, parts.alias("__p")).filter(F.size("__p") == 4).select(
        *order,
        F.col("__p")[0].alias("id"), F.col("__p")[1].alias("title"), F.col("__p")[2].alias("__d"), F.col("__p")[3].alias("__s"),
    )
    first = first_per_key(staged, ["id"], order)
    dated = first.filter((F.length("__d") >= 8) & (F.col("__d") != "NA") & (F.col("__d") >= cutoff.replace("-", "")))
    seconds = F.trim("__s").try_cast("double").cast("bigint")
    out = dated.select("id", "title", F.try_to_date(F.left("__d", F.lit(8)), "yyyyMMdd").alias("event_date"), seconds.alias("duration_s"))
    return out.filter("duration_s IS NOT NULL") if bad_duration == "drop" else out.withColumn("duration_s", F.coalesce("duration_s", F.lit(0)))


def api_page_flatten(df: DataFrame, json_col: str, schema: str, array_path: str, required: list[str], keep: list[str] | None = None) -> DataFrame:
    """One row per item of the array inside each JSON answer; items without a required field are dropped."""
    keep = keep or []
    staged = df.select(*keep, F.from_json(json_col, schema).alias("__j"))
    rows = staged.select(*keep, F.inline(F.col(f"__j.{array_path}")))
    present = F.lit(True)
    for name in required:
        present = present & (F.coalesce(F.col(name), F.lit("")) != "")
    return rows.filter(present)


def non_empty_people(people: Column) -> Column:
    """People structs that have at least one non-empty field."""
    return F.filter(
        people,
        lambda p: (F.coalesce(p["name"], F.lit("")) != "")
        | (F.coalesce(p["position"], F.lit("")) != "")
        | (F.coalesce(p["organization"], F.lit("")) != ""),
    )
