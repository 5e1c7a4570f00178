"""How the driver tables are read as records, clips, logs and captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlink.plans.registry import table, wide_table


def base_records(spark: SparkSession, sf: str) -> DataFrame:
    """One dated, titled record per order: key from the customer's nation, title from a part."""
    customer, part = (table(spark, sf, n) for n in ("customer", "part"))
    orders = wide_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(part, orders.o_custkey == part.p_partkey)
    return joined.select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("d"),
        F.concat(
            F.when(F.col("c_nationkey") < 12, "house.n").otherwise("senate.n"), F.col("c_nationkey").cast("string")
        ).alias("k"),
        F.concat_ws(" ", "p_name", F.lower("p_type"), "p_brand").alias("t"),
    )


def records(base: DataFrame) -> DataFrame:
    """Three overlapping sources of the same events: web pages, videos (one day late when urgent) and an official feed.

    The base is read once: each of its rows gives the records `n` of its sources.
    """
    d, t, k, key, n = F.col("d"), F.col("t"), F.col("k"), F.col("o_orderkey"), F.col("n")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    sources = F.array_compact(F.array(F.lit(0), F.when(status == "O", 1), F.when(status == "F", 2)))

    def of(web: Column, video: Column, feed: Column) -> Column:
        return F.when(n == 0, web).when(n == 1, video).otherwise(feed)

    video_day = F.when(priority == "1-URGENT", F.date_add(d, 1)).otherwise(d)
    feed_key = F.when(priority == "5-LOW", F.concat(F.lit("govinfo."), F.split_part(k, F.lit("."), F.lit(1)))).otherwise(k)
    id_text = key.cast("string")
    return base.withColumn("n", F.explode(sources)).select(
        (key * 4 + n).alias("rec"), of(k, k, feed_key).alias("block_key"),
        of(t, F.concat(F.lit("Full Committee Hearing: "), t), F.concat(t, F.lit(" outlook"))).alias("title"),
        of(d, video_day, d).alias("event_date"), of(F.lit(2), F.lit(1), F.lit(4)).alias("authority"),
        of(F.lit("web_url"), F.lit("video_id"), F.lit("event_id")).alias("source"),
        F.concat(of(F.lit("https://site.example.org/"), F.lit("v"), F.lit("e")), id_text).alias("source_value"), (n == 1).alias("has_video"),
    )


def record_list(spark: SparkSession, sf: str, base: DataFrame | None = None) -> DataFrame:
    """Records in the shape the resolver takes: a source map per row."""
    return records(base_records(spark, sf) if base is None else base).withColumn("sources", F.create_map("source", "source_value"))
