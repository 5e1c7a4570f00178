"""Exact dedup: a tree-merge of sorted digest runs, with built-in functions only.

Each partition of the input becomes a run: its rows as (digest, size, check, id), sorted by digest and then by id, the
largest first. The runs are written once, so every text is read and hashed once. A run has one entry per digest, its
first row and how many it met. Then the runs are merged in rounds, `fan_in` neighbouring runs into one (runs i with
equal i // fan_in ** r in round r), until one is left; the number of rounds follows the number of runs. In a round the
entries of a digest meet in order of their ids; the first is retained, and takes in those behind it. Entries meet only if
the whole key is the same: SHA-256 of the normalised text, its length, and a second hash by another function, so that
a retained entry is verified against each of its copies at every level; an entry that differs in any of them stays
apart. Digests are dealt over all tasks, and a group of copies enters a round as `fan_in` entries at most.
The verdict goes down the same way: to the entries of the first runs, then to their rows, so that the rows of a hot
group are joined in as many pieces as there are runs.

Defined cases: a null text is empty; empty texts are equal to each other; texts of any length are hashed whole; a null
id is smaller than any other and is returned with `kept` true only if its whole group has null ids; rows that repeat an
id and a text count as copies and stay or go together; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlink.llm.scratch import keep

KEY = ["digest", "size", "check"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the short way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, size, check, run): one sorted run per partition."""
    text = F.coalesce(F.col("text"), F.lit(""))
    low = ascii_lower(text)
    rows = docs.select(
        "doc_id", F.sha2(low, 256).alias("digest"), F.octet_length(text).alias("size"), F.xxhash64(low).alias("check"), F.spark_partition_id().alias("run")
    )
    return rows.sortWithinPartitions(*KEY, F.col("doc_id").desc_nulls_last())


def merge_round(entries: DataFrame, fan_in: int) -> DataFrame:
    """Entries of `fan_in` neighbouring runs as one run: of equal keys the largest id is retained and counts the others."""
    met = Window.partitionBy("run", *KEY).orderBy(F.col("best").desc_nulls_last())
    whole = met.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    up = entries.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
    placed = up.select("run", *KEY, "best", F.sum("n").over(whole).alias("n"), F.row_number().over(met).alias("place"))
    return placed.filter("place = 1").drop("place")


def exact_dedup(docs: DataFrame, fan_in: int = 8) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of `docs`; the largest id of a group stays."""
    runs = keep(digest_runs(docs), "digest-runs")
    entries = runs.groupBy("run", *KEY).agg(F.max("doc_id").alias("best"), F.count("*").alias("n"))
    merged, left = entries, (runs.agg(F.max("run")).first()[0] or 0) + 1
    while left > 1:
        merged, left = merge_round(merged, fan_in), -(-left // fan_in)
    final = merged.select(*KEY, F.col("best").alias("keep_id"), F.col("n").alias("group_size"))
    verdict = entries.select("run", *KEY).join(final, KEY)
    rows = runs.join(verdict, ["run", *KEY])
    return rows.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))
