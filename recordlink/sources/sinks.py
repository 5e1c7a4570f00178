"""Published artefacts, manifest, run reports and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions import dates


def best_artifacts(artifacts: DataFrame, record_id: str, kind: str, body: str, priority: list[str] = fv.ARTIFACT_PRIORITY) -> DataFrame:
    """Best non-empty artefact per record: (record_id, kind, text)."""
    order = F.array_position(F.array(*[F.lit(k) for k in priority]), F.col(kind))
    usable = artifacts.filter((F.coalesce(F.col(body), F.lit("")) != "") & (order > 0))
    best = usable.groupBy(record_id).agg(F.min_by(F.struct(F.col(kind).alias("kind"), F.col(body).alias("text")), order).alias("__b"))
    return best.select(record_id, "__b.kind", "__b.text")


def publish_best(records: DataFrame, artifacts: DataFrame, record_id: str, path: str, as_of: str) -> DataFrame:
    """Write the best artefact of each record with its path (block_key/event_date_id) and its metadata as JSON.

    Records have block_key, event_date and metadata columns. Records without text are not published. Folders are
    block_key/event_year, not one per day, so that files stay large; rows are rebalanced by size before the write, so a
    large block is split over several files.
    """
    best = best_artifacts(artifacts, record_id, "kind", "text")
    meta_cols = [c for c in records.columns if c not in ("block_key", "event_date", record_id)]
    meta = F.to_json(F.struct(F.col(record_id).alias("id"), "block_key", "event_date", *meta_cols, F.lit(as_of).alias("published_at")))
    rel = F.concat("block_key", F.lit("/"), F.date_format("event_date", "yyyy-MM-dd"), F.lit("_"), F.col(record_id).cast("string"))
    out = records.join(best, record_id).select(record_id, "block_key", "event_date", rel.alias("path"), "kind", "text", meta.alias("meta"))
    dealt = out.withColumn("event_year", F.year("event_date")).hint("rebalance", "block_key", "event_year")
    dealt.write.mode("overwrite").partitionBy("block_key", "event_year").parquet(path)
    schema = dealt.select(*[c for c in dealt.columns if c != "block_key"], "block_key").schema
    return out.sparkSession.read.schema(schema).parquet(path).select(*out.columns)


def manifest_upsert(existing: DataFrame, new: DataFrame, key: str, as_of: str) -> DataFrame:
    """Existing entries untouched, entries with a new id appended, all stamped with the update time."""
    fresh = new.join(existing.select(key), key, "left_anti").dropDuplicates([key])
    return existing.unionByName(fresh.select(*existing.columns)).withColumn("last_updated", F.lit(as_of).cast("timestamp_ntz"))


def write_manifest(manifest: DataFrame, root: str, version: int) -> None:
    """Write a manifest version to a new folder, then point to it; a failed write leaves the old version in force."""
    path = f"{root}/v{version:08d}"
    manifest.write.mode("overwrite").parquet(path)
    spark = manifest.sparkSession
    spark.range(1).select(F.lit(version).alias("version"), F.lit(path).alias("path")).write.mode("append").json(f"{root}/pointer")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest version the newest pointer row names."""
    pointers = spark.read.schema("version int, path string").json(f"{root}/pointer")
    newest = pointers.orderBy(F.col("version").desc()).limit(1).first()
    return spark.read.parquet(newest["path"])


def run_report_json(items: DataFrame, errors: DataFrame, run: str, item_id: str, costs: list[str]) -> DataFrame:
    """Run report as JSON lines: one header per run (counts, summed costs), one line per item and per error.

    Lines instead of one document per run: a run may hold any share of all items.
    """
    sums = [F.round(F.sum(F.col(c).cast("decimal(18,6)")), 2).cast("double").alias(c) for c in costs]
    done = items.groupBy(run).agg(F.count("*").alias("items_processed"), *sums)
    failed = errors.groupBy(run).agg(F.count("*").alias("items_failed"))
    header = done.join(failed, run, "full").select(
        run, F.lit("header").alias("section"), F.lit(-1).cast("bigint").alias("line_id"),
        F.to_json(F.struct(
            F.coalesce("items_processed", F.lit(0)).alias("items_processed"), F.coalesce("items_failed", F.lit(0)).alias("items_failed"),
            F.struct(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in costs]).alias("cost"),
        )).alias("json"),
    )

    def lines(df: DataFrame, section: str) -> DataFrame:
        rest = [c for c in df.columns if c != run]
        return df.select(run, F.lit(section).alias("section"), F.col(item_id).cast("bigint").alias("line_id"), F.to_json(F.struct(*rest)).alias("json"))

    return header.unionByName(lines(items, "item")).unionByName(lines(errors, "error"))


def alert_lines(failing: DataFrame, key: str, source: str, as_of: str) -> DataFrame:
    """One text block per failing source; missing times read `never` and `unknown`."""
    stamp = "yyyy-MM-dd HH:mm:ss"
    message = F.format_string(
        "  %s / %s\n    Consecutive failures : %d\n    Last success         : %s\n    Last failure          : %s",
        F.col(key).cast("string"), F.col(source), "streak",
        F.coalesce(F.date_format("last_success", stamp), F.lit("never")), F.coalesce(F.date_format("last_failure", stamp), F.lit("unknown")),
    )
    return failing.select(dates.as_date(as_of).alias("alert_date"), message.alias("message"))


def alert_append(failing: DataFrame, key: str, source: str, as_of: str, path: str, run: str = "0") -> DataFrame:
    """Write the alert blocks to the folder of their day and run, and return them. A retried run overwrites its own."""
    lines = alert_lines(failing, key, source, as_of)
    lines.select("message").write.mode("overwrite").text(f"{path}/alert_date={as_of[:10]}/run={run}")
    return lines
