"""Streaming forms of ingest, sessions, failure streaks and health counts.

Every sink writes one folder per batch and overwrites it on a retry, so a lost executor or a restarted
query leaves no half-written or doubled result. Checkpoints and outputs go to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from recordlink.operators.ordered import failure_streak


def read_files(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """File stream of Parquet rows; zone-free times become timestamps so that they can carry a watermark."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(path)
    ntz = [f.name for f in schema.fields if isinstance(f.dataType, TimestampNTZType)]
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else stream


def run_to_end(stream: DataFrame, root: str, mode: str, write_batch: Callable[[DataFrame, int], None]) -> None:
    """Process everything that is there, batch by batch, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write_batch)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _batch_folder(root: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    return write


def _read_out(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/out")


def stream_ingest(stream: DataFrame, id_col: str, ts: str, lookback: str, root: str) -> DataFrame:
    """Records that overlapping look-back runs deliver again and again, each passed on once.

    State is kept for the look-back only; rows later than that are dropped.
    """
    once = stream.withWatermark(ts, lookback).dropDuplicatesWithinWatermark([id_col])
    run_to_end(once, root, "append", _batch_folder(root))
    return _read_out(stream.sparkSession, root).drop("batch")


def stream_gap_sessions(stream: DataFrame, key: str, ts: str, gap: str, delay: str, root: str) -> DataFrame:
    """Sessions per key, closed by a pause longer than the gap; emitted once the watermark passes their end.

    Sessions are merged inside each map task before the shuffle, so a hot key sends few rows.
    """
    spark = stream.sparkSession
    option = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(option)
    spark.conf.set(option, "true")
    try:
        sessions = (
            stream.withWatermark(ts, delay)
            .groupBy(F.session_window(ts, gap).alias("s"), key)
            .agg(F.count("*").alias("parts"))
            .select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "parts")
        )
        run_to_end(sessions, root, "append", _batch_folder(root))
    finally:
        spark.conf.set(option, before)
    return _read_out(spark, root).drop("batch")


def fold_streaks(prior: DataFrame | None, batch: DataFrame, key: str, ts: str, tie: str, ok: Column) -> DataFrame:
    """State of every key after a batch: streak, last success, last failure, streak before the batch."""
    now = failure_streak(batch, [key], ts, tie, ok, F.lit(1)).drop("last_count")
    if prior is None:
        return now.withColumn("streak_before", F.lit(0).cast("bigint"))
    old = prior.select(key, F.col("streak").alias("__streak"), F.col("last_success").alias("__ok"), F.col("last_failure").alias("__bad"))
    both = old.join(now, key, "full")
    grown = F.coalesce("__streak", F.lit(0)) + F.coalesce("streak", F.lit(0))
    return both.select(
        key,
        F.when(F.col("last_success").isNotNull(), F.col("streak")).otherwise(grown).alias("streak"),
        F.coalesce("last_success", "__ok").alias("last_success"),
        F.coalesce("last_failure", "__bad").alias("last_failure"),
        F.coalesce("__streak", F.lit(0)).cast("bigint").alias("streak_before"),
    )


def stream_failure_streak(stream: DataFrame, key: str, ts: str, tie: str, ok: Column, threshold: int, root: str) -> tuple[DataFrame, DataFrame]:
    """(state, alerts): failure streak per key over a stream, an alert whenever it reaches the threshold.

    Each batch is reduced to one row per key before it meets the stored state, so a hot key does not pile
    up in one stateful task. State version n is built from version n-1 only and can be rebuilt.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        prior = session.read.parquet(f"{root}/state/v={batch_id - 1}") if batch_id > 0 else None
        fold_streaks(prior, batch, key, ts, tie, ok).write.mode("overwrite").parquet(f"{root}/state/v={batch_id}")
        state = session.read.parquet(f"{root}/state/v={batch_id}")
        crossed = state.filter((F.col("streak") >= threshold) & (F.col("streak_before") < threshold))
        crossed.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    run_to_end(stream, root, "append", write)
    last = newest_version(spark, f"{root}/state")
    if last is None:
        none = fold_streaks(None, spark.createDataFrame([], stream.schema), key, ts, tie, ok)
        return none.drop("streak_before"), none
    return spark.read.parquet(f"{root}/state/v={last}").drop("streak_before"), _read_out(spark, root)


def newest_version(spark: SparkSession, folder: str) -> int | None:
    """Highest n of the complete `v=n` folders, by the store itself: a restarted job knows no more than that."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return None
    found = [s.getPath() for s in store.listStatus(path)]
    done = [p for p in found if store.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max((int(p.getName().split("=")[1]) for p in done), default=None)


def stream_health_counts(stream: DataFrame, ts: str, status: str, size: str, slide: str | None, delay: str, root: str) -> DataFrame:
    """Counts per window and status, kept up to date; the newest value of every window is returned."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    counts = (
        stream.withWatermark(ts, delay).groupBy(window.alias("w"), status).agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), status, "n")
    )
    run_to_end(counts, root, "update", _batch_folder(root))
    newest = _read_out(stream.sparkSession, root).groupBy("window_start", "window_end", status)
    return newest.agg(F.max_by("n", "batch").alias("n"))
