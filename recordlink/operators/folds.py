"""Event logs folded to current state. Aggregates with map-side combine unless stated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.operators.ordered import first_per_key, ordered_scan, time_segment

# Step events have: id, step, status, ts, event_id (unique order inside a timestamp), error, payload.


def _last(value: str | Column, when: Column | None = None) -> Column:
    position = F.struct("ts", "event_id")
    return F.max_by(value, position if when is None else F.when(when, position))


def _first(value: str | Column, when: Column | None = None) -> Column:
    position = F.struct("ts", "event_id")
    return F.min_by(value, position if when is None else F.when(when, position))


def step_state_fold(events: DataFrame) -> DataFrame:
    """Current row per (id, step): running sets the start and clears the error, done/failed set end and error."""
    ended = F.col("status").isin("done", "failed")
    state = events.groupBy("id", "step").agg(
        _last("status").alias("status"),
        _first("status").alias("__first"),
        F.min("ts").alias("__t0"),
        _last("ts", F.col("status") == "running").alias("__run"),
        _last("ts", ended).alias("completed_at"),
        _last(F.struct("error")).alias("__e"),
    )
    return state.select(
        "id", "step", "status",
        F.coalesce("__run", F.when(F.col("__first").isin("done", "failed"), F.col("__t0"))).alias("started_at"),
        "completed_at",
        F.when(F.col("status") != "running", F.col("__e.error")).alias("error"),
    )


def task_state_fold(events: DataFrame, max_attempts: int = fv.MAX_ATTEMPTS) -> DataFrame:
    """Current row per (id, step, version) with attempts, kept payload and the dead-letter rule."""
    running, ended = F.col("status") == "running", F.col("status").isin("done", "failed")
    position = F.struct("ts", "event_id")
    state = events.groupBy("id", "step", "version").agg(
        _last("status").alias("__status"),
        _first("status").alias("__first"),
        F.count_if(running).alias("__runs"),
        F.min("ts").alias("enqueued_at"),
        F.max(F.when(running, position)).alias("__run"),
        F.max(F.when(ended, position)).alias("__end"),
        _last(F.struct("error")).alias("__e"),
        _last("payload", F.col("payload").isNotNull()).alias("payload"),
    )
    attempts = F.col("__runs") + F.col("__first").isin("done", "failed").cast("int")
    dead = (F.col("__status") == "failed") & (attempts >= max_attempts)
    return state.select(
        "id", "step", "version",
        F.when(dead, F.lit("dead_letter")).otherwise(F.col("__status")).alias("status"),
        attempts.alias("attempts"), "enqueued_at",
        F.coalesce(F.col("__run.ts"), F.when(F.col("__first").isin("done", "failed"), F.col("enqueued_at"))).alias("started_at"),
        F.when(F.col("__run").isNull() | (F.col("__end") > F.col("__run")), F.col("__end.ts")).alias("completed_at"),
        F.when(F.col("__status") != "running", F.col("__e.error")).alias("last_error"),
        "payload",
    )


def dead_letter_fold(events: DataFrame, keys: list[str], width: str = "1 hour") -> DataFrame:
    """Dead-letter rows: failures between two requeue events of a key form one row; the requeue resolves it.

    `events` has the keys, ts, event_id, kind ('fail' or 'requeue'), error, attempts, payload.
    Keys may be NULL (they compare null-safe).
    """
    safe = [F.coalesce(F.col(k).cast("string"), F.lit("\u0000")).alias(f"__k{i}") for i, k in enumerate(keys)]
    names = [f"__k{i}" for i in range(len(keys))]
    staged = events.select("*", *safe)
    run = ordered_scan(
        staged, names, ["ts", "event_id"], time_segment("ts", width), sums={"__n": (F.col("kind") == "requeue").cast("int")}
    )
    failed = F.col("kind") == "fail"
    island = F.when(failed, F.col("__n")).otherwise(F.col("__n") - 1)
    rows = run.withColumn("island", island).groupBy(*names, "island").agg(
        *[F.first(k, ignorenulls=True).alias(k) for k in keys],
        F.min(F.when(failed, F.col("ts"))).alias("first_failed_at"),
        F.max(F.when(failed, F.col("ts"))).alias("last_failed_at"),
        _last("error", failed).alias("error"),
        _last("attempts", failed).alias("attempts"),
        _last("payload", failed & F.col("payload").isNotNull()).alias("payload"),
        F.max(F.when(~failed, F.col("ts"))).alias("resolved_at"),
    )
    return rows.filter(F.col("first_failed_at").isNotNull()).select(
        *keys, "first_failed_at", "last_failed_at", "error", "attempts", "payload", "resolved_at"
    )


def initial_stage(records: DataFrame, steps: DataFrame, record_id: str, has_stream: Column, has_broadcast: Column, processed: Column) -> DataFrame:
    """First stage still to do per record, NULL when all is done.

    `steps` has (record_id, step, status). A record with a stream or a broadcast URL also needs that fetch step.
    """
    names = ["captions", "isvp_fetched", "isvp", "cspan_fetched", "cspan", "testimony", "govinfo"]
    done = steps.filter(F.col("status") == "done").groupBy(record_id).agg(
        *[F.max((F.col("step") == n).cast("int")).alias(f"__{n}") for n in names]
    )
    joined = records.join(done, record_id, "left")

    def open_(name: str) -> Column:
        return F.coalesce(F.col(f"__{name}"), F.lit(0)) == 0

    stage = (
        F.when(open_("captions"), "captions")
        .when((F.coalesce(has_stream, F.lit(False)) & open_("isvp_fetched")) | open_("isvp"), "isvp")
        .when((F.coalesce(has_broadcast, F.lit(False)) & open_("cspan_fetched")) | open_("cspan"), "cspan")
        .when(open_("testimony"), "testimony")
        .when(open_("govinfo"), "govinfo")
        .when(~F.coalesce(processed, F.lit(False)), "publish")
    )
    return joined.select(*records.columns, stage.alias("stage"))


def record_upsert(
    stored: DataFrame, new: DataFrame, key: str, keep_first: list[str], keep_if_null: list[str], counters: list[str] | None = None
) -> DataFrame:
    """Insert new rows or replace the attributes of stored ones.

    `keep_first` columns never change once set; `keep_if_null` keep the old value when the new one is NULL;
    `counters` grow by one on every update. Everything else takes the new value.
    """
    counters = counters or []
    o = stored.select(F.struct(*stored.columns).alias("o"), F.col(key))
    n = new.select(F.struct(*new.columns).alias("n"), F.col(key))
    both = o.join(n, key, "full")
    is_new, known = F.col("n").isNotNull(), F.col("o").isNotNull()

    def value(c: str) -> Column:
        if c not in new.columns:
            return F.col(f"o.{c}")
        if c in keep_first:
            return F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}"))
        if c in keep_if_null:
            return F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}"))
        if c in counters:
            return F.when(is_new & known, F.col(f"o.{c}") + 1).otherwise(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")))
        return F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    return both.select(key, *[value(c).alias(c) for c in stored.columns if c != key])


def insert_if_absent(stored: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Stored rows plus the first new row of every key not stored yet."""
    fresh = first_per_key(new, [key], order).join(stored.select(key), key, "left_anti")
    return stored.unionByName(fresh.select(*stored.columns))


def events_to_inputs(events: DataFrame, event_type: str, payload: str, schema: str, required: list[str], record_id: str) -> tuple[DataFrame, DataFrame]:
    """(inputs, rejects): events of one type with all required payload fields, first per record; the rest is rejected."""
    parsed = events.withColumn("__p", F.from_json(payload, schema))
    valid = F.col("event_type") == event_type
    for f in required:
        valid = valid & (F.coalesce(F.col(f"__p.{f}"), F.lit("")) != "")
    fields = [f.strip().split(" ")[0] for f in schema.split(",")]
    good = parsed.filter(valid).select("event_id", *[F.col(f"__p.{f}").alias(f) for f in fields])
    inputs = first_per_key(good, [record_id], ["event_id"])
    return inputs, events.join(inputs.select("event_id"), "event_id", "left_anti")
