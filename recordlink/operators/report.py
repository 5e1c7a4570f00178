"""Coverage, cost and queue-health reports: plain aggregates with map-side combine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions import dates

TOTAL = "TOTAL"


def coverage_matrix(df: DataFrame, key: str, flags: dict[str, Column], none_of: list[str]) -> DataFrame:
    """Per key: rows, rows per flag and rows with none of the named flags; plus a TOTAL row.

    The data is aggregated once per key; the total is rolled up from that small result.
    """
    lacking = F.lit(True)
    for name in none_of:
        lacking = lacking & ~F.coalesce(flags[name], F.lit(False))
    per_key = df.groupBy(key).agg(
        F.count("*").alias("total"),
        *[F.count_if(c).alias(n) for n, c in flags.items()],
        F.count_if(lacking).alias("no_video"),
    )
    names = ["total", *flags, "no_video"]
    rolled = per_key.rollup(key).agg(*[F.sum(n).alias(n) for n in names], F.grouping(key).alias("__g"))
    label = F.when(F.col("__g") == 1, F.lit(TOTAL)).otherwise(F.col(key))
    return rolled.select(label.alias(key), *names, "__g").orderBy("__g", key).drop("__g")


def coverage_share(matrix: DataFrame, key: str) -> DataFrame:
    """The TOTAL row in long form with each count as a whole percentage of all rows."""
    names = [c for c in matrix.columns if c not in (key, "total")]
    total = matrix.filter(F.col(key) == TOTAL)
    long = total.select("total", F.inline(F.array(*[F.struct(F.lit(n).alias("source"), F.col(n).alias("n")) for n in names])))
    percent = F.bround(100 * F.col("n") / F.nullif(F.col("total"), F.lit(0)), 0).cast("bigint")
    return long.select("source", "n", F.coalesce(percent, F.lit(0)).alias("percent"))


def no_source_report(df: DataFrame, key: str, date: str, missing: list[Column], labels: dict[str, Column]) -> DataFrame:
    """Rows with none of the `missing` sources and the labels of the sources they do have."""
    lacking = F.lit(True)
    for c in missing:
        lacking = lacking & ~F.coalesce(c, F.lit(False))
    named = F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in labels.items()])), ",")
    return df.filter(lacking).withColumn("src", F.coalesce(F.nullif(named, F.lit("")), F.lit("none"))).orderBy(key, date)


def cost_totals(runs: DataFrame, amounts: list[str]) -> DataFrame:
    """Number of runs and the sum of each amount; no rows or NULLs count as zero."""
    return runs.agg(
        F.count("*").alias("runs"),
        *[F.coalesce(F.sum(F.col(a).cast("decimal(18,6)")), F.lit(0)).cast("double").alias(a) for a in amounts],
    )


def run_summary(tasks: DataFrame, run: str, ok: Column, stage: str, costs: dict[str, Column], final: str = "publish") -> DataFrame:
    """Per run: processed, failed, records finished (final stage done) and the cost split."""
    money = {n: F.coalesce(F.sum(F.when(ok, c).cast("decimal(18,6)")), F.lit(0)) for n, c in costs.items()}
    total = sum(money.values(), F.lit(0))
    return tasks.groupBy(run).agg(
        F.count_if(ok).alias("tasks_processed"),
        F.count_if(~ok).alias("tasks_failed"),
        F.count_if(ok & (F.col(stage) == final)).alias("records_processed"),
        *[F.round(m, 2).cast("double").alias(n) for n, m in money.items()],
        F.round(total, 2).cast("double").alias("total_usd"),
    )


# Queue tables have: queue, status, attempts, enqueued_at, lease_expires_at.


def status_counts(queues: DataFrame) -> DataFrame:
    return queues.groupBy("queue", "status").agg(F.count("*").alias("n"))


def still_open(open_statuses: dict[str, tuple[str, ...]]) -> Column:
    """Does the item's status count for the retry histogram of its queue? A queue that is not named keeps none."""
    named = [(F.col("queue") == queue) & F.col("status").isin(*statuses) for queue, statuses in open_statuses.items()]
    return reduce(lambda a, b: a | b, named, F.lit(False))


def retry_histogram(queues: DataFrame, open_statuses: dict[str, tuple[str, ...]] = fv.OPEN_STATUSES) -> DataFrame:
    """Items per attempt count, only those whose status is open in their queue."""
    return queues.filter(still_open(open_statuses)).groupBy("queue", "attempts").agg(F.count("*").alias("n")).orderBy("queue", "attempts")


def _seconds_since(ts: Column, as_of: str) -> Column:
    return F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(ts.cast("timestamp"))


def queue_age(queues: DataFrame, as_of: str) -> DataFrame:
    """Seconds since the oldest pending item was queued; NULL when nothing is pending."""
    oldest = F.min(F.when(F.col("status") == "pending", F.col("enqueued_at")))
    return queues.groupBy("queue").agg(oldest.alias("__o")).select("queue", _seconds_since(F.col("__o"), as_of).alias("age_s"))


def stale_leases(queues: DataFrame, as_of: str, running: tuple[str, ...] = ("running", "processing")) -> DataFrame:
    """Running items whose lease has ended."""
    stale = F.col("status").isin(*running) & (F.col("lease_expires_at") < F.lit(as_of).cast("timestamp_ntz"))
    return queues.groupBy("queue").agg(F.count_if(stale).alias("n"))


def queue_health(
    queues: DataFrame, dead: DataFrame, as_of: str, max_age_s: int | None = None, max_dead: int | None = None,
    open_statuses: dict[str, tuple[str, ...]] = fv.OPEN_STATUSES,
) -> DataFrame:
    """All queue metrics in long form (queue, metric, bucket, value, breach).

    One aggregate per (queue, status, attempts) feeds every metric, so the queues are read once.
    """
    stale = F.col("status").isin("running", "processing") & (F.col("lease_expires_at") < F.lit(as_of).cast("timestamp_ntz"))
    base = queues.groupBy("queue", "status", "attempts").agg(
        F.count("*").alias("n"),
        F.count_if(stale).alias("stale"),
        F.min(F.when(F.col("status") == "pending", F.col("enqueued_at"))).alias("oldest"),
    )

    def metric(name: str, bucket: Column, value: Column, oldest: Column | None = None) -> Column:
        when = F.lit(None).cast("timestamp_ntz") if oldest is None else oldest
        return F.struct(F.lit(name).alias("metric"), bucket.alias("bucket"), value.alias("v"), when.alias("t"))

    metrics = F.array(
        metric("status_count", F.col("status"), F.col("n")),
        metric("retry_histogram", F.when(still_open(open_statuses), F.col("attempts").cast("string")), F.col("n")),
        metric("stale_leases", F.lit(""), F.col("stale")),
        metric("max_queue_age_s", F.lit(""), F.lit(0).cast("bigint"), F.col("oldest")),
    )
    long = base.select("queue", F.inline(metrics)).filter("bucket IS NOT NULL")
    age = _seconds_since(F.min("t"), as_of)
    rows = long.groupBy("queue", "metric", "bucket").agg(
        F.when(F.col("metric") == "max_queue_age_s", age).otherwise(F.sum("v")).alias("value")
    )
    dead_row = dead.filter(F.col("resolved_at").isNull()).agg(F.count("*").alias("value")).select(
        F.lit("dead_letter").alias("queue"), F.lit("dead_letter_count").alias("metric"), F.lit("").alias("bucket"), "value"
    )
    breach = F.lit(False)
    if max_age_s is not None:
        breach = breach | ((F.col("metric") == "max_queue_age_s") & (F.col("value") > max_age_s))
    if max_dead is not None:
        breach = breach | ((F.col("metric") == "dead_letter_count") & (F.col("value") > max_dead))
    return rows.unionByName(dead_row).withColumn("breach", F.coalesce(breach, F.lit(False)))


def duplicate_groups(df: DataFrame, keys: list[str], record_id: str) -> DataFrame:
    """Members of every group with more than one row: (keys, n, first_id, id), one row per member."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(record_id).alias("first_id")).filter("n > 1")
    return df.select(*keys, record_id).join(groups, keys)


def theme_groups(quotes: DataFrame, themes: str, score: str, order: list[str]) -> DataFrame:
    """All quotes under their first theme, else `Other`, with their place in the theme (best score first).

    Places are counted in slices of equal rounded score, and slices are added up by their counts, so a theme is not one
    task.
    """
    from pyspark.sql import Window

    theme = F.coalesce(F.get(themes, F.lit(0)), F.lit("Other"))
    rounded = F.bround(F.col(score).cast("decimal(18,6)"), 2).cast("double")
    sliced = quotes.withColumn("theme", theme).withColumn("__slice", rounded)
    sizes = sliced.groupBy("theme", "__slice").agg(F.count("*").alias("__n"))
    above = Window.partitionBy("theme").orderBy(F.col("__slice").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("theme", F.col("__slice").alias("__s"), F.coalesce(F.sum("__n").over(above), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("theme", "__slice").orderBy(F.col(score).desc_nulls_last(), *order)
    ranked = sliced.withColumn("__row", F.row_number().over(inside)).withColumnRenamed("theme", "__theme")
    placed = ranked.join(starts, (F.col("__theme") == F.col("theme")) & F.col("__slice").eqNullSafe(F.col("__s")))
    placed = placed.withColumn("place", (F.col("__start") + F.col("__row")).cast("bigint")).withColumn(score, F.col("__slice"))
    return placed.drop("__theme", "__slice", "__s", "__start", "__row", themes)


def latest_marker(df: DataFrame, ts: str, as_of: str) -> DataFrame:
    """Latest time (NULL when empty) and whether it falls on the given day."""
    latest = df.agg(F.max(ts).alias("latest"))
    return latest.withColumn("ran_today", F.coalesce(F.col("latest").cast("date") == dates.as_date(as_of), F.lit(False)))


def date_span(df: DataFrame, date: str, default: str) -> DataFrame:
    """First and last date; the default when there is none."""
    return df.agg(
        F.coalesce(F.min(date), dates.as_date(default)).alias("start_date"),
        F.coalesce(F.max(date), dates.as_date(default)).alias("end_date"),
    )


def failure_rate(df: DataFrame, item: str, ok: Column, chars: Column, limit: float = 0.5, min_chars: int = 50) -> DataFrame:
    """Per item: parts, failed parts, flag when more than half failed; items without enough text are dropped."""
    stats = df.groupBy(item).agg(
        F.count("*").alias("parts"), F.count_if(~ok).alias("failed"), F.coalesce(F.sum(F.when(ok, chars)), F.lit(0)).alias("chars")
    )
    kept = stats.filter((F.col("parts") > F.col("failed")) & (F.col("chars") >= min_chars))
    return kept.withColumn("high_failure", F.col("failed") / F.col("parts") > limit)


def enqueue_stats(pending: DataFrame, stage: str = "stage") -> DataFrame:
    """Items queued per first pending stage (items with nothing left are not queued)."""
    return pending.filter(F.col(stage).isNotNull()).groupBy(stage).agg(F.count("*").alias("queued"))
