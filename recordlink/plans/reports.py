"""Queries over reports, rankings and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions import text
from recordlink.operators import rank, report, scoring
from recordlink.operators.ordered import failure_streak
from recordlink.plans import sqltext as s
from recordlink.plans.bindings import base_records, records
from recordlink.plans.registry import query, table, wide_table

FLAGS = {
    "video": "o_orderstatus = 'O'", "web": "o_orderpriority <> '5-LOW'", "feed": "o_orderstatus = 'F'",
    "broadcast": "o_orderpriority = '1-URGENT'", "stream": "startswith(k, 'senate') AND o_orderpriority = '2-HIGH'",
    "official": "o_orderpriority = '3-MEDIUM'", "papers": "contains(t, 'ring')",
}
MISSING = ["video", "broadcast", "stream"]
_FLAG_SQL = {n: e.replace("startswith(", "starts_with(") for n, e in FLAGS.items()}
_COUNTS = ", ".join(f"count(*) FILTER ({e}) AS {n}" for n, e in _FLAG_SQL.items())
_NONE = " AND ".join(f"NOT ({_FLAG_SQL[m]})" for m in MISSING)
_MATRIX = f"SELECT coalesce(k, 'TOTAL') AS k, count(*) AS total, {_COUNTS}, count(*) FILTER ({_NONE}) AS no_video FROM base GROUP BY ROLLUP (k)"
WITH = f"WITH {s.RECORDS}"


def matrix(spark, sf):
    return report.coverage_matrix(base_records(spark, sf), "k", {n: F.expr(e) for n, e in FLAGS.items()}, MISSING)


@query("coverage_matrix", f"{WITH} {_MATRIX}")
def q_coverage_matrix(spark, sf):
    return matrix(spark, sf)


@query(
    "coverage_share",
    f"""{WITH} SELECT source, n, CAST(round_even(100.0 * n / total, 0) AS BIGINT) AS percent FROM
    (UNPIVOT (SELECT * FROM ({_MATRIX}) WHERE k = 'TOTAL') ON {', '.join(FLAGS)}, no_video INTO NAME source VALUE n)""",
)
def q_coverage_share(spark, sf):
    return report.coverage_share(matrix(spark, sf), "k")


@query(
    "no_source_report",
    f"""{WITH} SELECT o_orderkey, k, d, coalesce(nullif(concat_ws(',', CASE WHEN {_FLAG_SQL['web']} THEN 'web' END, CASE WHEN {_FLAG_SQL['feed']} THEN 'feed' END,
      CASE WHEN {_FLAG_SQL['official']} THEN 'gov' END), ''), 'none') AS src FROM base WHERE {_NONE}""",
)
def q_no_source_report(spark, sf):
    labels = {"web": F.expr(FLAGS["web"]), "feed": F.expr(FLAGS["feed"]), "gov": F.expr(FLAGS["official"])}
    out = report.no_source_report(base_records(spark, sf), "k", "d", [F.expr(FLAGS[m]) for m in MISSING], labels)
    return out.select("o_orderkey", "k", "d", "src")


_MONEY = "CAST({} AS DECIMAL(18,6))"


@query(
    "cost_totals",
    """SELECT count(*) AS runs, CAST(sum(CAST(l_quantity AS DECIMAL(18,6))) AS DOUBLE) AS l_quantity, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,6))) AS DOUBLE) AS l_extendedprice FROM lineitem""",
)
def q_cost_totals(spark, sf):
    return report.cost_totals(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])


@query(
    "run_summary",
    """SELECT l_suppkey, count(*) FILTER (l_returnflag <> 'R') AS tasks_processed, count(*) FILTER (l_returnflag = 'R') AS tasks_failed,
      count(*) FILTER (l_returnflag <> 'R' AND l_linenumber = 6) AS records_processed,
      CAST(round(coalesce(sum(CAST(l_quantity AS DECIMAL(18,6))) FILTER (l_returnflag <> 'R'), 0), 2) AS DOUBLE) AS cleanup_usd,
      CAST(round(coalesce(sum(CAST(l_tax AS DECIMAL(18,6))) FILTER (l_returnflag <> 'R'), 0), 2) AS DOUBLE) AS audio_usd,
      CAST(round(coalesce(sum(CAST(l_quantity AS DECIMAL(18,6))) FILTER (l_returnflag <> 'R'), 0) + coalesce(sum(CAST(l_tax AS DECIMAL(18,6))) FILTER (l_returnflag <> 'R'), 0), 2) AS DOUBLE) AS total_usd
    FROM lineitem GROUP BY 1""",
)
def q_run_summary(spark, sf):
    tasks = table(spark, sf, "lineitem").withColumn("stage", F.try_element_at(F.array(*[F.lit(x) for x in fv.STAGES]), F.col("l_linenumber")))
    return report.run_summary(
        tasks, "l_suppkey", F.col("l_returnflag") != "R", "stage", {"cleanup_usd": F.col("l_quantity"), "audio_usd": F.col("l_tax")}
    )


# Odd orders are stage tasks, even ones outbox events: finished items have another name in each queue.
_QUEUES = """SELECT CASE WHEN o_orderkey % 2 = 1 THEN 'stage_tasks' ELSE 'outbox' END AS queue,
  CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN CASE WHEN o_orderkey % 2 = 1 THEN 'done' ELSE 'delivered' END
    ELSE CASE WHEN o_orderkey % 2 = 1 THEN 'running' ELSE 'processing' END END AS status,
  CAST(o_custkey % 6 AS BIGINT) AS attempts, o_orderdate AS enqueued_at, o_orderdate + INTERVAL 1 DAY AS lease_expires_at, o_orderkey AS item FROM orders"""
AS_OF = "2000-06-01 00:00:00"


def queues(spark, sf):
    task = F.col("o_orderkey") % 2 == 1
    return table(spark, sf, "orders").select(
        F.when(task, "stage_tasks").otherwise("outbox").alias("queue"),
        F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "F", F.when(task, "done").otherwise("delivered"))
        .otherwise(F.when(task, "running").otherwise("processing")).alias("status"),
        (F.col("o_custkey") % 6).alias("attempts"), F.col("o_orderdate").alias("enqueued_at"),
        F.expr("o_orderdate + INTERVAL 1 DAY").alias("lease_expires_at"), F.col("o_orderkey").alias("item"),
    )


@query("status_counts", f"SELECT queue, status, count(*) AS n FROM ({_QUEUES}) GROUP BY 1, 2")
def q_status_counts(spark, sf):
    return report.status_counts(queues(spark, sf))


@query("retry_histogram", f"SELECT queue, attempts, count(*) AS n FROM ({_QUEUES}) WHERE status IN ('pending', 'running', 'processing') GROUP BY 1, 2")
def q_retry_histogram(spark, sf):
    return report.retry_histogram(queues(spark, sf))


_AGE = f"CAST(epoch(TIMESTAMP '{AS_OF}' - min(enqueued_at) FILTER (status = 'pending')) AS BIGINT)"
_STALE = f"count(*) FILTER (status IN ('running', 'processing') AND lease_expires_at < TIMESTAMP '{AS_OF}')"


@query("queue_age", f"SELECT queue, {_AGE} AS age_s FROM ({_QUEUES}) GROUP BY 1")
def q_queue_age(spark, sf):
    return report.queue_age(queues(spark, sf), AS_OF)


@query("stale_leases", f"SELECT queue, {_STALE} AS n FROM ({_QUEUES}) GROUP BY 1")
def q_stale_leases(spark, sf):
    return report.stale_leases(queues(spark, sf), AS_OF)


_DEAD = """SELECT CASE WHEN event_type = 'error' THEN 'stage_task' ELSE 'outbox_event' END AS item_type, 'k' || event_id AS item_key, ts AS last_failed_at,
  CASE WHEN value > 5 THEN ts END AS resolved_at, user_id FROM events WHERE event_type IN ('error', 'view')"""


def dead_letters(spark, sf):
    return table(spark, sf, "events").filter("event_type IN ('error', 'view')").select(
        F.when(F.col("event_type") == "error", "stage_task").otherwise("outbox_event").alias("item_type"),
        F.concat(F.lit("k"), F.col("event_id").cast("string")).alias("item_key"),
        F.col("ts").alias("last_failed_at"), F.when(F.col("value") > 5, F.col("ts")).alias("resolved_at"), "user_id",
    )


@query(
    "queue_health",
    f"""WITH q AS ({_QUEUES}), m AS (
      SELECT queue, 'status_count' AS metric, status AS bucket, count(*) AS value FROM q GROUP BY 1, 3
      UNION ALL SELECT queue, 'retry_histogram', CAST(attempts AS VARCHAR), count(*) FROM q WHERE status IN ('pending', 'running', 'processing') GROUP BY 1, 3
      UNION ALL SELECT queue, 'stale_leases', '', {_STALE} FROM q GROUP BY 1
      UNION ALL SELECT queue, 'max_queue_age_s', '', {_AGE} FROM q GROUP BY 1
      UNION ALL SELECT 'dead_letter', 'dead_letter_count', '', count(*) FROM ({_DEAD}) WHERE resolved_at IS NULL)
    SELECT *, coalesce((metric = 'max_queue_age_s' AND value > 1000) OR (metric = 'dead_letter_count' AND value > 100000), FALSE) AS breach FROM m""",
)
def q_queue_health(spark, sf):
    return report.queue_health(queues(spark, sf), dead_letters(spark, sf), AS_OF, max_age_s=1000, max_dead=100000)


@query(
    "duplicate_groups",
    """SELECT o_custkey, o_orderdate, o_orderkey, n, first_id FROM orders JOIN (
      SELECT o_custkey, o_orderdate, count(*) AS n, min(o_orderkey) AS first_id FROM orders GROUP BY 1, 2 HAVING count(*) > 1) USING (o_custkey, o_orderdate)""",
)
def q_duplicate_groups(spark, sf):
    return report.duplicate_groups(table(spark, sf, "orders"), ["o_custkey", "o_orderdate"], "o_orderkey")


WEIGHTS = {
    "the": ("policy", 0.21), "with": ("policy", 0.17), "for": ("budget", 0.19), "la": ("budget", 0.23),
    "der": ("security", 0.31), "que": ("security", 0.11), "inging": ("trade", 0.29),
}


def _weight_sql(theme=None):
    return " + ".join(
        f"CASE WHEN list_contains(w, {s.q(k)}) THEN {x}::DECIMAL(9,4) ELSE 0::DECIMAL(9,4) END" for k, (t, x) in WEIGHTS.items() if theme in (None, t)
    )


_THEMES = sorted({t for t, _ in WEIGHTS.values()})
_THEME_SQL = "list_transform(list_sort(list_filter([" + ", ".join(f"{{'w': -({_weight_sql(t)})::DECIMAL(18,4), 't': '{t}'}}" for t in _THEMES) + "], lambda z: z.w < 0)), lambda z: z.t)"
_SCORED = f"""scored AS (SELECT doc_id, lang, source, quality, CAST(least(({_weight_sql()})::DECIMAL(18,4), 1) AS DOUBLE) AS score, {_THEME_SQL} AS themes
  FROM (SELECT documents.*, quality, list_distinct({s.clean_words('text')}) AS w FROM documents LEFT JOIN labels USING (doc_id)))"""


def scored(spark, sf):
    docs = wide_table(spark, sf, "documents", "doc_id", "lang", "source", "text").join(table(spark, sf, "labels"), "doc_id", "left")
    return scoring.score_with(docs, "text", scoring.keyword_scorer(WEIGHTS)).select("doc_id", "lang", "source", "quality", "score", "themes")


@query("score_with", f"WITH {_SCORED} SELECT doc_id, score, array_to_string(themes, '|') AS themes FROM scored")
def q_score_with(spark, sf):
    return scored(spark, sf).select("doc_id", "score", F.array_join("themes", "|").alias("themes"))


@query("top_quotes", f"WITH {_SCORED} SELECT doc_id, lang, score FROM scored WHERE score >= 0.4 ORDER BY score DESC, doc_id LIMIT 30")
def q_top_quotes(spark, sf):
    return rank.top_quotes(scored(spark, sf), "score", ["doc_id"]).select("doc_id", "lang", "score")


@query(
    "theme_groups",
    f"""WITH {_SCORED}, t AS (SELECT * FROM scored)
    SELECT doc_id, lang, source, quality, coalesce(themes[1], 'Other') AS theme, row_number() OVER (PARTITION BY coalesce(themes[1], 'Other') ORDER BY score DESC, doc_id) AS place,
      CAST(round_even(CAST(score AS DECIMAL(18,6)), 2) AS DOUBLE) AS score FROM t""",
)
def q_theme_groups(spark, sf):
    return report.theme_groups(scored(spark, sf), "themes", "score", ["doc_id"])


@query("latest_marker", "SELECT max(ts) AS latest, max(ts)::DATE = DATE '2024-01-30' AS ran_today FROM events")
def q_latest_marker(spark, sf):
    return report.latest_marker(table(spark, sf, "events"), "ts", "2024-01-30")


@query("date_span", "SELECT min(o_orderdate)::DATE AS start_date, max(o_orderdate)::DATE AS end_date FROM orders")
def q_date_span(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    return report.date_span(days, "d", "2000-01-01")


@query(
    "failure_rate",
    """SELECT user_id, count(*) AS parts, count(*) FILTER (event_type IN ('error', 'view', 'click')) AS failed,
      CAST(coalesce(sum(CAST(floor(value) AS BIGINT)) FILTER (event_type NOT IN ('error', 'view', 'click')), 0) AS BIGINT) AS chars,
      count(*) FILTER (event_type IN ('error', 'view', 'click')) / count(*)::DOUBLE > 0.5 AS high_failure
    FROM events GROUP BY 1 HAVING parts > failed AND chars >= 50""",
)
def q_failure_rate(spark, sf):
    ok = ~F.col("event_type").isin("error", "view", "click")
    return report.failure_rate(table(spark, sf, "events"), "user_id", ok, F.floor("value").cast("bigint"))


# ---------------------------------------------------------------- rankings and sets


@query(
    "claimable",
    f"""SELECT item, queue, available_at FROM (SELECT *, CASE WHEN attempts > 0 THEN enqueued_at + INTERVAL 7 DAY END AS available_at FROM ({_QUEUES}))
    WHERE status = 'pending' AND (available_at IS NULL OR available_at <= TIMESTAMP '{AS_OF}') ORDER BY available_at NULLS FIRST, item LIMIT 20""",
)
def q_claimable(spark, sf):
    q = queues(spark, sf).withColumn("available_at", F.when(F.col("attempts") > 0, F.expr("enqueued_at + INTERVAL 7 DAY")))
    return rank.claimable(q, AS_OF, 20, "available_at", ["item"]).select("item", "queue", "available_at")


_STREAK = """WITH l AS (SELECT user_id, max((ts, event_id)) FILTER (event_type <> 'error') AS lp, max(ts) FILTER (event_type = 'error') AS last_failure,
    last(value ORDER BY ts, event_id) FILTER (event_type <> 'error') AS last_count FROM events GROUP BY 1),
  s AS (SELECT l.user_id, count(e.event_id) AS streak FROM l LEFT JOIN events e ON e.user_id = l.user_id AND e.event_type = 'error' AND (lp IS NULL OR (e.ts, e.event_id) > lp) GROUP BY 1)
  SELECT user_id, streak, (SELECT max(ts) FROM events e WHERE e.user_id = l.user_id AND event_type <> 'error') AS last_success, last_failure, last_count FROM l JOIN s USING (user_id)"""


def streaks(spark, sf):
    ev = table(spark, sf, "events")
    return failure_streak(ev, ["user_id"], "ts", "event_id", F.col("event_type") != "error", F.col("value"))


@query("failure_streak", _STREAK)
def q_failure_streak(spark, sf):
    return streaks(spark, sf)


@query("failing_list", f"SELECT user_id, streak FROM ({_STREAK}) WHERE streak >= 2")
def q_failing_list(spark, sf):
    return rank.failing_list(streaks(spark, sf), 2).select("user_id", "streak")


@query(
    "dead_letter_list",
    f"SELECT item_type, item_key, last_failed_at FROM ({_DEAD}) WHERE resolved_at IS NULL AND item_type = 'stage_task' ORDER BY last_failed_at DESC, item_type, item_key LIMIT 100",
)
def q_dead_letter_list(spark, sf):
    return rank.dead_letter_list(dead_letters(spark, sf), 100, "stage_task").select("item_type", "item_key", "last_failed_at")


@query("authority_order", f"{WITH} SELECT rec, authority FROM records ORDER BY authority DESC, rec")
def q_authority_order(spark, sf):
    return rank.authority_order(records(base_records(spark, sf)), "authority", "rec").select("rec", "authority")


@query(
    "unprocessed_list",
    "SELECT event_id, ts, CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events WHERE event_type <> 'purchase'",
)
def q_unprocessed_list(spark, sf):
    ev = table(spark, sf, "events").withColumn("processed_at", F.when(F.col("event_type") == "purchase", F.col("ts")))
    out = rank.unprocessed_list(ev, "processed_at", "ts", "props")
    return out.select("event_id", "ts", F.try_element_at("props", F.lit("k")).alias("k"))


@query(
    "union_sources",
    """SELECT 'o' || o_orderkey AS id, CAST(o_orderdate AS DATE) AS event_date, NULL AS title FROM orders
    UNION ALL SELECT 'p' || p_partkey, NULL, p_name FROM part""",
)
def q_union_sources(spark, sf):
    a = table(spark, sf, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("event_date"))
    b = table(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), F.col("p_name").alias("title"))
    return rank.union_sources(a, b)


@query(
    "union_precedence",
    """SELECT c_custkey, c_name, 0 AS precedence FROM customer WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT c_custkey, c_name, 1 FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
)
def q_union_precedence(spark, sf):
    cust = table(spark, sf, "customer")
    a = cust.filter("c_mktsegment = 'MACHINERY'").select("c_custkey", "c_name")
    return rank.union_precedence(a, cust.select("c_custkey", "c_name"), "c_custkey")


@query(
    "token_set_ops",
    f"""SELECT p_partkey, array_to_string(list_sort(list_intersect(ta, tb)), ' ') AS common, array_to_string(list_sort(list_distinct(list_concat(ta, tb))), ' ') AS everything,
      array_to_string(list_sort(list_filter(ta, lambda x: NOT list_contains(tb, x))), ' ') AS only_a
    FROM (SELECT p_partkey, {s.token_set("p_name || ' ' || p_type")} AS ta, {s.token_set("p_type || ' ' || p_brand || ' ring'")} AS tb FROM part)""",
)
def q_token_set_ops(spark, sf):
    a = text.token_set(F.concat_ws(" ", "p_name", "p_type"))
    b = text.token_set(F.concat_ws(" ", "p_type", "p_brand", F.lit("ring")))
    df = table(spark, sf, "part").select("p_partkey", a.alias("a"), b.alias("b"))
    common, everything, only = rank.token_set_ops(F.col("a"), F.col("b"))
    return df.select(
        "p_partkey", F.array_join(common, " ").alias("common"), F.array_join(everything, " ").alias("everything"),
        F.array_join(only, " ").alias("only_a"),
    )


@query(
    "registry_diff",
    # documents against labels
    """(SELECT k, 'b' AS missing_in FROM (SELECT doc_id AS k FROM documents EXCEPT SELECT doc_id FROM labels))
    UNION ALL (SELECT k, 'a' FROM (SELECT doc_id AS k FROM labels EXCEPT SELECT doc_id FROM documents))""",
)
def q_registry_diff(spark, sf):
    known = table(spark, sf, "documents").select(F.col("doc_id").alias("k"))
    return rank.registry_diff(known, table(spark, sf, "labels").select(F.col("doc_id").alias("k")), "k")
