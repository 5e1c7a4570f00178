"""Queries over ordered scans, event-log folds, captions and chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions.cost import estimate_tokens, token_cost
from recordlink.operators import captions, chunks, folds, ordered, report
from recordlink.plans import sqltext as s
from recordlink.plans.registry import query, table, wide_table

# ---------------------------------------------------------------- ordered scans


@query("first_per_key", "SELECT user_id, first(event_id ORDER BY ts, event_id) AS event_id, first(event_type ORDER BY ts, event_id) AS event_type FROM events GROUP BY 1")
def q_first_per_key(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return ordered.first_per_key(ev, ["user_id"], ["ts", "event_id"]).drop("ts")


_CLEAN_LINES = """list_filter(list_transform(list_filter(string_split_regex(t, '\\r\\n|[\\n\\r\\v\\f]'),
  lambda x: NOT (starts_with(x, 'WEBVTT') OR starts_with(x, 'Kind:') OR starts_with(x, 'Language:') OR contains(x, '-->'))),
  lambda x: trim(regexp_replace(x, '<[^>]+>', '', 'g'))), lambda x: x <> '')"""


@query(
    "collapse_repeats",
    f"""SELECT doc_id, array_to_string(list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1]), chr(10)) AS plain
    FROM (SELECT doc_id, {_CLEAN_LINES} AS l FROM (SELECT doc_id, 'WEBVTT' || chr(10) || '00:01 --> 00:02' || chr(10) || replace(text, '. ', '.' || chr(10) || '<c>') AS t FROM documents))""",
)
def q_collapse_repeats(spark, sf):
    body = F.concat(F.lit("WEBVTT\n00:01 --> 00:02\n"), F.replace(F.col("text"), F.lit(". "), F.lit(".\n<c>")))
    docs = wide_table(spark, sf, "documents", "doc_id", "text").select("doc_id", body.alias("body"))
    return ordered.collapse_repeats(docs, "doc_id", "body").select("doc_id", F.array_join("lines", "\n").alias("plain"))


@query(
    "gap_paragraphs",
    """SELECT user_id, event_id, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS paragraph FROM (
      SELECT *, CASE WHEN epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 14400 THEN 1 ELSE 0 END AS n FROM events)""",
)
def q_gap_paragraphs(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts")
    out = ordered.gap_paragraphs(ev, ["user_id"], "ts", "event_id", ordered.time_segment("ts"), 14400)
    return out.select("user_id", "event_id", "paragraph")


@query(
    "speaker_turns",
    """SELECT conv_id, turn, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) AS turn_no, CASE WHEN n = 1 THEN coalesce(who, '[SPEAKER]') END AS header,
      trim(regexp_replace(regexp_replace(text, '\\n+', ' ', 'g'), '\\s{2,}', ' ', 'g')) AS line FROM (
      SELECT *, CASE WHEN who IS DISTINCT FROM lag(who) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS n FROM (
        SELECT *, CASE WHEN role = 'user' THEN 'user' WHEN role = 'assistant' AND turn % 4 = 1 THEN 'assistant' END AS who FROM conversations WHERE trim(text) <> ''))""",
)
def q_speaker_turns(spark, sf):
    role = F.when(F.col("role") == "user", "user").when((F.col("role") == "assistant") & (F.col("turn") % 4 == 1), "assistant").otherwise(">>")
    conv = table(spark, sf, "conversations").select("conv_id", "turn", role.alias("who"), "text")
    return ordered.speaker_turns(conv, "conv_id", "turn", "who", "text")


@query(
    "budget_cutoff",
    """SELECT o_orderkey, CAST(spent AS DOUBLE) AS spent_before FROM (SELECT o_orderkey,
      coalesce(sum(CAST(o_totalprice AS DECIMAL(38,6))) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM orders) WHERE spent < 500000000""",
)
def q_budget_cutoff(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    out = ordered.budget_cutoff(orders, "o_orderkey", "o_totalprice", 500000000)
    return out.select("o_orderkey", F.col("spent_before").cast("double").alias("spent_before"))


@query(
    "stop_after_empty",
    """WITH p AS (SELECT *, row_number() OVER w AS pos, event_type IN ('view', 'purchase') AS hit, CAST(floor(value) AS BIGINT) % 2 AS links FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
      r AS (SELECT *, pos - coalesce(max(CASE WHEN hit THEN pos END) OVER (PARTITION BY user_id ORDER BY pos), 0) AS empty_streak FROM p),
      x AS (SELECT user_id, min(pos) FILTER (empty_streak >= 4 AND links = 0) AS stop FROM r GROUP BY 1)
    SELECT user_id, event_id, pos, empty_streak FROM r JOIN x USING (user_id) WHERE stop IS NULL OR pos <= stop""",
)
def q_stop_after_empty(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    out = ordered.stop_after_empty(
        ev, ["user_id"], ["ts", "event_id"], ordered.time_segment("ts"),
        F.col("event_type").isin("view", "purchase"), F.floor("value").cast("bigint") % 2,
    )
    return out.select("user_id", "event_id", "pos", "empty_streak")


_STAGES = s.sql_list(fv.STAGES)


@query("next_stage", f"SELECT l_orderkey, l_linenumber, {_STAGES}[l_linenumber] AS stage, {_STAGES}[l_linenumber + 1] AS following FROM lineitem")
def q_next_stage(spark, sf):
    stage = F.get(F.array(*[F.lit(x) for x in fv.STAGES]), F.col("l_linenumber") - 1)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", stage.alias("stage"), ordered.next_stage(stage).alias("following"))


# ---------------------------------------------------------------- folds

_STEP_SQL = """SELECT user_id AS id, event_id, ts, ['captions', 'isvp', 'cspan'][event_id % 3 + 1] AS step, CAST(1 + event_id % 2 AS BIGINT) AS version,
  CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'running' WHEN 'click' THEN 'done' ELSE 'failed' END AS status,
  CASE WHEN event_type = 'error' THEN 'err' || event_id END AS error, CASE WHEN value > 30 THEN 'p' || event_id END AS payload FROM events"""


def step_events(spark, sf):
    eid = F.col("event_id").cast("string")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("id"), "event_id", "ts",
        F.get(F.array(F.lit("captions"), F.lit("isvp"), F.lit("cspan")), (F.col("event_id") % 3).cast("int")).alias("step"),
        (F.col("event_id") % 2 + 1).alias("version"),
        F.expr("CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'running' WHEN 'click' THEN 'done' ELSE 'failed' END").alias("status"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("err"), eid)).alias("error"),
        F.when(F.col("value") > 30, F.concat(F.lit("p"), eid)).alias("payload"),
    )


_FOLD = """last(status ORDER BY ts, event_id) AS st, first(status ORDER BY ts, event_id) AS st0, min(ts) AS t0,
  max(ts) FILTER (status = 'running') AS tr, max(ts) FILTER (status IN ('done', 'failed')) AS te, last(coalesce(error, '') ORDER BY ts, event_id) AS er"""


@query(
    "step_state_fold",
    f"""SELECT id, step, st AS status, coalesce(tr, CASE WHEN st0 IN ('done', 'failed') THEN t0 END) AS started_at, te AS completed_at,
      CASE WHEN st <> 'running' THEN nullif(er, '') END AS error FROM (SELECT id, step, {_FOLD} FROM ({_STEP_SQL}) GROUP BY 1, 2)""",
)
def q_step_state_fold(spark, sf):
    return folds.step_state_fold(step_events(spark, sf))


@query(
    "task_state_fold",
    f"""SELECT id, step, version, CASE WHEN st = 'failed' AND n + k >= 5 THEN 'dead_letter' ELSE st END AS status, n + k AS attempts, t0 AS enqueued_at,
      coalesce(tr, CASE WHEN k = 1 THEN t0 END) AS started_at, CASE WHEN tr IS NULL OR te > tr THEN te END AS completed_at,
      CASE WHEN st <> 'running' THEN nullif(er, '') END AS last_error, payload
    FROM (SELECT *, CASE WHEN st0 IN ('done', 'failed') THEN 1 ELSE 0 END AS k FROM (
      SELECT id, step, version, {_FOLD}, count(*) FILTER (status = 'running') AS n, last(payload ORDER BY ts, event_id) FILTER (payload IS NOT NULL) AS payload
      FROM ({_STEP_SQL}) GROUP BY 1, 2, 3))""",
)
def q_task_state_fold(spark, sf):
    return folds.task_state_fold(step_events(spark, sf))


_DLQ = """SELECT event_id, ts, user_id AS item_key, CASE WHEN value > 5 THEN 'stage' || event_id % 2 END AS stage, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'requeue' END AS kind,
  'err' || event_id AS error, CAST(event_id % 7 AS BIGINT) AS attempts, CASE WHEN value > 30 THEN 'p' || event_id END AS payload FROM events WHERE event_type IN ('error', 'signup')"""


@query(
    "dead_letter_fold",
    f"""WITH r AS (SELECT *, count(*) FILTER (kind = 'requeue') OVER (PARTITION BY item_key, stage ORDER BY ts, event_id) AS n FROM ({_DLQ}))
    SELECT item_key, stage, min(ts) FILTER (kind = 'fail') AS first_failed_at, max(ts) FILTER (kind = 'fail') AS last_failed_at,
      last(error ORDER BY ts, event_id) FILTER (kind = 'fail') AS error, last(attempts ORDER BY ts, event_id) FILTER (kind = 'fail') AS attempts,
      last(payload ORDER BY ts, event_id) FILTER (kind = 'fail' AND payload IS NOT NULL) AS payload, max(ts) FILTER (kind = 'requeue') AS resolved_at
    FROM r GROUP BY item_key, stage, CASE WHEN kind = 'fail' THEN n ELSE n - 1 END HAVING count(*) FILTER (kind = 'fail') > 0""",
)
def q_dead_letter_fold(spark, sf):
    eid = F.col("event_id").cast("string")
    ev = table(spark, sf, "events").filter("event_type IN ('error', 'signup')").select(
        "event_id", "ts", F.col("user_id").alias("item_key"),
        F.when(F.col("value") > 5, F.concat(F.lit("stage"), (F.col("event_id") % 2).cast("string"))).alias("stage"),
        F.when(F.col("event_type") == "error", "fail").otherwise("requeue").alias("kind"),
        F.concat(F.lit("err"), eid).alias("error"), (F.col("event_id") % 7).alias("attempts"),
        F.when(F.col("value") > 30, F.concat(F.lit("p"), eid)).alias("payload"),
    )
    return folds.dead_letter_fold(ev, ["item_key", "stage"])


_STEP_NAMES = ["captions", "isvp_fetched", "isvp", "cspan_fetched", "cspan", "testimony", "govinfo"]
_DONE = "(bool_or(l_linenumber = {} AND l_linestatus = 'F') IS TRUE)"
_OPEN = {n: "NOT " + _DONE.format(i + 1) for i, n in enumerate(_STEP_NAMES)}
_STAGE_SQL = f"""SELECT o_orderkey, CASE WHEN {_OPEN['captions']} THEN 'captions'
  WHEN (o_orderpriority = '1-URGENT' AND {_OPEN['isvp_fetched']}) OR {_OPEN['isvp']} THEN 'isvp'
  WHEN (o_orderpriority = '2-HIGH' AND {_OPEN['cspan_fetched']}) OR {_OPEN['cspan']} THEN 'cspan'
  WHEN {_OPEN['testimony']} THEN 'testimony' WHEN {_OPEN['govinfo']} THEN 'govinfo' WHEN o_orderstatus <> 'F' THEN 'publish' END AS stage
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderpriority, o_orderstatus"""


def stages(spark, sf):
    rec = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    steps = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.get(F.array(*[F.lit(n) for n in _STEP_NAMES]), F.col("l_linenumber") - 1).alias("step"),
        F.when(F.col("l_linestatus") == "F", "done").otherwise("pending").alias("status"),
    )
    return folds.initial_stage(
        rec, steps, "o_orderkey", F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH", F.col("o_orderstatus") == "F"
    )


@query("initial_stage", _STAGE_SQL)
def q_initial_stage(spark, sf):
    return stages(spark, sf).select("o_orderkey", "stage")


@query("enqueue_stats", f"SELECT stage, count(*) AS queued FROM ({_STAGE_SQL}) WHERE stage IS NOT NULL GROUP BY 1")
def q_enqueue_stats(spark, sf):
    return report.enqueue_stats(stages(spark, sf))


@query(
    "record_upsert",
    """SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN o.title ELSE n.title END AS title, coalesce(o.found_at, n.found_at) AS found_at,
      coalesce(n.ev, o.ev) AS ev, CASE WHEN o.id IS NOT NULL AND n.id IS NOT NULL THEN o.runs + 1 ELSE coalesce(o.runs, n.runs) END AS runs FROM
      (SELECT o_orderkey AS id, 'a' || o_custkey AS title, o_orderdate AS found_at, 'e' || o_orderkey AS ev, 3 AS runs FROM orders WHERE o_orderstatus <> 'P') o FULL JOIN
      (SELECT o_orderkey AS id, 'b' || o_custkey AS title, TIMESTAMP '2000-01-01' AS found_at, CASE WHEN o_orderpriority = '1-URGENT' THEN 'n' END AS ev, 1 AS runs FROM orders WHERE o_orderstatus <> 'F') n ON o.id = n.id""",
)
def q_record_upsert(spark, sf):
    orders, cust = table(spark, sf, "orders"), F.col("o_custkey").cast("string")
    key = F.col("o_orderkey")
    stored = orders.filter("o_orderstatus <> 'P'").select(
        key.alias("id"), F.concat(F.lit("a"), cust).alias("title"), F.col("o_orderdate").alias("found_at"),
        F.concat(F.lit("e"), key.cast("string")).alias("ev"), F.lit(3).alias("runs"),
    )
    new = orders.filter("o_orderstatus <> 'F'").select(
        key.alias("id"), F.concat(F.lit("b"), cust).alias("title"), F.lit("2000-01-01").cast("timestamp_ntz").alias("found_at"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "n").alias("ev"), F.lit(1).alias("runs"),
    )
    return folds.record_upsert(stored, new, "id", ["found_at"], ["ev"], ["runs"])


@query(
    "insert_if_absent",
    """SELECT user_id, event_id FROM (SELECT user_id, min(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY 1)
    UNION ALL SELECT user_id, first(event_id ORDER BY ts, event_id) FROM events WHERE event_type <> 'purchase'
      AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase') GROUP BY 1""",
)
def q_insert_if_absent(spark, sf):
    ev = table(spark, sf, "events")
    stored = ev.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    new = ev.filter("event_type <> 'purchase'").select("user_id", "event_id", "ts")
    return folds.insert_if_absent(stored, new, "user_id", ["ts", "event_id"])


_PAYLOAD = """SELECT event_id, CASE WHEN event_type = 'click' THEN 'transcript_published' ELSE event_type END AS event_type, user_id,
  CASE WHEN event_type = 'click' AND value > 2 THEN 'h' || user_id ELSE '' END AS record_id, CASE WHEN value < 30 THEN '/t/' || event_id END AS path FROM events"""
_INPUTS = f"SELECT record_id, min(event_id) AS event_id, first(path ORDER BY event_id) AS path FROM ({_PAYLOAD}) WHERE event_type = 'transcript_published' AND record_id <> '' AND path IS NOT NULL GROUP BY 1"


def inputs_and_rejects(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "click", "transcript_published").otherwise(F.col("event_type")).alias("event_type"),
        F.to_json(F.struct(
            F.when((F.col("event_type") == "click") & (F.col("value") > 2), F.concat(F.lit("h"), F.col("user_id").cast("string"))).otherwise("").alias("record_id"),
            F.when(F.col("value") < 30, F.concat(F.lit("/t/"), F.col("event_id").cast("string"))).alias("path"),
        )).alias("payload"),
    )
    return folds.events_to_inputs(ev, "transcript_published", "payload", "record_id string, path string", ["record_id", "path"], "record_id")


@query("events_to_inputs", _INPUTS)
def q_events_to_inputs(spark, sf):
    return inputs_and_rejects(spark, sf)[0].select("record_id", "event_id", "path")


@query("rejected_events", f"SELECT event_id, event_type FROM ({_PAYLOAD}) WHERE event_id NOT IN (SELECT event_id FROM ({_INPUTS}))")
def q_rejected_events(spark, sf):
    return inputs_and_rejects(spark, sf)[1].select("event_id", "event_type")


# ---------------------------------------------------------------- captions


@query(
    "parse_cues",
    """SELECT event_id, 0 AS seq, round(m / 1000.0, 3) AS start_s, round((m + 2500) / 1000.0, 3) AS end_s, event_type || ' user ' || user_id AS text FROM
      (SELECT *, (event_id * 37) % 3600000 AS m FROM events)
    UNION ALL SELECT event_id, 1, round((m + 2500) / 1000.0, 3), round((m + 4000) / 1000.0, 3), 'value ' || user_id FROM (SELECT *, (event_id * 37) % 3600000 AS m FROM events)""",
)
def q_parse_cues(spark, sf):
    def stamp(ms):
        return F.date_format(F.timestamp_millis(ms), "HH:mm:ss.SSS")

    m = (F.col("event_id") * 37) % 3600000
    user = F.col("user_id").cast("string")
    body = F.concat(
        F.lit("WEBVTT\n\n"), stamp(m), F.lit(" --> "), stamp(m + 2500), F.lit("\n"), F.col("event_type"), F.lit("\nuser "), user,
        F.lit("\n\nNOTE skipped\n"), stamp(m + 2500), F.lit(" --> "), stamp(m + 4000), F.lit(" line:0\nvalue "), user, F.lit("\n"),
        stamp(m + 4000), F.lit(" --> "), stamp(m + 5000), F.lit("\n\n"),
    )
    files = wide_table(spark, sf, "events", "event_id", "event_type", "user_id").select("event_id", body.alias("body"))
    out = captions.parse_cues(files, ["event_id"], "body")
    return out.withColumn("start_s", F.round("start_s", 3)).withColumn("end_s", F.round("end_s", 3))


# Screens of eight words that move on by three words every two seconds.
_CUES = """SELECT doc_id, i AS seq, i * 2.0 AS start_s, i * 2.0 + CASE WHEN i % 40 = 39 THEN 30.0 ELSE 2.0 END AS end_s,
    array_to_string(list_slice(w, i * 3 + 1, i * 3 + 8), ' ') AS text FROM
    (SELECT doc_id, w, unnest(range(0, (len(w) + 2) // 3)) AS i FROM (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS w FROM documents))"""
_FITS = """coalesce(list_max(list_filter(range(1, least(len(a), len(b)) + 1), lambda k: list_sum(list_transform(range(1, k + 1), lambda i:
    CASE WHEN a[len(a) - k + i] = b[i] THEN 0 WHEN starts_with(a[len(a) - k + i], b[i]) OR starts_with(b[i], a[len(a) - k + i]) THEN 1 ELSE 2 END)) <= 1)), 0)"""
_DIFF = f"""diff AS (SELECT doc_id, seq, start_s, end_s, f AS new_text FROM (SELECT *, lag(f) OVER (PARTITION BY doc_id ORDER BY end_s, start_s, seq) AS pf FROM (
      SELECT *, CASE WHEN prev IS NULL THEN text ELSE array_to_string(list_slice(b, {_FITS} + 1, len(b)), ' ') END AS f FROM (
        SELECT *, string_split(coalesce(prev, ''), ' ') AS a, string_split(text, ' ') AS b FROM (
          SELECT *, lag(text) OVER (PARTITION BY doc_id ORDER BY end_s, start_s, seq) AS prev FROM ({_CUES})) WHERE text IS DISTINCT FROM prev)) WHERE f <> '')
    WHERE f IS DISTINCT FROM pf)"""


def document_cues(spark, sf):
    from recordlink.functions.text import words

    docs = wide_table(spark, sf, "documents", "doc_id", "text").select("doc_id", words(F.col("text")).alias("w"))
    count = F.floor((F.size("w") + 2) / 3).cast("int")
    i = F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")))
    return docs.select("doc_id", "w", i.alias("seq")).select(
        "doc_id", "seq", (F.col("seq") * 2.0).alias("start_s"),
        (F.col("seq") * 2.0 + F.when(F.col("seq") % 40 == 39, 30.0).otherwise(2.0)).alias("end_s"),
        F.array_join(F.slice("w", F.col("seq") * 3 + 1, F.lit(8)), " ").alias("text"),
    )


@query("rolling_diff", f"WITH {_DIFF} SELECT doc_id, seq, end_s, new_text FROM diff")
def q_rolling_diff(spark, sf):
    return captions.rolling_diff(document_cues(spark, sf), "doc_id").drop("start_s")


@query(
    "caption_paragraphs",
    f"""WITH {_DIFF}, p AS (SELECT *, CASE WHEN end_s - lag(end_s) OVER (PARTITION BY doc_id ORDER BY end_s, seq) > 8 THEN 1 ELSE 0 END AS n FROM diff),
      g AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY end_s, seq) AS paragraph FROM p)
    SELECT doc_id, paragraph, count(*) AS fragments, min(end_s) AS first_s, max(end_s) AS last_s, CAST(sum(length(new_text)) AS BIGINT) AS chars FROM g GROUP BY 1, 2""",
)
def q_caption_paragraphs(spark, sf):
    parts = captions.caption_paragraphs(document_cues(spark, sf), "doc_id")
    return parts.groupBy("doc_id", "paragraph").agg(
        F.count("*").alias("fragments"), F.min("end_s").alias("first_s"), F.max("end_s").alias("last_s"),
        F.sum(F.length("new_text")).alias("chars"),
    )


# ---------------------------------------------------------------- chunks

_CHUNKS = """p AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: CAST(length(x) // 4 AS BIGINT)) AS sz, string_split(text, chr(10)) AS ps FROM documents),
  walk(doc_id, i, start, cut_s, cut_e) AS (
    SELECT doc_id, 0, 0, NULL::INT, NULL::INT FROM p
    UNION ALL
    SELECT doc_id, i + 1, CASE WHEN is_full THEN greatest(start, tail) ELSE start END, CASE WHEN is_full THEN start END, CASE WHEN is_full THEN i END FROM (
      SELECT w.doc_id, w.i, w.start, w.i > w.start AND coalesce(list_sum(list_slice(p.sz, w.start + 1, w.i + 1)), 0) > {size} AS is_full,
        w.i - len(list_filter(range(1, w.i + 1), lambda k: list_sum(list_slice(p.sz, w.i - k + 1, w.i)) <= {overlap})) AS tail
      FROM walk w JOIN p USING (doc_id) WHERE w.i < len(p.sz))),
  bounds AS (SELECT doc_id, cut_s AS s, cut_e AS e FROM walk WHERE cut_s IS NOT NULL
    UNION ALL SELECT doc_id, start, len(sz) FROM walk JOIN p USING (doc_id) WHERE i = len(sz)),
  chunks AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY e) - 1 AS chunk_no, array_to_string(list_slice(ps, s + 1, e), chr(10)) AS chunk FROM bounds JOIN p USING (doc_id))"""
CHUNKS = _CHUNKS.replace("{size}", "300").replace("{overlap}", "60")


@query("chunk_paragraphs", f"WITH RECURSIVE {CHUNKS} SELECT doc_id, chunk_no, chunk FROM chunks")
def q_chunk_paragraphs(spark, sf):
    return chunks.chunk_paragraphs(wide_table(spark, sf, "documents", "doc_id", "text"), ["doc_id"], "text", 300, 60, "\n")


@query(
    "chunk_requests",
    f"""WITH RECURSIVE {CHUNKS}, c AS (SELECT doc_id, chunk_no, chunk FROM chunks JOIN documents USING (doc_id) WHERE length(text) // 4 > 300
      UNION ALL SELECT doc_id, 0, text FROM documents WHERE length(text) // 4 <= 300)
    SELECT doc_id, chunk_no, count(*) OVER (PARTITION BY doc_id) AS n_chunks, CASE WHEN lang = 'en' THEN 'Recorded session' ELSE 'Title: ' || lang || ' text' || chr(10) || 'Group: ' || source END ||
      CASE WHEN count(*) OVER (PARTITION BY doc_id) > 1 THEN chr(10) || chr(10) || 'Note: This is chunk ' || (chunk_no + 1) || ' of ' || count(*) OVER (PARTITION BY doc_id) || '.' ELSE '' END || chr(10) || chr(10) || chunk AS request
    FROM c JOIN documents USING (doc_id)""",
)
def q_chunk_requests(spark, sf):
    en = F.col("lang") == "en"
    docs = wide_table(spark, sf, "documents", "doc_id", "lang", "source", "text").select(
        "doc_id", "text", F.when(~en, F.concat("lang", F.lit(" text"))).otherwise("").alias("title"), F.when(~en, F.col("source")).alias("grp")
    )
    return chunks.chunk_requests(docs, "doc_id", "text", "title", "grp", 300, 60, "\n")


@query(
    "chunk_rollup",
    f"""WITH RECURSIVE {CHUNKS} SELECT doc_id, string_agg(upper(replace(chunk, 'ß', 'ss')), chr(10) || chr(10) ORDER BY chunk_no) AS text, CAST(sum(length(chunk) // 4) AS BIGINT) AS input_tokens,
      CAST(sum(length(chunk) // 8) AS BIGINT) AS output_tokens, count(*) AS chunks_processed,
      CAST(CAST((CAST(sum(length(chunk) // 4) AS DECIMAL(12,0)) * 0.500 + CAST(sum(length(chunk) // 8) AS DECIMAL(12,0)) * 3.000) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(18,6)) AS DOUBLE) AS cost_usd
    FROM chunks GROUP BY 1""",
)
def q_chunk_rollup(spark, sf):
    parts = chunks.chunk_paragraphs(wide_table(spark, sf, "documents", "doc_id", "text"), ["doc_id"], "text", 300, 60, "\n").select(
        "doc_id", "chunk_no", F.upper(F.replace("chunk", F.lit("ß"), F.lit("ss"))).alias("cleaned"),
        estimate_tokens(F.col("chunk")).alias("tin"), F.floor(F.length("chunk") / 8).cast("bigint").alias("tout"),
    )
    docs = chunks.chunk_rollup(parts, "doc_id", "chunk_no", "cleaned", "tin", "tout")
    docs = docs.withColumn("model", F.lit("google/gemini-3-flash-preview"))
    return token_cost(docs, "model", "input_tokens", "output_tokens").drop("model")


_VALID = "role <> 'system' AND turn % 5 <> 4 AND text <> ''"


def answers(spark, sf):
    """JSON answers in the shapes a service returns: fenced, bare, not an array, broken, without a quote."""
    obj = F.to_json(F.struct(
        F.when(F.col("turn") % 5 != 4, F.col("text")).alias("quote"),
        F.when(F.col("role") == "user", F.col("role")).alias("speaker"), F.lit("said").alias("context"),
    ))
    raw = F.when(F.col("role") == "system", obj).when(
        F.col("turn") % 3 == 0, F.concat(F.lit("```json\n["), obj, F.lit(", 7]\n```"))
    ).otherwise(F.concat(F.lit(" ["), obj, F.lit("] ")))
    return table(spark, sf, "conversations").select("conv_id", "turn", raw.alias("raw"))


@query(
    "parse_json_answer",
    f"SELECT conv_id, turn, 0::BIGINT AS item_no, text AS quote, CASE WHEN role = 'user' THEN role ELSE 'Unknown' END AS speaker, 'said' AS context FROM conversations WHERE {_VALID}",
)
def q_parse_json_answer(spark, sf):
    return chunks.parse_json_answer(
        answers(spark, sf), ["conv_id", "turn"], "raw", ["quote", "speaker", "context"], "quote", {"speaker": "Unknown", "context": ""}
    )


@query(
    "quote_extract",
    f"""SELECT conv_id, text AS quote, CASE WHEN role = 'user' THEN role ELSE 'Unknown' END AS speaker, 'session ' || conv_id AS title,
      CASE WHEN conv_id % 3 = 0 THEN 'tv' || conv_id WHEN conv_id % 3 = 1 THEN 'https://v.example.org/watch?v=' || conv_id ELSE '' END AS source_url FROM conversations WHERE {_VALID}""",
)
def q_quote_extract(spark, sf):
    cid = F.col("conv_id").cast("string")
    rec = table(spark, sf, "conversations").select("conv_id").distinct().select(
        "conv_id", F.concat(F.lit("session "), cid).alias("title"),
        F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("tv"), cid)).alias("tv_url"), F.when(F.col("conv_id") % 3 == 1, cid).alias("vid"),
    )
    urls = [("tv", F.col("tv_url")), ("id", F.concat(F.lit("https://v.example.org/watch?v="), F.col("vid")))]
    return chunks.quote_extract(answers(spark, sf), rec, "conv_id", "raw", urls).select("conv_id", "quote", "speaker", "title", "source_url")
