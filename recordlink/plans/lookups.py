"""Queries over filters, lookups and identity joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions import text
from recordlink.operators import filters, lookup
from recordlink.plans import sqltext as s
from recordlink.plans.registry import query, table, wide_table

# ---------------------------------------------------------------- filters


@query(
    "tier_filter",
    "SELECT s_suppkey, tier FROM (SELECT s_suppkey, CASE WHEN s_acctbal > 8000 THEN 1 WHEN s_acctbal > 4000 THEN 2 WHEN s_acctbal > 2000 THEN 3 END AS tier FROM supplier) WHERE coalesce(tier, 3) <= 2",
)
def q_tier_filter(spark, sf):
    tier = F.expr("CASE WHEN s_acctbal > 8000 THEN 1 WHEN s_acctbal > 4000 THEN 2 WHEN s_acctbal > 2000 THEN 3 END")
    return filters.tier_filter(table(spark, sf, "supplier").select("s_suppkey", tier.alias("tier")), "tier")


_PROC_TITLE = "CASE WHEN lang = 'de' THEN 'Business Meeting: ' || text WHEN lang = 'es' THEN 'Full Committee Markup, ' || text ELSE text END"


@query(
    "procedural_filter",
    f"""SELECT doc_id, lang FROM documents WHERE source IN ('src1', 'src2') OR NOT regexp_matches(lower({_PROC_TITLE}), '{'|'.join(fv.PROCEDURAL_PHRASES)}')""",
)
def q_procedural_filter(spark, sf):
    docs = table(spark, sf, "documents").withColumn("title", F.expr(_PROC_TITLE))
    return filters.procedural_filter(docs, "title", F.col("source").isin("src1", "src2")).select("doc_id", "lang")


_CLIP_TITLE = "CASE event_type WHEN 'signup' THEN 'Chair Delivers Opening Statement ' || event_id WHEN 'click' THEN 'Press Conference ' || event_id ELSE 'Session ' || event_id END"


@query(
    "route_clips",
    f"""SELECT event_id, title, CASE WHEN event_type IN ('signup', 'click') OR floor(value * 100) < 600 THEN 'clip' ELSE 'record' END AS route
    FROM (SELECT *, {_CLIP_TITLE} AS title FROM events)""",
)
def q_route_clips(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id", F.expr(_CLIP_TITLE).alias("title"), F.floor(F.col("value") * 100).alias("duration")
    )
    recs, clips = filters.route_clips(ev, "title", "duration")
    both = recs.withColumn("route", F.lit("record")).unionByName(clips.withColumn("route", F.lit("clip")))
    return both.drop("duration")


_PREFIX_TITLE = "CASE WHEN p_type = 'ECONOMY' THEN 'Washington Today ' || p_name WHEN p_type = 'SMALL' THEN 'Lectures in History: ' || p_name ELSE p_name || ' booknotes' END"


@query(
    "prefix_blocklist",
    f"""SELECT p_partkey, title FROM (SELECT *, {_PREFIX_TITLE} AS title FROM part)
    WHERE NOT (starts_with(lower(title), 'washington today') OR starts_with(lower(title), 'lectures in history:')) AND p_size * 100 >= 1800""",
)
def q_prefix_blocklist(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.expr(_PREFIX_TITLE).alias("title"), (F.col("p_size") * 100).alias("duration"))
    return filters.prefix_blocklist(part, "title", "duration").drop("duration")


_STUB_TITLE = "CASE WHEN o_orderpriority = '5-LOW' THEN '  TBD ' ELSE 'Session on ' || o_orderpriority END"


@query(
    "placeholder_filter",
    f"""SELECT o_orderkey, title, event_date FROM (SELECT o_orderkey, o_orderstatus, {_STUB_TITLE} AS title, CAST(o_orderdate AS DATE) AS event_date FROM orders)
    WHERE o_orderstatus <> 'P' AND length(trim(title)) >= 5 AND event_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-01' + 30""",
)
def q_placeholder_filter(spark, sf):
    rec = table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr("CASE o_orderstatus WHEN 'P' THEN 'Postponed' ELSE 'Scheduled' END").alias("status"),
        F.expr(_STUB_TITLE).alias("title"),
        F.col("o_orderdate").cast("date").alias("event_date"),
    )
    return filters.placeholder_filter(rec, "status", "title", "event_date", "1997-01-01", "1998-06-01").drop("status")


@query(
    "needs_work",
    """SELECT o_orderkey, o_orderstatus FROM (
      SELECT o.o_orderkey, o.o_orderstatus, o.o_orderpriority,
        coalesce(bool_or(l.l_returnflag = 'A' AND l.l_linestatus = 'F'), FALSE) AS tv_done,
        coalesce(bool_or(l.l_returnflag = 'R' AND l.l_linestatus = 'F'), FALSE) AS stream_done
      FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2, 3)
    WHERE o_orderstatus <> 'F' OR (o_orderpriority = '1-URGENT' AND NOT tv_done) OR (o_orderpriority = '2-HIGH' AND NOT stream_done)""",
)
def q_needs_work(spark, sf):
    rec = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderpriority") == "1-URGENT", "tv").alias("tv_url"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "stream").alias("stream_comm"),
    )
    steps = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.expr("CASE l_returnflag WHEN 'A' THEN 'tv_fetched' WHEN 'R' THEN 'stream_fetched' ELSE 'captions' END").alias("step"),
        F.expr("CASE l_linestatus WHEN 'F' THEN 'done' ELSE 'pending' END").alias("status"),
    )
    out = filters.needs_work(
        rec, steps, "o_orderkey", F.col("o_orderstatus") == "F", [("tv_url", "tv_fetched"), ("stream_comm", "stream_fetched")]
    )
    return out.select("o_orderkey", "o_orderstatus")


@query(
    "split_by_date",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date, CAST(o_orderdate AS DATE) <= DATE '1998-06-01' AS is_past FROM orders",
)
def q_split_by_date(spark, sf):
    rec = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("event_date"))
    return filters.split_by_date(rec, "event_date", "1998-06-01")


@query(
    "key_lookup",
    "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type = 'purchase' AS processed FROM events WHERE user_id = 42",
)
def q_key_lookup(spark, sf):
    hit = filters.key_lookup(table(spark, sf, "events"), "user_id", 42, {"props": "k bigint"})
    return hit.select("event_id", "user_id", F.col("props.k").alias("k"), (F.col("event_type") == "purchase").alias("processed"))


@query(
    "lookback_window",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01' - INTERVAL 120 DAY",
)
def q_lookback_window(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return filters.lookback_window(orders, "o_orderdate", "1998-06-01", 120, 30)


# ---------------------------------------------------------------- lookups


@query(
    "code_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, first(key ORDER BY pos, lvl, key) AS key FROM (
      SELECT i.l_orderkey, i.l_linenumber, i.l_partkey, pos, lvl, p_name || '#' || p_partkey AS key FROM (
        SELECT *, 0 AS lvl, code AS probe FROM (
          SELECT l_orderkey, l_linenumber, l_partkey, unnest([1, 2]) AS pos, unnest(['zz' || l_suppkey, lpad(CAST(l_partkey AS VARCHAR), 4, '0') || CASE WHEN l_linenumber > 3 THEN '07' ELSE '00' END]) AS code FROM lineitem)
        UNION ALL SELECT *, 1, left(code, 4) || '00' FROM (
          SELECT l_orderkey, l_linenumber, l_partkey, unnest([1, 2]) AS pos, unnest(['zz' || l_suppkey, lpad(CAST(l_partkey AS VARCHAR), 4, '0') || CASE WHEN l_linenumber > 3 THEN '07' ELSE '00' END]) AS code FROM lineitem)
      ) i JOIN (SELECT * FROM part WHERE p_type <> 'SMALL') ON probe = left(lpad(CAST(p_partkey AS VARCHAR), 4, '0'), 4) || '00')
    GROUP BY ALL HAVING key IS NOT NULL""",
)
def q_code_lookup(spark, sf):
    code = F.concat(
        F.lpad(F.col("l_partkey").cast("string"), 4, "0"), F.when(F.col("l_linenumber") > 3, "07").otherwise("00")
    )
    items = wide_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").select(
        F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("item"),
        F.array(F.concat(F.lit("zz"), F.col("l_suppkey").cast("string")), code).alias("codes"),
    )
    dim = table(spark, sf, "part").filter("p_type <> 'SMALL'").select(
        F.concat(F.lpad(F.col("p_partkey").cast("string"), 4, "0"), F.lit("00")).alias("code"),
        F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string")).alias("k"),
    )
    out = lookup.code_lookup(items, "item", "codes", dim, "code", "k")
    return out.select("item.*", "key")


_FRAG_TITLE = """CASE p_type WHEN 'ECONOMY' THEN 'Hearing before the Committee on the ' || p_name || ', United States Body'
  WHEN 'SMALL' THEN 'COMMITTEE ON ' || p_name || ' and ' || p_brand ELSE p_brand || ' outlook for the ' || p_name || 's' END"""
_FRAG_GROUP = "CASE WHEN p_size < 20 THEN 'house' WHEN p_size < 40 THEN 'senate' ELSE 'unknown' END"
_FRAG_DIM = """SELECT DISTINCT CASE WHEN p_size < 6 THEN p_name ELSE split_part(p_name, ' ', 2) END AS f,
  CASE WHEN p_size % 2 = 0 THEN 'senate.' ELSE 'house.' END || replace(p_name, ' ', '_') AS k FROM part WHERE p_type = 'ECONOMY'"""
_ON = "'COMMITTEE\\s+ON\\s+(.+?)(?:\\s*[-—,]\\s*(?:UNITED\\s+STATES|U\\.S\\.)|$)'"


@query(
    "fragment_match",
    f"""WITH items AS (SELECT p_partkey, {_FRAG_GROUP} AS g, upper({_FRAG_TITLE}) AS u FROM part),
      s AS (SELECT *, CASE WHEN regexp_matches(u, {_ON}) THEN trim(regexp_extract(u, {_ON}, 1)) ELSE u END AS t FROM items),
      c AS (SELECT p_partkey, g, unnest([1, 2, 3]) AS pos, lower(unnest([regexp_replace(t, '^THE\\s+', ''), t, u])) AS txt FROM s),
      dim AS ({_FRAG_DIM}),
      best AS (SELECT p_partkey, first(k ORDER BY pos, length(f) DESC, f, k) AS matched_key FROM c JOIN dim
        ON contains(txt, f) AND (g = 'unknown' OR starts_with(k, g || '.')) GROUP BY p_partkey)
    SELECT p_partkey, matched_key, coalesce(matched_key, 'govinfo.' || g) AS key FROM items LEFT JOIN best USING (p_partkey)""",
)
def q_fragment_match(spark, sf):
    part = table(spark, sf, "part")
    items = wide_table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size").select(
        "p_partkey", F.expr(_FRAG_GROUP).alias("g"), F.expr(_FRAG_TITLE).alias("title")
    )
    dim = part.filter("p_type = 'ECONOMY'").select(
        F.expr("CASE WHEN p_size < 6 THEN p_name ELSE split_part(p_name, ' ', 2) END").alias("f"),
        F.expr("CASE WHEN p_size % 2 = 0 THEN 'senate.' ELSE 'house.' END || replace(p_name, ' ', '_')").alias("k"),
    ).distinct()
    return lookup.fragment_match(items, "p_partkey", "title", "g", dim, "f", "k").select("p_partkey", "matched_key", "key")


@query(
    "dim_default_join",
    """SELECT c_custkey, k, coalesce(n_name, k) AS block_name FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'X' ELSE '' END || c_nationkey AS k FROM customer)
    LEFT JOIN nation ON k = CAST(n_nationkey AS VARCHAR)""",
)
def q_dim_default_join(spark, sf):
    cust = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.when(F.col("c_acctbal") < 0, "X").otherwise(""), F.col("c_nationkey").cast("string")).alias("k")
    )
    dim = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("nk"), "n_name")
    return lookup.dim_default_join(cust, "k", dim, "nk", "n_name")


@query(
    "attach_by_id",
    """SELECT o_orderkey, coalesce(u, CASE WHEN o_orderstatus = 'O' THEN 'old' END) AS url FROM orders
    LEFT JOIN (SELECT l_orderkey, max('tv' || l_partkey) AS u FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON o_orderkey = l_orderkey""",
)
def q_attach_by_id(spark, sf):
    rec = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "old").alias("url"))
    found = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"), F.concat(F.lit("tv"), F.col("l_partkey").cast("string")).alias("url")
    )
    return lookup.attach_by_id(rec, found, "o_orderkey", "url")


@query(
    "rekey_children",
    """SELECT id, step, first(status ORDER BY moved, src) AS status FROM (
      SELECT coalesce(m.new_id, c.l_orderkey) AS id, c.l_orderkey AS src, step, status, CASE WHEN m.new_id IS NULL THEN 0 ELSE 1 END AS moved FROM
        (SELECT l_orderkey, l_linenumber AS step, min(l_linestatus) AS status FROM lineitem GROUP BY 1, 2) c
        LEFT JOIN (SELECT o_orderkey AS old_id, o_custkey AS new_id FROM orders WHERE o_orderstatus = 'P') m ON c.l_orderkey = m.old_id)
    GROUP BY id, step""",
)
def q_rekey_children(spark, sf):
    child = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("step")).agg(
        F.min("l_linestatus").alias("status")
    )
    mapping = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("old_id"), F.col("o_custkey").alias("new_id")
    )
    return lookup.rekey_children(child, mapping, "id", ["step"])


@query(
    "rotation_queue",
    """SELECT c_custkey, last_searched, CAST(floor(epoch(TIMESTAMP '1999-01-01' - last_searched) / 86400) AS BIGINT) AS age_days FROM customer
    LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_searched FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON o_custkey = c_custkey
    WHERE last_searched IS NULL OR floor(epoch(TIMESTAMP '1999-01-01' - last_searched) / 86400) >= 5
    ORDER BY last_searched NULLS FIRST, c_custkey LIMIT 40""",
)
def q_rotation_queue(spark, sf):
    searches = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    return lookup.rotation_queue(table(spark, sf, "customer"), searches, "c_custkey", "o_orderdate", "1999-01-01", 5, 40)


@query(
    "skip_done",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') ORDER BY c_custkey LIMIT 25",
)
def q_skip_done(spark, sf):
    done = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return lookup.skip_done(table(spark, sf, "customer").select("c_custkey", "c_name"), done, "c_custkey", ["c_custkey"], 25)


@query(
    "duplicate_backfill",
    """WITH r AS (SELECT o_orderkey AS id, o_custkey, date_trunc('month', o_orderdate) AS m, CASE WHEN o_orderstatus = 'F' THEN 'e' || o_orderkey ELSE '' END AS ev FROM orders),
      w AS (SELECT o_custkey, m, min(id) FILTER (ev <> '') AS winner FROM r GROUP BY 1, 2 HAVING count(*) > 1 AND winner IS NOT NULL),
      l AS (SELECT winner, id AS loser FROM r JOIN w USING (o_custkey, m) WHERE ev = '')
    SELECT winner, loser, 'src=' || max(loser) OVER (PARTITION BY winner) || ',w' || winner || '=x' AS merged FROM l""",
)
def q_duplicate_backfill(spark, sf):
    oid = F.col("o_orderkey").cast("string")
    rec = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), "o_custkey", F.date_trunc("month", "o_orderdate").alias("m"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("e"), oid)).otherwise("").alias("ev"),
        F.when(F.col("o_orderstatus") == "F", F.create_map(F.lit("src"), oid, F.concat(F.lit("w"), oid), F.lit("x")))
        .otherwise(F.create_map(F.lit("src"), oid)).alias("sources"),
    )
    out = lookup.duplicate_backfill(rec, ["o_custkey", "m"], "id", "ev", "sources")
    merged = F.array_join(F.transform(F.map_entries("merged_sources"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return out.select("winner", "loser", merged.alias("merged"))
