"""Queries over entity resolution and similarity attachment."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlink.functions import text
from recordlink.operators import attach, resolve
from recordlink.plans import resolvesql
from recordlink.plans import sqltext as s
from recordlink.plans.bindings import base_records, record_list
from recordlink.plans.registry import query, table
from recordlink.session import materialize

WITH = f"WITH RECURSIVE {s.RECORDS}"


def sources_text(df):
    """The merged source map as sorted `name=value` text."""
    entries = F.transform(F.map_entries("sources"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return df.withColumn("sources", F.array_join(F.array_sort(entries), ","))


def merged_sql(source: str, cluster: str) -> str:
    """Merge of the rows of `source` per cluster expression."""
    return f"""SELECT c AS cluster, rec, block_key, title, event_date, authority, has_video, n_merged, srcs AS sources FROM (
      SELECT c, first(rec ORDER BY authority DESC, rec) AS rec,
        first(block_key ORDER BY starts_with(block_key, 'govinfo.'), authority DESC, rec) AS block_key,
        first(title ORDER BY authority DESC, length(title) DESC, rec) AS title, min(event_date) AS event_date,
        max(authority) AS authority, bool_or(has_video) AS has_video, count(*) AS n_merged
      FROM (SELECT *, {cluster} AS c FROM {source}) GROUP BY c) JOIN (
      SELECT c, string_agg(source || '=' || v, ',' ORDER BY source || '=' || v) AS srcs FROM (
        SELECT {cluster} AS c, source, last(source_value ORDER BY authority DESC, rec) AS v FROM {source} GROUP BY 1, 2) GROUP BY c) USING (c)"""


@query(
    "dedup_exact",
    f"{WITH} SELECT * EXCLUDE (cluster) FROM ({merged_sql('records', 'concat_ws(chr(31), block_key, event_date, ' + s.norm_title('title') + ')')})",
)
def q_dedup_exact(spark, sf):
    return sources_text(resolve.dedup_exact(record_list(spark, sf)))


@query("merge_records", f"{WITH} {merged_sql('records', 'block_key || event_date')}")
def q_merge_records(spark, sf):
    rec = record_list(spark, sf).withColumn("cluster", F.concat("block_key", F.date_format("event_date", "yyyy-MM-dd")))
    return sources_text(resolve.merge_records(rec, "cluster"))


@query(
    "best_title",
    f"""{WITH} SELECT block_key, event_date, first(title ORDER BY authority DESC, length(title) DESC, rec) AS title, max(authority) AS authority
    FROM records GROUP BY 1, 2""",
)
def q_best_title(spark, sf):
    return record_list(spark, sf).groupBy("block_key", "event_date").agg(
        resolve.best_title().alias("title"), F.max("authority").alias("authority")
    )


NODES = f""", nodes AS (SELECT block_key, event_date, toks, first(rec ORDER BY authority DESC, rec) AS node, bool_or(has_video) AS video
    FROM (SELECT *, {s.token_set('title')} AS toks FROM records) GROUP BY 1, 2, 3),
  day_pairs AS (SELECT x.node AS a, y.node AS b, {s.jaccard('x.toks', 'y.toks')} AS sim FROM nodes x JOIN nodes y
    ON x.block_key = y.block_key AND y.event_date = x.event_date + 1 WHERE (x.video OR y.video) AND {s.jaccard('x.toks', 'y.toks')} >= 0.45)"""


@query("adjacent_day_pairs", f"{WITH}{NODES} SELECT a, b, round(sim, 4) AS sim FROM day_pairs")
def q_adjacent_day_pairs(spark, sf):
    pairs = resolve.adjacent_day_pairs(record_list(spark, sf))
    return pairs.withColumn("sim", F.round("sim", 4))


@query(
    "connected_clusters",
    f"""{WITH}{NODES}, e AS (SELECT a, b FROM day_pairs UNION SELECT b, a FROM day_pairs),
    reach(rec, other) AS (SELECT rec, rec FROM records UNION SELECT reach.rec, e.b FROM reach JOIN e ON reach.other = e.a)
    SELECT rec, min(other) AS cluster FROM reach GROUP BY rec""",
)
def q_connected_clusters(spark, sf):
    rec = record_list(spark, sf)
    return resolve.connected_clusters(rec, resolve.adjacent_day_pairs(rec), "rec")


@query(
    "cross_key_pairs",
    f"""{WITH}, n AS (SELECT event_date, g, toks, block_key, first(rec ORDER BY authority DESC, rec) AS node, first((-authority, rec) ORDER BY authority DESC, rec) AS p
      FROM (SELECT *, {s.token_set('title')} AS toks,
        CASE WHEN starts_with(block_key, 'govinfo.') THEN split_part(block_key, '.', 2) ELSE split_part(block_key, '.', 1) END AS g FROM records)
      GROUP BY 1, 2, 3, 4),
    h AS (SELECT event_date, g, toks, first(node ORDER BY p) AS n1, first(block_key ORDER BY p) AS k1 FROM n GROUP BY 1, 2, 3),
    o AS (SELECT n.*, n1, k1 FROM n JOIN h USING (event_date, g, toks) WHERE block_key <> k1),
    f AS (SELECT h.*, n2, k2 FROM h LEFT JOIN (SELECT event_date, g, toks, first(node ORDER BY p) AS n2, first(block_key ORDER BY p) AS k2 FROM o GROUP BY 1, 2, 3) USING (event_date, g, toks)),
    l AS (SELECT x.n1 AS xn1, x.k1 AS xk1, x.n2 AS xn2, y.n1 AS yn1, y.k1 AS yk1, y.n2 AS yn2, {s.jaccard('x.toks', 'y.toks')} AS sim
      FROM f x JOIN f y ON x.event_date = y.event_date AND x.g = y.g AND x.n1 < y.n1),
    r AS (SELECT sim, CASE WHEN xk1 <> yk1 THEN xn1 WHEN xn2 IS NOT NULL THEN xn2 ELSE xn1 END AS a,
      CASE WHEN xk1 <> yk1 THEN yn1 WHEN xn2 IS NOT NULL THEN yn1 ELSE yn2 END AS b FROM l WHERE sim > 0.4)
    SELECT least(a, b) AS a, greatest(a, b) AS b, round(sim, 4) AS sim FROM r WHERE b IS NOT NULL
    UNION ALL SELECT least(node, n1), greatest(node, n1), 1.0 FROM o""",
)
def q_cross_key_pairs(spark, sf):
    return resolve.cross_key_pairs(record_list(spark, sf)).withColumn("sim", F.round("sim", 4))


@query("dedup_fuzzy", resolvesql.DEDUP)
def q_dedup_fuzzy(spark, sf):
    return sources_text(resolve.dedup_fuzzy(record_list(spark, sf)))


@query("resolve_all", resolvesql.RESOLVE)
def q_resolve_all(spark, sf):
    """Flagship: three overlapping sources, and all that is attached to them, to one row per event."""
    base = materialize(base_records(spark, sf))  # read by all suppliers
    rec = record_list(spark, sf, base)
    number = F.col("o_orderkey")

    def named(prefix, suffix=""):
        return F.concat(F.lit(prefix), number.cast("string"), F.lit(suffix))

    clips = base.filter("o_orderstatus = 'P'").select(
        number.alias("clip"), F.col("k").alias("block_key"), F.col("d").alias("event_date"), F.concat(F.lit("Opening statement "), "t").alias("title"),
        named("clip").alias("url"), F.when(number % 2 == 0, 2000).otherwise(600).alias("duration"),
    )
    nation = F.col("n_nationkey")
    dim = table(spark, sf, "nation").filter("n_nationkey % 5 <> 3").select(  # smaller than the keys present
        F.concat(F.when(nation < 12, "house.n").otherwise("senate.n"), nation.cast("string")).alias("k"),
        "n_name", F.concat(F.lit("n"), nation.cast("string")).alias("code"), (nation % 2 == 0).alias("scrape"),
    )
    streams = base.filter("o_orderpriority = '1-URGENT'").select(
        number.alias("stream"), F.col("d").alias("event_date"), F.concat(F.lit("Whole session "), "t").alias("title"), named("stream").alias("url"), F.lit(3600).alias("duration"),
    )
    found = base.filter("o_orderkey % 7 = 0").select(text.record_id(F.col("k"), F.col("d"), F.col("t")).alias("record_id"), named("found").alias("url"))
    broadcasts = base.filter("o_orderpriority = '3-MEDIUM'").select(
        number.alias("video"), F.col("k").alias("block_key"), F.col("d").alias("event_date"), F.concat(F.lit("Broadcast of "), "t").alias("title"), named("cast").alias("url"),
    )
    player = number % 5 == 0
    details = base.filter("o_orderkey % 3 = 0").select(
        named("https://site.example.org/").alias("url"), F.when(number % 2 == 0, F.array(named("https://d.example.org/", ".pdf"))).otherwise(F.array().cast("array<string>")).alias("pdf_urls"),
        F.when(F.col("o_orderstatus") == "O", named("y")).alias("embed_id"), F.when(player, named("p")).alias("stream_comm"), F.when(player, named("f")).alias("stream_file"),
    )
    out = resolve.resolve_all(
        rec, dim, "k", "n_name", "code", "1997-01-01", clips=clips, streams=streams, found=found, broadcasts=broadcasts, details=details, dim_scrape="scrape"
    )
    return sources_text(out).withColumn("pdf_urls", F.array_join("pdf_urls", "|")).select(
        "record_id", "rec", "block_key", "block_name", "title", "event_date", "authority", "sources", "video_url", "video_duration", "n_clips",
        "broadcast_url", "pdf_urls", "stream_comm", "stream_file", "slug",
    )


# ---------------------------------------------------------------- attachment

CLIPS = f"""{s.RECORDS}, recs AS (SELECT o_orderkey AS rec, k, d, t, CASE WHEN o_orderpriority = '1-URGENT' THEN 'own' ELSE '' END AS url,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 2400 WHEN o_orderpriority = '2-HIGH' THEN 900 END AS dur FROM base WHERE o_orderstatus <> 'P'),
  clips AS (SELECT o_orderkey AS clip, k, d, 'Opening statement ' || t AS ct, 'clip' || o_orderkey AS u FROM base WHERE o_orderstatus <> 'F')"""


def rec_and_clips(spark, sf):
    base = materialize(base_records(spark, sf))  # read by both sides, several times
    key, urgent = F.col("o_orderkey"), F.col("o_orderpriority") == "1-URGENT"
    recs = base.filter("o_orderstatus <> 'P'").select(
        key.alias("rec"), "k", "d", "t", F.when(urgent, "own").otherwise("").alias("url"),
        F.when(urgent, 2400).when(F.col("o_orderpriority") == "2-HIGH", 900).alias("dur"),
    )
    clips = base.filter("o_orderstatus <> 'F'").select(
        key.alias("clip"), "k", "d", F.concat(F.lit("Opening statement "), "t").alias("ct"),
        F.concat(F.lit("clip"), key.cast("string")).alias("u"), F.lit(2000).alias("ud"),
    )
    return recs, clips


def best_sql(on: str, thr: float, where: str = "TRUE") -> str:
    sim = s.jaccard("rt", "ctk")
    return f"""m AS (SELECT clip, u, first(rec ORDER BY sim DESC, rec) AS rec, max(sim) AS sim FROM (
      SELECT clip, u, rec, {sim} AS sim FROM (SELECT *, {s.token_set('t')} AS rt FROM recs WHERE {where}) r
      JOIN (SELECT *, {s.token_set('ct')} AS ctk FROM clips) c ON {on}) WHERE sim >= {thr} GROUP BY 1, 2)"""


@query(
    "attach_best_similar",
    f"""WITH {CLIPS}, {best_sql('r.k = c.k AND r.d = c.d', 0.15)}
    SELECT recs.rec, coalesce(nullif(url, ''), u1) AS url, coalesce(n, 0) AS n_clips FROM recs
    LEFT JOIN (SELECT rec, first(u ORDER BY clip) AS u1, count(*) AS n FROM m GROUP BY 1) x ON recs.rec = x.rec""",
)
def q_attach_best_similar(spark, sf):
    recs, clips = rec_and_clips(spark, sf)
    out, _ = attach.attach_best_similar(recs, clips, "k", "d", "t", "rec", "url", "ct", "clip", "u")
    return out.select("rec", "url", "n_clips")


@query(
    "attached_clips",
    f"""WITH {CLIPS}, {best_sql('r.k = c.k AND r.d = c.d', 0.15)} SELECT rec AS record, clip AS video, m.u AS clip_url, ct AS clip_title, 2000 AS clip_duration, round(sim, 4) AS sim FROM m JOIN clips USING (clip)""",
)
def q_attached_clips(spark, sf):
    recs, clips = rec_and_clips(spark, sf)
    _, listed = attach.attach_best_similar(recs, clips, "k", "d", "t", "rec", "url", "ct", "clip", "u", clip_duration="ud")
    return listed.withColumn("sim", F.round("sim", 4))


_SIMILAR = f"""p AS (SELECT * FROM (SELECT c.d, clip, rec, {s.jaccard('rt', 'ctk')} AS sim FROM (SELECT *, {s.token_set('t')} AS rt FROM recs WHERE NOT (url <> '' AND coalesce(dur, 0) >= 1800)) r
    JOIN (SELECT *, {s.token_set('ct')} AS ctk FROM clips) c ON r.d = c.d) WHERE sim >= 0.10)"""


@query(
    "attach_date_similar",
    # one stream after the other, each with the list of records that are gone
    f"""WITH RECURSIVE {CLIPS}, {_SIMILAR}, v AS (SELECT d, clip, u, row_number() OVER (PARTITION BY d ORDER BY clip) AS i FROM clips),
    s(d, i, clip, gone, won) AS (
      SELECT DISTINCT d, 0::BIGINT, NULL::BIGINT, []::BIGINT[], NULL::BIGINT FROM v
      UNION ALL
      SELECT d, i, clip, CASE WHEN won IS NULL THEN gone ELSE list_append(gone, won) END, won FROM (
        SELECT s.d, v.i, v.clip, s.gone, first(p.rec ORDER BY p.sim DESC, p.rec) FILTER (p.rec IS NOT NULL AND NOT list_contains(s.gone, p.rec)) AS won
        FROM s JOIN v ON v.d = s.d AND v.i = s.i + 1 LEFT JOIN p ON p.clip = v.clip GROUP BY 1, 2, 3, 4))
    SELECT recs.rec, coalesce(x.u, url) AS url, CASE WHEN x.u IS NULL THEN dur ELSE 2000 END AS dur FROM recs
    LEFT JOIN (SELECT won, u FROM s JOIN clips USING (clip) WHERE won IS NOT NULL) x ON recs.rec = x.won""",
)
def q_attach_date_similar(spark, sf):
    recs, clips = rec_and_clips(spark, sf)
    out = attach.attach_date_similar(recs, clips, "d", "t", "rec", "url", "dur", "ct", "clip", "u", "ud")
    return out.select("rec", "url", "dur")


_SHARED = f"CAST(len(list_intersect(list_distinct({s.significant('t')}), list_distinct({s.significant('ct')}))) AS BIGINT)"
_TIERS = f"""cand AS (SELECT clip, u, rec, CASE WHEN r.k = c.k THEN 0 ELSE 1 END AS tier, {_SHARED} AS shared FROM recs r JOIN clips c ON r.d = c.d),
  m AS (SELECT clip, u, first(rec ORDER BY tier, shared DESC, rec) AS rec FROM cand GROUP BY 1, 2)"""


@query(
    "attach_two_tier",
    f"""WITH {CLIPS}, {_TIERS} SELECT recs.rec, coalesce(nullif(url, ''), u1) AS url FROM recs
    LEFT JOIN (SELECT rec, first(u ORDER BY clip) AS u1 FROM m GROUP BY 1) x ON recs.rec = x.rec""",
)
def q_attach_two_tier(spark, sf):
    recs, clips = rec_and_clips(spark, sf)
    out, _ = attach.attach_two_tier(recs, clips, "k", "d", "t", "rec", "url", "ct", "clip", "u")
    return out.select("rec", "url")


@query("unmatched_videos", f"WITH {CLIPS} SELECT clip, u FROM clips WHERE d NOT IN (SELECT d FROM recs)")
def q_unmatched_videos(spark, sf):
    recs, clips = rec_and_clips(spark, sf)
    return attach.unmatched_videos(recs, attach.usable_videos(clips, "u", "d"), "d").select("clip", "u")


_NEW = """SELECT o_orderkey * 2 AS id, k, d, 'Annual ' || t AS t, CASE WHEN o_orderstatus = 'F' THEN 'e' || o_orderkey ELSE '' END AS ev FROM base"""
_OLD = """SELECT o_orderkey * 2 + CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS id, k, d, t,
  CASE WHEN o_orderstatus <> 'P' THEN 'e' || o_orderkey ELSE '' END AS ev FROM base"""


@query(
    "reconcile_ids",
    f"""WITH {s.RECORDS}, new AS ({_NEW}), old AS ({_OLD}),
      e AS (SELECT min(old.id) AS old_id, new.id AS new_id, 'event_id' AS rule FROM new JOIN old ON new.ev = old.ev AND new.ev <> '' GROUP BY new.id HAVING min(old.id) <> new.id),
      p AS (SELECT min(o.id) AS old_id, n.id AS new_id, 'title' AS rule FROM (SELECT *, {s.token_set('t')} AS nt FROM new) n JOIN (SELECT *, {s.token_set('t')} AS ot FROM old) o
        ON n.k = o.k AND n.d = o.d AND n.id <> o.id WHERE n.id NOT IN (SELECT new_id FROM e) AND {s.jaccard('nt', 'ot')} >= 0.30 GROUP BY n.id)
    SELECT * FROM e UNION ALL SELECT * FROM p""",
)
def q_reconcile_ids(spark, sf):
    base = base_records(spark, sf)
    eid = F.concat(F.lit("e"), F.col("o_orderkey").cast("string"))
    new = base.select(
        (F.col("o_orderkey") * 2).alias("id"), "k", "d", F.concat(F.lit("Annual "), "t").alias("t"),
        F.when(F.col("o_orderstatus") == "F", eid).otherwise("").alias("ev"),
    )
    old = base.select(
        (F.col("o_orderkey") * 2 + F.when(F.col("o_orderpriority") == "1-URGENT", 0).otherwise(1)).alias("id"), "k", "d", "t",
        F.when(F.col("o_orderstatus") != "P", eid).otherwise("").alias("ev"),
    )
    return attach.reconcile_ids(new, old, "id", "k", "d", "t", "ev")
