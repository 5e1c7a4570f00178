"""SQL (DuckDB) of the whole resolution, stage by stage. Used for verification only.

Stage i has rows r{i}(rec, block_key, title, event_date, authority, has_video) and source entries
s{i}(rec, source, v).
"""

from __future__ import annotations

from recordlink.plans import sqltext as s


# Keys of the registry that the flagship is given: it is smaller than the keys present.
REGISTERED = "coalesce(TRY_CAST(substr(split_part(block_key, '.', 2), 2) AS INT) % 5 <> 3, FALSE)"


def merge(i: int, cluster: str, more: bool = False) -> str:
    """Stage i+1 from stage i and a relation (rec, c); with `more` the number of sources decides between equal authorities."""
    order = "authority DESC, n DESC, rec" if more else "authority DESC, rec"
    return f"""c{i} AS MATERIALIZED ({cluster}),
  x{i} AS MATERIALIZED (SELECT r{i}.*, c, n, {REGISTERED} AS spec FROM r{i} JOIN c{i} USING (rec) JOIN (SELECT rec, count(*) AS n FROM s{i} GROUP BY rec) USING (rec)),
  r{i + 1} AS MATERIALIZED (SELECT first(rec ORDER BY {order}) AS rec,
      coalesce(first(block_key ORDER BY {order}) FILTER (WHERE spec), last(block_key ORDER BY {order})) AS block_key,
      first(title ORDER BY authority DESC, length(title) DESC, {order}) AS title, min(event_date) AS event_date,
      max(authority) AS authority, bool_or(has_video) AS has_video, count(*) AS n_merged
    FROM x{i} GROUP BY c),
  h{i} AS MATERIALIZED (SELECT c, first(rec ORDER BY {order}) AS head FROM x{i} GROUP BY c),
  s{i + 1} AS MATERIALIZED (SELECT head AS rec, source, last(v ORDER BY {order}) AS v
    FROM s{i} JOIN x{i} USING (rec) JOIN h{i} USING (c) GROUP BY head, source)"""


def start() -> str:
    return """r0 AS MATERIALIZED (SELECT rec, block_key, title, event_date, authority, has_video FROM records),
  s0 AS MATERIALIZED (SELECT rec, source, source_value AS v FROM records)"""


def exact(i: int) -> str:
    return merge(i, f"SELECT rec, concat_ws(chr(31), block_key, event_date, {s.norm_title('title')}) AS c FROM r{i}")


def nodes(i: int) -> str:
    return f"""n{i} AS MATERIALIZED (SELECT block_key, event_date, toks, first(rec ORDER BY authority DESC, rec) AS node,
      min((-authority, rec)) AS prio, bool_or(has_video) AS video, list(rec) AS members
    FROM (SELECT *, {s.token_set('title')} AS toks FROM r{i}) GROUP BY 1, 2, 3)"""


def fuzzy(i: int) -> str:
    """Greedy representatives: a node joins its first earlier representative (same day, day before, day after)."""
    sim = s.jaccard("x.toks", "y.toks")
    return f"""{nodes(i)},
  e{i} AS MATERIALIZED (SELECT x.node AS a, y.node AS b, x.prio AS pa, CAST(y.event_date - x.event_date AS INT) AS gap FROM n{i} x JOIN n{i} y
    ON x.block_key = y.block_key AND x.prio < y.prio AND y.event_date BETWEEN x.event_date - 1 AND x.event_date + 1
    WHERE (x.event_date = y.event_date AND {sim} >= 0.30) OR (x.event_date <> y.event_date AND (x.video OR y.video) AND {sim} >= 0.45)),
  st{i}(node, state, it) AS (
    SELECT node, CASE WHEN node IN (SELECT b FROM e{i}) THEN 'u' ELSE 'r' END, 0 FROM n{i}
    UNION ALL
    SELECT n.node, CASE WHEN n.state <> 'u' THEN n.state WHEN bool_or(p.state = 'r') THEN 'a' WHEN bool_and(p.state = 'a') THEN 'r' ELSE 'u' END, n.it + 1
    FROM st{i} n LEFT JOIN e{i} e ON e.b = n.node LEFT JOIN st{i} p ON p.node = e.a
    WHERE EXISTS (SELECT 1 FROM st{i} q WHERE q.state = 'u') GROUP BY n.node, n.state, n.it),
  fin{i} AS MATERIALIZED (SELECT node, state FROM st{i} WHERE it = (SELECT max(it) FROM st{i})),
  rep{i} AS MATERIALIZED (SELECT e.b AS node, first(e.a ORDER BY CASE gap WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END, pa) AS rep
    FROM e{i} e JOIN fin{i} x ON x.node = e.a AND x.state = 'r' JOIN fin{i} y ON y.node = e.b AND y.state = 'a' GROUP BY 1),
  {merge(i, f'SELECT unnest(members) AS rec, coalesce(rep, node) AS c FROM n{i} LEFT JOIN rep{i} USING (node)')}"""


def closure(i: int, pairs: str, more: bool = False) -> str:
    """Merge stage i over the transitive closure of pairs(a, b)."""
    return f"""p{i} AS MATERIALIZED ({pairs}), u{i} AS MATERIALIZED (SELECT a, b FROM p{i} UNION SELECT b, a FROM p{i}),
  reach{i}(rec, other) AS (SELECT rec, rec FROM r{i} UNION SELECT reach{i}.rec, u{i}.b FROM reach{i} JOIN u{i} ON reach{i}.other = u{i}.a),
  {merge(i, f'SELECT rec, min(other) AS c FROM reach{i} GROUP BY rec', more)}"""


def adjacent(i: int) -> str:
    sim = s.jaccard("x.toks", "y.toks")
    pairs = f"""SELECT x.node AS a, y.node AS b FROM n{i} x JOIN n{i} y ON x.block_key = y.block_key AND y.event_date = x.event_date + 1
      WHERE (x.video OR y.video) AND {sim} >= 0.45"""
    return f"{nodes(i)}, {closure(i, pairs, True)}"


def cross_key(i: int) -> str:
    """All pairs of one date and group with different keys: the closure of these equals that of the hub edges."""
    group = "CASE WHEN starts_with({0}.block_key, 'govinfo.') THEN split_part({0}.block_key, '.', 2) ELSE split_part({0}.block_key, '.', 1) END"
    sim = s.jaccard("x.toks", "y.toks")
    pairs = f"""SELECT x.node AS a, y.node AS b FROM n{i} x JOIN n{i} y ON x.event_date = y.event_date AND x.block_key <> y.block_key
      AND {group.format('x')} = {group.format('y')} AND x.node < y.node WHERE {sim} > 0.4"""
    return f"{nodes(i)}, {closure(i, pairs)}"


def sources_text(i: int) -> str:
    return f"SELECT rec, string_agg(source || '=' || v, ',' ORDER BY source || '=' || v) AS sources FROM s{i} GROUP BY rec"


DEDUP = f"""WITH RECURSIVE {s.RECORDS}, {start()}, {exact(0)}, {fuzzy(1)}
SELECT rec, block_key, title, event_date, authority, has_video, n_merged, sources FROM r2 JOIN ({sources_text(2)}) USING (rec)"""

_CLIP_SIM = s.jaccard("toks", "ctoks")
_STREAM_SIM = s.jaccard("toks", "stoks")
_SHARED = f"len(list_intersect(list_distinct({s.significant('title')}), list_distinct({s.significant('vt')})))"


def record_id(key: str, day: str, title: str) -> str:
    return f"left(sha256(concat_ws(':', {key}, strftime({day}, '%Y-%m-%d'), {s.norm_title(title)})), 12)"


RESOLVE = f"""WITH RECURSIVE {s.RECORDS}, {start()}, {exact(0)}, {fuzzy(1)}, {cross_key(2)}, {adjacent(3)},
  vid AS (SELECT rec, v AS video FROM s4 WHERE source = 'video_id'),
  clips AS (SELECT o_orderkey AS clip, k, d, CASE WHEN o_orderkey % 2 = 0 THEN 2000 ELSE 600 END AS clip_s, {s.token_set("'Opening statement ' || t")} AS ctoks FROM base WHERE o_orderstatus = 'P'),
  hit AS (SELECT clip, first(rec ORDER BY sim DESC, rec) AS rec FROM (SELECT clip, rec, {_CLIP_SIM} AS sim
    FROM (SELECT *, {s.token_set('title')} AS toks FROM r4) JOIN clips ON block_key = k AND event_date = d) WHERE sim >= 0.15 GROUP BY clip),
  got AS (SELECT rec, first('clip' || clip ORDER BY clip) AS url, first(clip_s ORDER BY clip) AS clip_s, count(*) AS n FROM hit JOIN clips USING (clip) GROUP BY rec),
  streams AS (SELECT o_orderkey AS stream, d, {s.token_set("'Whole session ' || t")} AS stoks, row_number() OVER (PARTITION BY d ORDER BY o_orderkey) AS i
    FROM base WHERE o_orderpriority = '1-URGENT'),
  free AS (SELECT rec, event_date, {s.token_set('title')} AS toks FROM r4 LEFT JOIN vid USING (rec) LEFT JOIN got USING (rec)
    WHERE video IS NOT NULL OR coalesce(clip_s, 0) < 1800),
  fits AS MATERIALIZED (SELECT stream, rec, sim FROM (SELECT stream, rec, {_STREAM_SIM} AS sim FROM free JOIN streams ON event_date = d) WHERE sim >= 0.10),
  turn(d, i, stream, gone, won) AS (
    SELECT DISTINCT d, 0::BIGINT, NULL::BIGINT, []::BIGINT[], NULL::BIGINT FROM streams
    UNION ALL
    SELECT d, i, stream, CASE WHEN won IS NULL THEN gone ELSE list_append(gone, won) END, won FROM (
      SELECT turn.d, streams.i, streams.stream, turn.gone, first(fits.rec ORDER BY sim DESC, fits.rec) FILTER (fits.rec IS NOT NULL AND NOT list_contains(turn.gone, fits.rec)) AS won
      FROM turn JOIN streams ON streams.d = turn.d AND streams.i = turn.i + 1 LEFT JOIN fits ON fits.stream = streams.stream GROUP BY 1, 2, 3, 4)),
  full_video AS (SELECT won AS rec, 'stream' || stream AS surl FROM turn WHERE won IS NOT NULL),
  looked AS (SELECT {record_id('k', 'd', 't')} AS record_id, max('found' || o_orderkey) AS furl FROM base WHERE o_orderkey % 7 = 0 GROUP BY 1),
  cast_of AS (SELECT video, first(rec ORDER BY tier, shared DESC, rec) AS rec FROM (
    SELECT video, rec, CASE WHEN block_key = k THEN 0 ELSE 1 END AS tier, {_SHARED} AS shared
    FROM r4 JOIN (SELECT o_orderkey AS video, k, d, 'Broadcast of ' || t AS vt FROM base WHERE o_orderpriority = '3-MEDIUM') ON event_date = d) GROUP BY video),
  casts AS (SELECT rec, first('cast' || video ORDER BY video) AS curl FROM cast_of GROUP BY rec),
  page AS (SELECT 'https://site.example.org/' || o_orderkey AS purl, CASE WHEN o_orderkey % 2 = 0 THEN 'https://d.example.org/' || o_orderkey || '.pdf' END AS pdf,
    CASE WHEN o_orderstatus = 'O' THEN 'https://www.youtube.com/watch?v=y' || o_orderkey END AS embed, CASE WHEN o_orderkey % 5 = 0 THEN 'p' || o_orderkey END AS pcomm FROM base WHERE o_orderkey % 3 = 0),
  read_page AS (SELECT rec, pdf, embed, pcomm, replace(pcomm, 'p', 'f') AS pfile FROM r4 JOIN s4 USING (rec) JOIN page ON source = 'web_url' AND v = purl
    WHERE starts_with(block_key, 'senate.') OR block_key = 'govinfo.senate' OR ({REGISTERED} AND TRY_CAST(substr(split_part(block_key, '.', 2), 2) AS INT) % 2 = 0)),
  named AS (SELECT r4.*, sources, {record_id('block_key', 'event_date', 'title')} AS record_id, coalesce(surl, video, url, embed) AS video_url,
      CASE WHEN surl IS NOT NULL THEN 3600 WHEN video IS NULL THEN clip_s END AS video_duration, coalesce(n, 0) AS n_clips, n_name, 'n' || n_nationkey AS code, curl, pdf, pcomm, pfile
    FROM r4 JOIN ({sources_text(4)}) USING (rec) LEFT JOIN vid USING (rec) LEFT JOIN got USING (rec) LEFT JOIN full_video USING (rec) LEFT JOIN casts USING (rec) LEFT JOIN read_page USING (rec)
    LEFT JOIN nation ON n_nationkey % 5 <> 3 AND block_key = CASE WHEN n_nationkey < 12 THEN 'house.n' ELSE 'senate.n' END || n_nationkey)
SELECT record_id, rec, block_key, coalesce(n_name, block_key) AS block_name, title, event_date, authority, sources, video_url, video_duration, n_clips,
  CASE WHEN event_date <= DATE '1997-01-01' THEN coalesce(furl, curl) ELSE curl END AS broadcast_url, pdf AS pdf_urls,
  coalesce(pcomm, CASE WHEN starts_with(block_key, 'senate.') THEN code END) AS stream_comm,
  coalesce(pfile, CASE WHEN starts_with(block_key, 'senate.') THEN code || strftime(event_date, '%m%d%y') END) AS stream_file,
  split_part(block_key, '.', 1) || '-' || replace(split_part(block_key, '.', 2), '_', '-') || '-' ||
    regexp_replace(left(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), 80), '^-+|-+$', '', 'g') AS slug FROM named LEFT JOIN looked USING (record_id)"""
