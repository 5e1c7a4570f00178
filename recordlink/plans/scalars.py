"""Queries over single expressions (titles, dates, URLs, keys, prices)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions import cost, dates, keys, text, urls
from recordlink.plans import sqltext as s
from recordlink.plans.bindings import base_records
from recordlink.plans.registry import query, table, wide_table

DECORATED_SQL = """
  CASE p_size % 7 WHEN 0 THEN 'HEARING NOTICE: ' || p_name WHEN 1 THEN 'Full Committee Hearing: ' || p_name
    WHEN 2 THEN '02/10/2026 ' || p_name WHEN 3 THEN '*** NEW *** ' || p_name WHEN 4 THEN 'Upcoming: ' || p_name
    WHEN 5 THEN p_name || ' Location: Room 5' ELSE 'An oversight hearing to examine ' || p_name || ', ' || p_brand END"""


def decorated_title():
    return F.expr(DECORATED_SQL)


@query(
    "normalize_title",
    f"""SELECT 'd' || doc_id AS id, {s.norm_title('text')} AS norm_title FROM documents
    UNION ALL SELECT 'p' || p_partkey, {s.norm_title('(' + DECORATED_SQL + ')')} FROM part""",
)
def q_normalize_title(spark, sf):
    docs = wide_table(spark, sf, "documents", "doc_id", "text").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("id"), text.normalize_title(F.col("text")).alias("norm_title")
    )
    parts = table(spark, sf, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey")).alias("id"), text.normalize_title(decorated_title()).alias("norm_title")
    )
    return docs.unionByName(parts)


BASE_SQL = f"WITH {s.RECORDS}"


@query(
    "record_id",
    f"""{BASE_SQL} SELECT o_orderkey,
    left(sha256(concat_ws(':', k, strftime(d, '%Y-%m-%d'), {s.norm_title('t')})), 12) AS record_id FROM base""",
)
def q_record_id(spark, sf):
    df = base_records(spark, sf)
    return df.select("o_orderkey", text.record_id(F.col("k"), F.col("d"), F.col("t")).alias("record_id"))


@query(
    "slug",
    """SELECT p_partkey, CASE WHEN contains(k, '.') THEN split_part(k, '.', 1) || '-' ||
      replace(regexp_extract(k, '^[^.]*\\.(.*)$', 1), '_', '-') ELSE k || '-unknown' END || '-' ||
      regexp_replace(left(regexp_replace(lower(t), '[^a-z0-9]+', '-', 'g'), 80), '^-+|-+$', '', 'g') AS slug
    FROM (SELECT p_partkey, CASE WHEN p_size > 40 THEN lower(p_type) ELSE 'house.' || replace(p_name, ' ', '_') END AS k,
                 p_name || ': ' || p_type || ' & ' || p_brand || ' (' || repeat('annual ', p_size % 14) || ')' AS t FROM part)""",
)
def q_slug(spark, sf):
    key = F.expr("CASE WHEN p_size > 40 THEN lower(p_type) ELSE concat('house.', replace(p_name, ' ', '_')) END")
    title = F.expr("concat(p_name, ': ', p_type, ' & ', p_brand, ' (', repeat('annual ', p_size % 14), ')')")
    return table(spark, sf, "part").select("p_partkey", text.slug(key, title).alias("slug"))


RAW_DATE_SQL = """CASE left(o_orderpriority, 1)
  WHEN '1' THEN strftime(o_orderdate, '%Y-%m-%d') || 'T10:00:00-05:00'
  WHEN '2' THEN 'Posted: ' || strftime(o_orderdate, '%B') || ' ' || day(o_orderdate) || ', ' || year(o_orderdate) || ' - 10:00 AM'
  WHEN '3' THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate)
  WHEN '4' THEN strftime(o_orderdate, '%m.%d.%Y')
  ELSE strftime(o_orderdate, '%b') || ' ' || day(o_orderdate) || ' ' || year(o_orderdate) END"""


def raw_date_text():
    """The order date written the way five kinds of pages write dates."""
    d = F.col("o_orderdate").cast("date")
    day, month, year = (f(d).cast("string") for f in (F.dayofmonth, F.month, F.year))
    first = F.left("o_orderpriority", F.lit(1))
    return (
        F.when(first == "1", F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T10:00:00-05:00")))
        .when(first == "2", F.concat(F.lit("Posted: "), F.date_format(d, "MMMM"), F.lit(" "), day, F.lit(", "), year, F.lit(" - 10:00 AM")))
        .when(first == "3", F.concat_ws("/", month, day, year))
        .when(first == "4", F.date_format(d, "MM.dd.yyyy"))
        .otherwise(F.concat_ws(" ", F.date_format(d, "MMM"), day, year))
    )


@query(
    "parse_date",
    f"SELECT o_orderkey, {RAW_DATE_SQL} AS raw, CAST(o_orderdate AS DATE) AS event_date FROM orders",
)
def q_parse_date(spark, sf):
    raw = table(spark, sf, "orders").select("o_orderkey", raw_date_text().alias("raw"))
    return raw.withColumn("event_date", dates.parse_date(F.col("raw")))


@query(
    "date_window_flags",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date,
      CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-01' - 730 AND DATE '1998-06-01' + 180 AS plausible,
      CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-01' - 730 AND DATE '1998-06-01' + 180
        AND CAST(o_orderdate AS DATE) >= DATE '1998-01-01' AS recent FROM orders""",
)
def q_date_window_flags(spark, sf):
    d = F.col("o_orderdate").cast("date")
    plausible, recent = dates.date_window_flags(d, "1998-01-01", "1998-06-01")
    return table(spark, sf, "orders").select(
        "o_orderkey", d.alias("event_date"), plausible.alias("plausible"), recent.alias("recent")
    )


PAIR_SQL = "p_name || ' ' || p_type AS a, p_type || ', ' || p_brand || ' ' || split_part(p_name, ' ', 2) AS b"


def pair_titles(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.concat_ws(" ", "p_name", "p_type").alias("a"),
        F.concat("p_type", F.lit(", "), "p_brand", F.lit(" "), F.split_part("p_name", F.lit(" "), F.lit(2))).alias("b"),
    )


@query(
    "token_jaccard",
    f"""SELECT p_partkey, round({s.jaccard('ta', 'tb')}, 4) AS sim FROM
    (SELECT p_partkey, {s.token_set('a')} AS ta, {s.token_set('b')} AS tb FROM (SELECT p_partkey, {PAIR_SQL} FROM part))""",
)
def q_token_jaccard(spark, sf):
    df = pair_titles(spark, sf)
    return df.select("p_partkey", F.round(text.token_jaccard(F.col("a"), F.col("b")), 4).alias("sim"))


@query(
    "keyword_overlap",
    f"""SELECT p_partkey, CAST(len(list_intersect(list_distinct({s.significant('a')}), list_distinct({s.significant('b')}))) AS BIGINT) AS shared
    FROM (SELECT p_partkey, {PAIR_SQL} FROM part)""",
)
def q_keyword_overlap(spark, sf):
    df = pair_titles(spark, sf)
    return df.select("p_partkey", text.keyword_overlap(F.col("a"), F.col("b")).cast("bigint").alias("shared"))


@query(
    "search_keywords",
    f"""SELECT doc_id, keywords, CASE WHEN lang = 'en' THEN CASE WHEN keywords <> '' THEN 'site.example.org/program ' || keywords || ' 2024' END
      ELSE 'site.example.org ' || source || ' ' || CASE WHEN keywords = '' THEN source ELSE keywords END || ' 2024' END AS search_query
    FROM (SELECT doc_id, lang, source, array_to_string(list_slice({s.significant('text')}, 1, 5), ' ') AS keywords FROM documents)""",
)
def q_search_keywords(spark, sf):
    name = F.when(F.col("lang") == "en", "").otherwise(F.col("source"))
    query_text = text.search_query(
        F.col("keywords"), name, dates.as_date("2024-05-01"), "site.example.org", "site.example.org/program"
    )
    docs = wide_table(spark, sf, "documents", "doc_id", "lang", "source", "text")
    found = docs.select("doc_id", "lang", "source", text.search_keywords(F.col("text")).alias("keywords"))
    return found.select("doc_id", "keywords", query_text.alias("search_query"))


@query(
    "absolutize_url",
    """SELECT page_id, href, abs_url, regexp_replace(abs_url, '/+$', '') AS dedup_key FROM (
      SELECT page_id, href, CASE
        WHEN href = '' OR starts_with(href, '#') OR starts_with(href, 'javascript:') OR starts_with(href, 'mailto:') THEN ''
        WHEN starts_with(href, 'http') THEN href
        WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-z]+:)//', 1) || href
        WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href
        WHEN starts_with(href, '?') THEN regexp_replace(url, '[?#].*$', '') || href
        ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') || href END AS abs_url
      FROM (SELECT page_id, url, unnest(list_concat(regexp_extract_all(html, '<a href="([^"]*)"', 1),
        ['#top', 'mailto:a@b.org', '//cdn.example.net/x/', '?page=3', 'doc-' || page_id || '.pdf', '', 'https://x.org/'])) AS href FROM pages))""",
)
def q_absolutize_url(spark, sf):
    extra = F.array(
        F.lit("#top"), F.lit("mailto:a@b.org"), F.lit("//cdn.example.net/x/"), F.lit("?page=3"),
        F.concat(F.lit("doc-"), F.col("page_id").cast("string"), F.lit(".pdf")), F.lit(""), F.lit("https://x.org/"),
    )
    hrefs = F.concat(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), 1), extra)
    links = table(spark, sf, "pages").select("page_id", "url", F.explode(hrefs).alias("href"))
    full = links.select("page_id", "href", urls.absolutize_url(F.col("href"), F.col("url")).alias("abs_url"))
    return full.withColumn("dedup_key", urls.url_dedup_key(F.col("abs_url")))


HREF_SQL = """CASE page_id % 6 WHEN 0 THEN url || '.PDF' WHEN 1 THEN url || '/download/' || page_id WHEN 2 THEN url || '&format=pdf'
  WHEN 3 THEN url || '/services/files/' || page_id WHEN 4 THEN url || '/?a=Files.Serve' ELSE url END"""


@query(
    "classify_href",
    f"""SELECT page_id, href, ends_with(lower(href), '.pdf') OR contains(lower(href), 'format=pdf') OR contains(lower(href), '/download/')
    OR contains(lower(href), '/services/files/') OR contains(lower(href), 'files.serve') AS is_document
    FROM (SELECT page_id, {HREF_SQL} AS href FROM pages)""",
)
def q_classify_href(spark, sf):
    df = table(spark, sf, "pages").select("page_id", F.expr(HREF_SQL).alias("href"))
    return df.withColumn("is_document", urls.is_document_href(F.col("href")))


@query(
    "extract_ids",
    """SELECT page_id, CASE WHEN page_id % 3 > 0 THEN 'vid_' || lpad(CAST(page_id AS VARCHAR), 7, '0') END AS embed_id,
      CAST(page_id AS VARCHAR) AS program_id, CASE WHEN page_id % 2 = 0 THEN 'comm' || page_id END AS comm,
      CASE WHEN page_id % 2 = 0 THEN 'file' || page_id END AS filename FROM pages""",
)
def q_extract_ids(spark, sf):
    pid = F.col("page_id").cast("string")
    frames = F.concat(
        F.when(F.col("page_id") % 3 > 0, F.concat(
            F.lit('<iframe width="5" src="https://www.youtube.com/embed/vid_'), F.lpad(pid, 7, "0"), F.lit('?x=1"></iframe>')
        )).otherwise(""),
        F.lit('<iframe src="https://www.senate.gov/isvp/?comm=comm'), pid,
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("&filename=file"), pid)).otherwise(""), F.lit('"></iframe>'),
    )
    pages = table(spark, sf, "pages").select("page_id", F.concat("html", frames).alias("html"))
    comm, filename = urls.player_params(F.col("html"))
    program = urls.program_id(F.concat(F.lit("https://tv.example.org/program/series/title-x/"), pid))
    return pages.select(
        "page_id", urls.embed_id(F.col("html")).alias("embed_id"), program.alias("program_id"),
        comm.alias("comm"), filename.alias("filename"),
    )


GROUP_KEY_SQL = """CASE WHEN c_nationkey % 5 = 0 THEN 'govinfo.' || CASE WHEN c_nationkey < 12 THEN 'house' ELSE 'senate' END
  WHEN c_nationkey % 5 = 1 THEN 'govinfo' ELSE CASE WHEN c_nationkey < 12 THEN 'house' ELSE 'senate' END || '.n' || c_nationkey END"""


@query(
    "derive_group",
    f"""SELECT c_custkey, CASE WHEN k = 'govinfo' THEN 'unknown' WHEN starts_with(k, 'govinfo.') THEN split_part(k, '.', 2)
      ELSE split_part(k, '.', 1) END AS key_group,
      CASE c_nationkey % 3 WHEN 0 THEN 'house' WHEN 1 THEN 'senate' ELSE 'unknown' END AS package_group,
      left(c_mktsegment, 4) || '00' AS parent_code
    FROM (SELECT *, {GROUP_KEY_SQL} AS k FROM customer)""",
)
def q_derive_group(spark, sf):
    package = F.expr(
        "concat('CHRG-119', CASE c_nationkey % 3 WHEN 0 THEN 'hhrg' WHEN 1 THEN 'SHRG' ELSE 'jhrg' END, c_custkey)"
    )
    return table(spark, sf, "customer").select(
        "c_custkey",
        keys.group_of_key(F.expr(GROUP_KEY_SQL)).alias("key_group"),
        keys.group_of_package(package).alias("package_group"),
        keys.parent_code(F.col("c_mktsegment")).alias("parent_code"),
    )


@query(
    "stream_name",
    f"""{BASE_SQL} SELECT o_orderkey,
      CASE WHEN o_orderpriority = '2-HIGH' THEN 'preset' WHEN code IS NOT NULL AND g = 'senate' THEN code END AS stream_comm,
      CASE WHEN o_orderpriority <> '2-HIGH' AND code IS NOT NULL AND g = 'senate' THEN code || strftime(d, '%m%d%y') END AS stream_file
    FROM (SELECT *, split_part(k, '.', 1) AS g, CASE WHEN o_orderpriority <> '5-LOW' THEN split_part(k, '.', 2) END AS code FROM base)""",
)
def q_stream_name(spark, sf):
    df = base_records(spark, sf).select(
        "o_orderkey", "d",
        F.split_part("k", F.lit("."), F.lit(1)).alias("g"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.split_part("k", F.lit("."), F.lit(2))).alias("code"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "preset").alias("old"),
    )
    return keys.stream_name(df, "code", "g", "d", "old").select("o_orderkey", "stream_comm", "stream_file")


_WORD = """CASE WHEN list_contains({keep}, regexp_replace(upper(w), '[.,;:!?''"]+$', ''))
   OR list_contains({keep}, regexp_replace(upper(w), '[.,;:!?''"]+$', '') || '.') THEN w
   WHEN j = 1 THEN upper(left(w, 1)) || lower(substr(w, 2)) ELSE lower(w) END""".format(keep=s.sql_list(fv.ABBREVIATIONS))


@query(
    "sentence_case",
    f"""SELECT doc_id, CASE WHEN length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g'))::DOUBLE / greatest(length(t), 1) < 0.6 THEN t
      ELSE array_to_string(list_transform(string_split(regexp_replace(t, '([.!?]\\s+)', chr(1) || '\\1' || chr(1), 'g'), chr(1)),
        lambda p: CASE WHEN regexp_matches(p, '^[.!?]\\s+$') THEN p ELSE
          array_to_string(list_transform(list_filter(string_split_regex(p, '\\s+'), lambda z: z <> ''), lambda w, j: {_WORD}), ' ') END), '') END AS recased
    FROM (SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN upper(replace(text, 'ß', 'ss')) || ' THE GDP OF THE U.S. ROSE.' ELSE text END AS t FROM documents)""",
)
def q_sentence_case(spark, sf):
    shouted = F.when(F.col("lang").isin("en", "fr"), F.concat(F.upper("text"), F.lit(" THE GDP OF THE U.S. ROSE."))).otherwise(F.col("text"))
    return wide_table(spark, sf, "documents", "doc_id", "lang", "text").select("doc_id", text.sentence_case(shouted).alias("recased"))


_PRICES_SQL = "(VALUES " + ", ".join(f"({s.q(m)}, {i}, {o})" for m, i, o in fv.MODEL_PRICES) + ") AS p(model, pin, pout)"
_MODEL_SQL = (
    "CASE lang WHEN 'en' THEN 'google/gemini-3-flash-preview' WHEN 'fr' THEN 'openai/gpt-4o-mini' ELSE 'google/gemini-2.0-flash-001' END"
)


@query(
    "token_cost",
    f"""SELECT doc_id, d.model, tokens, CAST(CAST((CAST(tokens AS DECIMAL(12,0)) * CAST(pin AS DECIMAL(8,3)) + CAST(tokens // 2 AS DECIMAL(12,0)) * CAST(pout AS DECIMAL(8,3))) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(18,6)) AS DOUBLE) AS cost_usd
    FROM (SELECT doc_id, {_MODEL_SQL} AS model, CAST(length(text) // 4 AS BIGINT) AS tokens FROM documents) d JOIN {_PRICES_SQL} ON d.model = p.model""",
)
def q_token_cost(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", F.expr(_MODEL_SQL).alias("model"), cost.estimate_tokens(F.col("text")).alias("tokens")
    )
    docs = docs.withColumn("out_tokens", F.floor(F.col("tokens") / 2))
    return cost.token_cost(docs, "model", "tokens", "out_tokens").drop("out_tokens")


@query(
    "retry_plan",
    """SELECT user_id, attempts, CASE WHEN attempts >= 5 THEN 'dead_letter' ELSE 'pending' END AS next_status,
      CASE WHEN attempts < 5 THEN CAST(least(60 * pow(2, greatest(attempts - 1, 0)), 3600) AS BIGINT) END AS delay_s,
      CASE WHEN attempts < 5 THEN TIMESTAMP '2024-02-01 00:00:00' + to_seconds(CAST(least(60 * pow(2, greatest(attempts - 1, 0)), 3600) AS BIGINT)) END AS available_at
    FROM (SELECT user_id, count(*) FILTER (event_type = 'error' AND value > 20) AS attempts FROM events GROUP BY user_id)""",
)
def q_retry_plan(spark, sf):
    errors = table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if((F.col("event_type") == "error") & (F.col("value") > 20)).alias("attempts")
    )
    return cost.retry_plan(errors, "attempts", "2024-02-01 00:00:00")


@query(
    "staleness",
    """SELECT user_id, CAST(floor(epoch(TIMESTAMP '2024-02-03 12:00:00' - last_ts) / 86400) AS BIGINT) AS age_days,
      floor(epoch(TIMESTAMP '2024-02-03 12:00:00' - last_ts) / 86400) >= 5 AS is_stale,
      coalesce(floor(epoch(TIMESTAMP '2024-02-03 12:00:00' - last_ts) / 86400) >= 7, TRUE) AS rotation_due
    FROM (SELECT user_id, date_trunc('second', max(ts) FILTER (event_type = 'purchase')) AS last_ts FROM events GROUP BY user_id)""",
)
def q_staleness(spark, sf):
    from recordlink.operators.rank import staleness

    last = table(spark, sf, "events").groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last_ts")
    )
    out = staleness(last, "last_ts", "2024-02-03 12:00:00", 5).withColumn("rotation_due", F.coalesce(F.col("age_days") >= 7, F.lit(True)))
    return out.drop("last_ts")


@query(
    "coalesce_priority",
    """SELECT o_orderkey, coalesce(cspan, isvp, cap) AS best, CASE WHEN cspan IS NOT NULL THEN 'cspan_cleaned' WHEN isvp IS NOT NULL THEN 'isvp_cleaned'
      WHEN cap IS NOT NULL THEN 'captions' END AS winner FROM (
      SELECT l_orderkey AS o_orderkey, min(CASE WHEN l_returnflag = 'A' THEN 'c' || l_partkey END) AS cspan,
        min(CASE WHEN l_returnflag = 'N' THEN 'i' || l_partkey END) AS isvp, min(CASE WHEN l_returnflag = 'R' THEN 'k' || l_partkey END) AS cap
      FROM lineitem GROUP BY 1)""",
)
def q_coalesce_priority(spark, sf):
    kind = F.expr("CASE l_returnflag WHEN 'A' THEN 'cspan_cleaned' WHEN 'N' THEN 'isvp_cleaned' ELSE 'captions' END")
    path = F.expr("concat(CASE l_returnflag WHEN 'A' THEN 'c' WHEN 'N' THEN 'i' ELSE 'k' END, l_partkey)")
    arts = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), kind.alias("kind"), path.alias("path"))
    wide = arts.groupBy("o_orderkey").agg(
        *[F.min(F.when(F.col("kind") == k, F.col("path"))).alias(k) for k in fv.ARTIFACT_PRIORITY]
    )
    best, winner = text.coalesce_priority([(k, F.col(k)) for k in fv.ARTIFACT_PRIORITY])
    return wide.select("o_orderkey", best.alias("best"), winner.alias("winner"))


@query(
    "session_number",
    "SELECT o_orderkey, CAST((year(o_orderdate) - 1789) // 2 + 1 AS BIGINT) AS session_number FROM orders",
)
def q_session_number(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.session_number(F.col("o_orderdate").cast("date")).alias("session_number")
    )


@query(
    "safe_filename",
    """SELECT page_id, regexp_replace(CASE WHEN ends_with(n, '.pdf') THEN n ELSE n || '.pdf' END, '[^A-Za-z0-9._-]', '_', 'g') AS file_name
    FROM (SELECT page_id, list_extract(string_split(url, '/'), -1) AS n FROM pages)""",
)
def q_safe_filename(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.safe_filename(F.col("url")).alias("file_name"))


@query(
    "duration_label",
    """SELECT event_id, CAST(sec // 60 AS VARCHAR) || 'm' || lpad(CAST(sec % 60 AS VARCHAR), 2, '0') || 's' AS label
    FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN 0 ELSE CAST(floor(value * 10) AS BIGINT) END AS sec FROM events)""",
)
def q_duration_label(spark, sf):
    seconds = F.when(F.col("event_type") != "view", F.floor(F.col("value") * 10))
    return table(spark, sf, "events").select("event_id", text.duration_label(seconds).alias("label"))


@query(
    "strip_markup",
    "SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\\s{2,}', ' ', 'g')) AS plain FROM pages",
)
def q_strip_markup(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.strip_markup(F.col("html")).alias("plain"))
