"""Queries over registries, listings, pages and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.operators.rank import failing_list
from recordlink.plans import sqltext as s
from recordlink.plans.bindings import base_records
from recordlink.plans.registry import query, table, wide_table
from recordlink.plans.reports import _STREAK, streaks
from recordlink.session import scratch_path
from recordlink.sources import layouts, listings, pages, sinks


@query(
    "registry_explode",
    """SELECT c_custkey, 'house.c' || c_custkey AS key, c_name AS name, CAST(c_nationkey AS BIGINT) AS tier FROM customer
    UNION ALL SELECT c_custkey, 'senate.c' || c_custkey, c_mktsegment, NULL FROM customer""",
)
def q_registry_explode(spark, sf):
    key = F.col("c_custkey").cast("string")
    doc = F.to_json(F.create_map(
        F.concat(F.lit("house.c"), key), F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").cast("bigint").alias("tier")),
        F.concat(F.lit("senate.c"), key), F.struct(F.col("c_mktsegment").alias("name"), F.lit(None).cast("bigint").alias("tier")),
    ))
    cust = table(spark, sf, "customer").select("c_custkey", doc.alias("doc"))
    return listings.registry_explode(cust, "doc", "name string, tier bigint")


_VID = "CASE WHEN event_type = 'view' THEN 'u' || user_id ELSE 'v' || event_id END"


@query(
    "delimited_listing",
    f"""SELECT id, event_type || ' by' || chr(32) || user_id AS title, CAST(ts AS DATE) AS event_date,
      CASE WHEN event_type = 'click' THEN 0 ELSE CAST(trunc(value * 10) AS BIGINT) END AS duration_s FROM (
      SELECT *, {_VID} AS id, row_number() OVER (PARTITION BY {_VID} ORDER BY event_id) AS n FROM events WHERE event_type <> 'signup')
    WHERE n = 1 AND value < 60 AND CAST(ts AS DATE) >= DATE '2024-01-10'""",
)
def q_delimited_listing(spark, sf):
    cell = F.concat_ws(
        "\t", F.expr(_VID), F.concat("event_type", F.lit(" by "), F.col("user_id").cast("string")),
        F.when(F.col("value") < 60, F.date_format("ts", "yyyyMMdd")).otherwise("NA"),
        F.when(F.col("event_type") == "click", "n/a").otherwise((F.col("value") * 10).cast("string")),
    )
    line = F.when(F.col("event_type") == "signup", F.lit("broken\tline")).otherwise(cell)
    lines = table(spark, sf, "events").select("event_id", line.alias("line"))
    return listings.delimited_listing(lines, "line", "2024-01-10", ["event_id"])


@query(
    "api_page_flatten",
    """SELECT event_id AS page, 'e' || event_id AS event_id, 'https://api.example.org/' || user_id AS url, CASE WHEN value > 0 THEN 1::BIGINT ELSE 0 END AS people FROM events WHERE event_type <> 'error'
    UNION ALL SELECT event_id, 'x' || event_id, 'https://api.example.org/x', 0 FROM events WHERE value > 10""",
)
def q_api_page_flatten(spark, sf):
    eid, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    person = F.struct(F.when(F.col("value") > 0, "Dr. X").alias("name"), F.lit("").alias("position"), F.lit(None).cast("string").alias("organization"))
    nobody = F.struct(F.lit(None).cast("string").alias("name"), F.lit("").alias("position"), F.lit(None).cast("string").alias("organization"))

    def item(i, u, w):
        return F.struct(i.alias("eventId"), u.alias("url"), F.array(w, nobody).alias("witnesses"))

    first = item(F.when(F.col("event_type") != "error", F.concat(F.lit("e"), eid)), F.concat(F.lit("https://api.example.org/"), user), person)
    second = item(F.concat(F.lit("x"), eid), F.when(F.col("value") > 10, "https://api.example.org/x").otherwise(""), nobody)
    body = F.to_json(F.struct(F.struct(F.array(first, second).alias("meetings")).alias("data")))
    answers = table(spark, sf, "events").select(F.col("event_id").alias("page"), body.alias("body"))
    schema = "data struct<meetings: array<struct<eventId: string, url: string, witnesses: array<struct<name: string, position: string, organization: string>>>>>"
    out = listings.api_page_flatten(answers, "body", schema, "data.meetings", ["eventId", "url"], ["page"])
    people = F.size(listings.non_empty_people(F.col("witnesses"))).cast("bigint")
    return out.select("page", F.col("eventId").alias("event_id"), "url", people.alias("people"))


_ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"


@query(
    "page_links",
    f"""WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)">(.*?)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a href="([^"]*)">(.*?)</a>', 2)) AS text,
      unnest(range(len(regexp_extract_all(html, '<a href="')))) AS raw FROM pages),
      a AS (SELECT *, {_ORIGIN} || href AS abs_url FROM l),
      d AS (SELECT page_id, abs_url, first(href ORDER BY raw) AS href, first(text ORDER BY raw) AS text, min(raw) AS raw FROM a GROUP BY 1, 2)
    SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY raw) - 1 AS pos, href, abs_url, text FROM d""",
)
def q_page_links(spark, sf):
    return pages.page_links(wide_table(spark, sf, "pages", "page_id", "url", "html"), "page_id", "html", "url")


# Pages of every layout, written from orders; the order columns are the expected listing.
_LAYOUT_OF = "concat('L', o_orderkey % 15)"
_TITLE = "concat('Annual Session on ', CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Finished' ELSE 'Partial' END, ' Orders ', o_orderkey)"
_OLD = "o_orderpriority = '5-LOW'"


def listing_pages(spark, sf):
    """One page per order in one of the registered layouts: a current record, an outdated one, navigation."""
    orders = wide_table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("o_orderkey") % 300).cast("int"))
    names = [x.layout for x in layouts.LAYOUTS]
    layout = F.get(F.array(*[F.lit(n) for n in names]), (F.col("o_orderkey") % len(names)).cast("int"))
    key = F.col("o_orderkey").cast("string")
    base = orders.select("o_orderkey", "o_orderpriority", layout.alias("layout"), F.expr(_TITLE).alias("title"), day.alias("day"), key.alias("k"))

    def text_of(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    long_day = F.date_format("day", "MMMM d, yyyy")
    iso, mdy = F.date_format("day", "yyyy-MM-dd"), F.date_format("day", "MM/dd/yyyy")
    t, k = F.col("title"), F.col("k")
    row = text_of('<table class="table-striped recordList"><tr><th>Title</th></tr><tr><td><a href="/hearings/', mdy, '/x', k, '">', t, "</a></td><td>soon</td></tr>",
                  '<tr><td><a href="/hearings/01/05/2020/old">Outdated Session on Something</a></td><td>January 5, 2020</td></tr></table>')
    item = text_of('<div class="list"><div class="item"><span>', long_day, '</span><a href="/hearings/x', k, '">', t, "</a></div>",
                   '<div class="item"><span>January 3, 2020</span><a href="/hearings/old">Outdated Session on Something</a></div></div>')
    timed = text_of('<div class="item"><time datetime="', iso, 'T10:00:00">soon</time><div><a href="/hearings/x', k, '">', t, "</a></div></div>",
                    '<div class="item"><time datetime="2020-06-15">then</time><div><a href="/e/old">Outdated Session on Something</a></div></div>')

    def article(cls, inner):
        return text_of(f'<article class="{cls}">', inner, "</article>", f'<article class="{cls}"><a href="/a/old">Outdated Session on Something</a> Jan 5, 2020</article>')

    link = text_of('<a href="/hearings/x', k, '">', t, "</a>")
    bodies = {
        "drupal_table": row, "coldfusion_table": row, "new_senate_cms": item,
        "drupal_links": text_of('<ul><li><a href="/2025/', F.month("day").cast("string"), "/x", k, '">', t, "</a> ", long_day, "</li></ul>"),
        "wordpress_blog": article("post", text_of('<h2><a href="/', F.date_format("day", "yyyy/MM/dd"), "/x", k, '/">', t, "</a></h2>")),
        "wordpress_elementor": text_of('<div class="jet-listing-grid__item">', link, "<p>", long_day, "</p></div>"),
        "evo_framework": timed, "aspnet_card": article("card-h-event", text_of('<time datetime="', iso, '">x</time>', link)),
        "html_table": text_of("<table><tr><td>", link, "</td><td>", F.date_format("day", "M/d/yyyy"), "</td></tr></table>"),
        "wordpress_single_event": text_of('<div class="single-event"><div class="date-block"><span class="month">', F.date_format("day", "MMM"), '</span><span class="day">',
                                          F.dayofmonth("day").cast("string"), '</span><span class="year">2025</span></div><div class="info">', link, "</div></div>"),
        "tribe_events": article("tribe-events-calendar-list__event", text_of('<time datetime="', iso, '">x</time>', link)),
        "wordpress_featured_post": text_of('<div class="post featured-post">', link, " ", long_day, "</div>"),
        "wordpress_calblocker": article("calblocker", text_of(link, " ", long_day)),
        "generic_links": item,
        "search_results": text_of('<div><a href="/program/series/name/', k, '">', t, "</a><p>", F.upper(long_day), "</p></div>"),
    }
    body = F.lit("")
    for name, html in bodies.items():
        body = F.when(F.col("layout") == name, html).otherwise(body)
    # Low-priority orders: the page names the layout but has plain dated links only, so the generic layout answers.
    body = F.when(F.expr(_OLD) & ~F.col("layout").isin("new_senate_cms", "evo_framework", "search_results"), item).otherwise(body)
    nav = F.lit('<div class="nav"><a href="/next">Next page of the list</a></div>')
    html = F.concat(F.lit("<html><body>"), nav, body, F.lit("</body></html>"))
    return base.select("o_orderkey", "layout", html.alias("html"), text_of("https://site.example.org/list/", k).alias("url"))


_NAMES = s.sql_list([x.layout for x in layouts.LAYOUTS])


@query(
    "page_listing",
    f"""SELECT o_orderkey, title, d AS event_date, 'https://site.example.org' || CASE
        WHEN o_orderpriority = '5-LOW' AND l NOT IN ('new_senate_cms', 'evo_framework', 'search_results') THEN '/hearings/x' || o_orderkey
        WHEN l IN ('drupal_table', 'coldfusion_table') THEN '/hearings/' || strftime(d, '%m/%d/%Y') || '/x' || o_orderkey
        WHEN l = 'drupal_links' THEN '/2025/' || month(d) || '/x' || o_orderkey WHEN l = 'wordpress_blog' THEN '/' || strftime(d, '%Y/%m/%d') || '/x' || o_orderkey || '/'
        WHEN l = 'search_results' THEN '/program/series/name/' || o_orderkey ELSE '/hearings/x' || o_orderkey END AS url
    FROM (SELECT o_orderkey, o_orderpriority, {_NAMES}[o_orderkey % 15 + 1] AS l, {_TITLE} AS title, DATE '2025-01-01' + CAST(o_orderkey % 300 AS INT) AS d FROM orders) WHERE d >= DATE '2025-02-01'""",
)
def q_page_listing(spark, sf):
    return layouts.page_listing(listing_pages(spark, sf), "o_orderkey", "html", "url", "layout", "2025-02-01", "2025-12-01")


@query("unknown_layouts", "SELECT page_id, source AS layout FROM (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'odd_cms' WHEN page_id % 4 = 1 THEN NULL ELSE 'evo_framework' END AS source FROM pages) WHERE source IS DISTINCT FROM 'evo_framework'")
def q_unknown_layouts(spark, sf):
    layout = F.when(F.col("page_id") % 4 == 0, "odd_cms").when(F.col("page_id") % 4 != 1, "evo_framework")
    return layouts.unknown_layouts(table(spark, sf, "pages").select("page_id", layout.alias("layout")), "layout")


@query(
    "layout_registry",
    f"""SELECT l AS layout, count(*) AS pages, count(*) FILTER (o_orderpriority <> '5-LOW' OR l IN ('new_senate_cms', 'evo_framework', 'search_results', 'generic_links')) AS listed FROM (
      SELECT o_orderpriority, {_NAMES}[o_orderkey % 15 + 1] AS l FROM orders) GROUP BY 1""",
)
def q_layout_registry(spark, sf):
    """Pages per registered layout and how many of them the layout itself, without the fallback, can read."""
    given = listing_pages(spark, sf)
    read = layouts.page_listing(given, "o_orderkey", "html", "url", "layout", "2025-01-01", "2025-12-01", fallback=False)
    hits = read.select("o_orderkey").distinct().withColumn("hit", F.lit(1))
    return given.select("o_orderkey", "layout").join(hits, "o_orderkey", "left").groupBy("layout").agg(
        F.count("*").alias("pages"), F.count("hit").alias("listed")
    )


_RULE_LINKS = {
    # link: rules (by layout) that take it
    '<li><a href="/t{}.pdf">Agenda</a></li>': ("drupal_table", "wordpress_blog", "coldfusion_table"),
    '<li><a href="/files/t{}.pdf">Agenda</a></li>': ("drupal_table", "wordpress_blog", "coldfusion_table", "aspnet_card", "evo_framework"),
    '<li><a href="/w{}.doc">Witness list</a></li>': ("drupal_table", "wordpress_blog"),
    '<li><a href="/get?file_id={}">Statement</a></li>': ("coldfusion_table",),
    '<li><a href="https://docs.house.gov/m/{}">Testimony</a></li>': ("evo_framework",),
    '<li><a href="/video/{}.pdf">Testimony</a></li>': (),
}
_RULES = ["drupal_table", "wordpress_blog", "coldfusion_table", "aspnet_card", "evo_framework"]


@query(
    "link_rule_registry",
    f"""SELECT page_id, layout, CAST(CASE layout {' '.join(f"WHEN '{r}' THEN {sum(r in rules for rules in _RULE_LINKS.values())}" for r in _RULES)} END AS BIGINT) AS accepted
    FROM (SELECT page_id, unnest({s.sql_list(_RULES)}) AS layout FROM pages)""",
)
def q_link_rule_registry(spark, sf):
    """Every rule of the registry over the links of every page."""
    extra = F.concat(F.lit("<ul>"), *[_fill(x, False) for x in _RULE_LINKS], F.lit("</ul>"))
    given = table(spark, sf, "pages").select("page_id", pages.links(F.concat("html", extra), F.col("url")).alias("ls"))
    every = given.select("page_id", "ls", F.explode(F.array(*[F.lit(r) for r in _RULES])).alias("layout"))
    taken = F.filter("ls", lambda x: pages.link_accept(F.col("layout"), x))
    return every.select("page_id", "layout", F.size(taken).cast("bigint").alias("accepted"))


_DOC_BLOCK = {
    0: ("drupal_table", '<div class="files"><a href="/download/t{}">Testimony of A</a> <p><a href="/news/{}.html">News</a></p> <a href="/b{}.pdf">Press Release</a></div>', "/download/t{}"),
    1: ("wordpress_blog", '<div class="entry-content"><p><a href="/wp-content/uploads/2026/02/s{}.pdf">Agenda</a></p><p><a href="/video/{}.pdf">Video</a></p></div>', "/wp-content/uploads/2026/02/s{}.pdf"),
    2: ("coldfusion_table", '<div><a href="/public/?a=Files.Serve&amp;File_id={}&section=2&copy=3">Statement</a> <a href="/a{}/">Archive</a></div>', "/public/?a=Files.Serve&File_id={}&section=2&copy=3"),
    3: ("evo_framework", '<div><a href="https://docs.house.gov/m/{}">Testimony of B</a> <a href="/x{}.pdf">Charter</a></div>', "https://docs.house.gov/m/{}|/x{}.pdf"),
    4: ("html_table", '<ul><li><a href="/r{}.pdf">Report</a></li><li><a href="/s{}.pdf">Written statement</a></li></ul>', "/s{}.pdf"),
    5: ("aspnet_card", '<ul><li><a href="/r{}.pdf">Report</a></li><li><a href="/q{}.pdf">Appendix</a></li></ul>', "/r{}.pdf|/q{}.pdf"),
}


def _fill(template: str, sql: bool):
    parts = template.split("{}")
    return " || page_id || ".join(s.q(p) for p in parts) if sql else F.concat(*[x for i, p in enumerate(parts) for x in ([F.lit(p)] if i == 0 else [F.col("page_id").cast("string"), F.lit(p)])])


def _expected(urls: str) -> str:
    return " || '|' || ".join(("" if u.startswith("http") else "o || ") + _fill(u, True) for u in urls.split("|"))


@query(
    "page_documents",
    f"""SELECT page_id, CASE page_id % 6 {' '.join(f"WHEN {i} THEN {_expected(u)}" for i, (_, _, u) in _DOC_BLOCK.items())} END AS pdf_urls, CAST(len(string_split(CASE page_id % 6 {' '.join(f"WHEN {i} THEN {s.q(u)}" for i, (_, _, u) in _DOC_BLOCK.items())} END, '|')) AS BIGINT) AS n_docs,
      CASE WHEN page_id % 2 = 0 THEN 'vid_' || lpad(CAST(page_id AS VARCHAR), 7, '0') END AS embed_id FROM (SELECT *, {_ORIGIN} AS o FROM pages)""",
)
def q_page_documents(spark, sf):
    pid = F.col("page_id").cast("string")
    block, layout = F.lit(""), F.lit("")
    for i, (name, html, _) in _DOC_BLOCK.items():
        block = F.when(F.col("page_id") % 6 == i, _fill(html, False)).otherwise(block)
        layout = F.when(F.col("page_id") % 6 == i, name).otherwise(layout)
    frame = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit('<iframe src="https://www.youtube.com/embed/vid_'), F.lpad(pid, 7, "0"), F.lit('"></iframe>'))).otherwise("")
    full = F.concat("html", block, frame)
    docs = wide_table(spark, sf, "pages", "page_id", "url", "html").select("page_id", "url", full.alias("html"), layout.alias("layout"))
    out = pages.page_documents(docs, "page_id", "html", "url", "layout")
    return out.select("page_id", F.array_join("pdf_urls", "|").alias("pdf_urls"), F.size("pdf_urls").cast("bigint").alias("n_docs"), "embed_id")


@query(
    "link_accept",
    f"""SELECT page_id, abs_url, accepted FROM (SELECT page_id, o || '/t' || page_id || '.pdf' AS abs_url, TRUE AS accepted FROM (SELECT page_id, {_ORIGIN} AS o FROM pages)
      UNION ALL SELECT page_id, o || '/live' || page_id || '.pdf', FALSE FROM (SELECT page_id, {_ORIGIN} AS o FROM pages)
      UNION ALL SELECT page_id, o || '/w' || page_id || '.doc', TRUE FROM (SELECT page_id, {_ORIGIN} AS o FROM pages)
      UNION ALL SELECT page_id, o || '/z' || page_id || '.doc', FALSE FROM (SELECT page_id, {_ORIGIN} AS o FROM pages))""",
)
def q_link_accept(spark, sf):
    body = _fill('<ul><li><a href="/t{}.pdf">Agenda</a></li><li><a href="/live{}.pdf">Livestream</a></li><li><a href="/w{}.doc" title="Witness list">List</a></li><li><a href="/z{}.doc">Minutes</a></li></ul>', False)
    df = table(spark, sf, "pages").select("page_id", F.explode(pages.links(body, F.col("url"))).alias("l"))
    return df.select("page_id", F.col("l.abs_url").alias("abs_url"), pages.link_accept(F.lit("drupal_table"), F.col("l")).alias("accepted"))


@query(
    "html_to_text",
    """SELECT page_id, regexp_replace(regexp_replace(t, '[ \\t]*\\n\\s*', chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS plain FROM (
      SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)\\b.*?</(?:script|style)\\s*>|<!--.*?-->', '', 'g'), '(?s)<[^>]+>', chr(10), 'g'),
        '&nbsp;', ' '), '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&lt;', '<'), '&amp;?', '&', 'g') AS t FROM pages)""",
)
def q_html_to_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", pages.html_to_text(F.col("html")).alias("plain"))


@query(
    "artifact_text_stats",
    """SELECT doc_id, 'doc_' || doc_id || '.pdf' AS file_name, CAST(length(text) AS BIGINT) AS chars FROM documents WHERE lang <> 'es' AND regexp_matches(text, '\\S')""",
)
def q_artifact_text_stats(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("https://x.org/files/doc "), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, ".pdf").otherwise("")).alias("url"),
        F.when(F.col("lang") == "es", "  \n ").otherwise(F.col("text")).alias("text"),
    )
    return pages.artifact_text_stats(docs, "url", "text").select("doc_id", "file_name", "chars")


# ---------------------------------------------------------------- sinks

_ARTS = s.sql_list(fv.ARTIFACT_PRIORITY)


@query(
    "publish_best",
    f"""WITH {s.RECORDS}, a AS (SELECT l_orderkey, l_linenumber, {_ARTS}[l_linenumber] AS kind, CASE WHEN l_returnflag = 'R' THEN '' ELSE 'text ' || l_partkey END AS text, l_partkey FROM lineitem WHERE l_linenumber <= 7),
      b AS (SELECT l_orderkey, l_linenumber, min(text) AS text, min(kind) AS kind FROM a WHERE text <> '' GROUP BY 1, 2)
    SELECT o_orderkey, k AS block_key, d AS event_date, k || '/' || strftime(d, '%Y-%m-%d') || '_' || o_orderkey AS path, first(kind ORDER BY l_linenumber) AS kind, first(text ORDER BY l_linenumber) AS text, t AS title,
      'e' || o_orderkey AS meta_id, strftime(d, '%Y-%m-%d') AS meta_day, '2002-01-01' AS published_at
    FROM base JOIN b ON o_orderkey = l_orderkey GROUP BY o_orderkey, k, d, t""",
)
def q_publish_best(spark, sf):
    rec = base_records(spark, sf).select("o_orderkey", F.col("k").alias("block_key"), F.col("d").alias("event_date"), F.col("t").alias("title"))
    kind = F.get(F.array(*[F.lit(x) for x in fv.ARTIFACT_PRIORITY]), F.col("l_linenumber") - 1)
    body = F.when(F.col("l_returnflag") == "R", "").otherwise(F.concat(F.lit("text "), F.col("l_partkey").cast("string")))
    arts = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), kind.alias("kind"), body.alias("text"))
    arts = arts.filter("text <> ''").groupBy("o_orderkey", "kind").agg(F.min("text").alias("text"))
    rec = rec.withColumn("o_orderkey", F.concat(F.lit("e"), F.col("o_orderkey").cast("string")))
    arts = arts.withColumn("o_orderkey", F.concat(F.lit("e"), F.col("o_orderkey").cast("string")))
    back = sinks.publish_best(rec, arts, "o_orderkey", scratch_path(spark, "published"), "2002-01-01")
    number = F.substr("o_orderkey", F.lit(2))
    meta = {name: F.get_json_object("meta", f"$.{field}") for name, field in (("title", "title"), ("meta_id", "id"), ("meta_day", "event_date"), ("published_at", "published_at"))}
    path = F.regexp_replace("path", r"_e(\d+)$", "_$1")
    return back.select(number.cast("bigint").alias("o_orderkey"), "block_key", "event_date", path.alias("path"), "kind", "text", *[v.alias(k) for k, v in meta.items()])


@query(
    "published_files",
    f"""WITH {s.RECORDS} SELECT k AS block_key, d AS event_date, count(*) AS n, min(o_orderkey) AS first_id FROM base GROUP BY 1, 2""",
)
def q_published_files(spark, sf):
    """Write, then read back the written partitions."""
    rec = base_records(spark, sf).select(
        "o_orderkey", F.col("k").alias("block_key"), F.col("d").alias("event_date"), F.col("t").alias("title")
    )
    arts = rec.select("o_orderkey", F.lit("captions").alias("kind"), F.col("title").alias("text"))
    back = sinks.publish_best(rec, arts, "o_orderkey", scratch_path(spark, "published"), "2002-01-01")
    return back.groupBy("block_key", "event_date").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_id"))


@query(
    "manifest_upsert",
    """SELECT o_orderkey AS id, 'old ' || o_custkey AS title, TIMESTAMP '2002-01-01' AS last_updated FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, 'new ' || o_custkey, TIMESTAMP '2002-01-01' FROM orders WHERE o_orderstatus = 'P'""",
)
def q_manifest_upsert(spark, sf):
    orders = table(spark, sf, "orders")

    def entries(where, prefix):
        return orders.filter(where).select(F.col("o_orderkey").alias("id"), F.concat(F.lit(prefix), F.col("o_custkey").cast("string")).alias("title"))

    merged = sinks.manifest_upsert(entries("o_orderstatus <> 'P'", "old "), entries("o_orderstatus <> 'F'", "new "), "id", "2002-01-01")
    root = scratch_path(spark, "manifest")
    sinks.write_manifest(merged, root, 1)
    return sinks.read_manifest(spark, root)


@query(
    "run_report_json",
    """SELECT o_orderpriority AS run_id, 'header' AS section, -1::BIGINT AS line_id, count(*) FILTER (o_orderstatus <> 'P') AS processed, count(*) FILTER (o_orderstatus = 'P') AS failed,
      CAST(round(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,6))) FILTER (o_orderstatus <> 'P'), 0), 2) AS DOUBLE) AS total_usd,
      CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) AS finished, NULL AS status, NULL AS error FROM orders GROUP BY 1
    UNION ALL SELECT o_orderpriority, 'item', o_orderkey, NULL, NULL, CAST(o_totalprice AS DOUBLE), CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END, o_orderstatus, NULL FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderpriority, 'error', o_orderkey, NULL, NULL, NULL, NULL, NULL, 'failed "' || o_custkey || '"' FROM orders WHERE o_orderstatus = 'P'""",
)
def q_run_report_json(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("run_id"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total_usd"),
        F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0).alias("finished"), "o_custkey",
    )
    items = orders.filter("status <> 'P'").drop("o_custkey")
    errors = orders.filter("status = 'P'").select("run_id", "id", F.concat(F.lit('failed "'), F.col("o_custkey").cast("string"), F.lit('"')).alias("error"))
    out = sinks.run_report_json(items, errors, "run_id", "id", ["total_usd", "finished"])
    is_header = F.col("section") == "header"

    def value(header, line):
        return F.when(is_header, F.get_json_object("json", f"$.{header}")).otherwise(F.get_json_object("json", f"$.{line}"))

    counts = [F.get_json_object("json", f"$.items_{n}").cast("bigint").alias(n) for n in ("processed", "failed")]
    costs = [value(f"cost.{c}", c).cast("double").alias(c) for c in ("total_usd", "finished")]
    return out.select("run_id", "section", "line_id", *counts, *costs, *[F.get_json_object("json", f"$.{c}").alias(c) for c in ("status", "error")])


@query(
    "alert_append",
    f"""SELECT DATE '2024-02-01' AS alert_date, '  ' || user_id || ' / web' || chr(10) || '    Consecutive failures : ' || streak || chr(10) || '    Last success         : ' ||
      coalesce(strftime(last_success, '%Y-%m-%d %H:%M:%S'), 'never') || chr(10) || '    Last failure          : ' || coalesce(strftime(last_failure, '%Y-%m-%d %H:%M:%S'), 'unknown') AS message FROM ({_STREAK}) WHERE streak >= 2""",
)
def q_alert_append(spark, sf):
    failing = failing_list(streaks(spark, sf), 2).withColumn("source", F.lit("web"))
    return sinks.alert_append(failing, "user_id", "source", "2024-02-01", scratch_path(spark, "alerts"))
