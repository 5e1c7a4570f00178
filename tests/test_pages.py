import pytest
from pyspark.sql import functions as F

from recordlink.functions import dates
from recordlink.functions.bind import cut
from recordlink.operators import filters
from recordlink.sources import layouts, listings, pages, sinks
from recordlink.streaming import jobs


def listing(spark, layout, html, url="https://example.gov/list", cutoff="2026-01-01", fallback=False):
    df = spark.createDataFrame([(1, layout, html, url)], "p int, layout string, html string, url string")
    rows = layouts.page_listing(df, "p", "html", "url", "layout", cutoff, "2026-03-01", fallback).collect()
    return sorted((r["title"], str(r["event_date"]), r["url"]) for r in rows)


TABLE = """<table class="{c}"><tr><td>Room 4</td><td><a href="/hearings/03/02/2026/salmon">Salmon ladders along the upper river</a></td><td>March 2, 2026</td></tr>
<tr><td>Room 9</td><td><a href="/hearings/06/30/2019/weirs">Weirs and sluices, a first look</a></td><td>June 30, 2019</td></tr></table>"""
CARDS = """<div class="wrap"><div class="hearing-item"><a href="/hearings/kelp-farming-02-19-2026">Kelp farming in cold water</a><em>February 19, 2026</em></div>
<div class="hearing-item"><em>October 8, 2025</em><a href="/hearings/oysters-10-08-2025">Oyster beds after the storm season</a></div></div>"""
TIMED = """<div class="hearing-item"><time datetime="2026-01-21T09:30:00">21 Jan</time><div><a href="/events/otters">Counting otters from the air</a></div></div>
<div class="hearing-item"><time datetime="2023-11-04T09:30:00">4 Nov</time><div><a href="/events/herons">Heron nests in willow stands</a></div></div>"""
SLOTS = """<div class="single-event"><div class="date-block"><span class="month">Jan</span> <span class="day">27</span> <span class="year">2026</span></div>
<div class="info"><a href="/events/peat">Peat bogs as a water store</a></div></div>
<div class="single-event"><div class="date-block"><span class="month">Sep</span><span class="day">3</span><span class="year">2024</span></div><div class="info"><a href="/events/reeds">Reed cutting</a></div></div>"""
GENERIC = """<main><ul><li><i>January 14, 2026</i><a href="/meetings/lichen">Lichen as a sign of clean air</a></li>
<li><i>February 23, 2026</i><a href="/meetings/moss">Moss roofs for bus shelters</a></li>
<li><i>May 5, 2018</i><a href="/meetings/ferns">Ferns of the northern gorge</a></li><li><a href="/older">Next</a></li></ul></main>"""

CASES = [
    ("drupal_table", TABLE.format(c="table table-striped"), [("Salmon ladders along the upper river", "2026-03-02", "/hearings/03/02/2026/salmon")]),
    ("coldfusion_table", TABLE.format(c="recordList"), [("Salmon ladders along the upper river", "2026-03-02", "/hearings/03/02/2026/salmon")]),
    ("drupal_table", TABLE.format(c="grid"), []),
    ("new_senate_cms", CARDS, [("Kelp farming in cold water", "2026-02-19", "/hearings/kelp-farming-02-19-2026")]),
    ("new_senate_cms", '<div><a href="/hearings/lease">A lease on the quarry that runs until August 8, 2044</a></div>', []),
    ("drupal_links", '<ol><li><a href="/2026/1/otter-census">Otter census, part two</a> 1/29/2026</li><li><a href="/2026/2/z">No day is given here</a></li><li><a href="/2026/2/q">Read more about rivers</a></li></ol>',
     [("Otter census, part two", "2026-01-29", "/2026/1/otter-census"), ("No day is given here", "2026-02-01", "/2026/2/z")]),
    ("wordpress_blog", '<article class="et_pb_post"><h2><a href="https://w.example/2026/01/16/beavers/">Beavers at work</a></h2></article>', [("Beavers at work", "2026-01-16", "https://w.example/2026/01/16/beavers/")]),
    ("wordpress_elementor", '<div class="jet-listing-grid__item k"><div>Jan 9, 2026</div><a href="/n/7">Names for three new wells</a></div>', [("Names for three new wells", "2026-01-09", "/n/7")]),
    ("evo_framework", TIMED, [("Counting otters from the air", "2026-01-21", "/events/otters")]),
    ("aspnet_card", '<article class="card-h-event"><a href="/n/toads">Toad tunnels &amp; fences</a><time datetime="2026-02-25">soon</time></article>', [("Toad tunnels & fences", "2026-02-25", "/n/toads")]),
    ("html_table", "<table><tr><td>1/30/2026</td><td><a href='/n/8?a=1&amp;b=2'>Gravel pits in winter</a></td></tr></table>", [("Gravel pits in winter", "2026-01-30", "/n/8?a=1&b=2")]),
    ("html_table", TIMED + "<table><tr><td><a href='/n/8'>Gravel pits in winter</a></td><td>1/30/2026</td></tr></table>", [("Counting otters from the air", "2026-01-21", "/events/otters")]),
    ("wordpress_single_event", SLOTS, [("Peat bogs as a water store", "2026-01-27", "/events/peat")]),
    ("tribe_events", '<article class="tribe-events-y"><time datetime="2026-01-06">6th</time><h3><a href="/n/9">Night walk with lanterns</a></h3></article>', [("Night walk with lanterns", "2026-01-06", "/n/9")]),
    ("wordpress_featured_post", '<div class="post tall"><a href="/n/10">Rain gauges for schools</a> January 22, 2026</div><div class="postage"><a href="/n/11">Stamps are no post here</a> January 22, 2026</div>', [("Rain gauges for schools", "2026-01-22", "/n/10")]),
    ("wordpress_calblocker", '<article class="calblocker">Jan 13, 2026 <a href="/n/12">Maps of old ferries</a></article>', [("Maps of old ferries", "2026-01-13", "/n/12")]),
    ("generic_links", GENERIC, [("Lichen as a sign of clean air", "2026-01-14", "/meetings/lichen"), ("Moss roofs for bus shelters", "2026-02-23", "/meetings/moss")]),
    ("generic_links", '<section><a href="/event/hay">Hay meadows and when to mow them</a><time datetime="2026-01-28T18:00:00">Jan 28</time></section>', [("Hay meadows and when to mow them", "2026-01-28", "/event/hay")]),
    ("search_results", '<div><a href="/program/r/p/41"></a><a href="/program/r/p/41">Harbour master speaks</a><p>JANUARY 19, 2026</p></div><div><a href="/event/r/p/9">Locks and lifts</a><p>MARCH 3, 2022</p></div>',
     [("Harbour master speaks", "2026-01-19", "/program/r/p/41")]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_layout(spark, case):
    layout, html, want = CASES[case]
    full = [(t, d, u if u.startswith("http") else "https://example.gov" + u) for t, d, u in want]
    assert listing(spark, layout, html) == sorted(full)


def test_every_layout_has_a_case():
    assert {c[0] for c in CASES} == set(layouts.layout_registry)


def test_fallback_to_generic_links(spark):
    assert len(listing(spark, "tribe_events", GENERIC, fallback=True)) == 2
    assert listing(spark, "tribe_events", GENERIC, fallback=False) == []
    assert listing(spark, "youtube_only", GENERIC, fallback=True) == []


def test_an_unknown_layout_fails(spark):
    with pytest.raises(Exception, match="unknown page layout: odd_cms"):
        listing(spark, "odd_cms", GENERIC)


def test_listing_has_no_join_sort_or_exchange(spark):
    df = spark.createDataFrame([(1, "html_table", GENERIC, "https://e.example/l")], "p int, layout string, html string, url string")
    plan = layouts.page_listing(df, "p", "html", "url", "layout", "2026-01-01", "2026-03-01")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Join", "Sort", "Exchange"))


ENTITIES = [("a &amp; b", "a & b"), ("&lt;&middot;&copy;", "<·©"), ("&#228;&#xE4;&#x1F600;", "ää😀"), ("&amp;lt;", "&lt;"), ("x&nbsp;y", "x y"), ("AT&T &unknown; &", "AT&T &unknown; &"), ("&copy 2020 &copy;&lt x", "&copy 2020 ©&lt x"), ("none", "none"), ("&#0;", "\ufffd")]


@pytest.mark.parametrize("raw, want", ENTITIES)
def test_entities(one, raw, want):
    assert one(pages.decode_entities(F.col("x")), x=raw) == want


HREFS = [
    ("/x?id=1&section=2&region=3&copy=4", "/x?id=1&section=2&region=3&copy=4"), ("/x?a=1&amp;b=2&lt=3", "/x?a=1&b=2&lt=3"), ("/a&copy", "/a©"),
    ("/a&copyright/&para-1&notit;&reg;x", "/a&copyright/¶-1&notit;®x"), ("?q=&#65;&#x42&sect1", "?q=AB&sect1"), ("&AMP&amp", "&&"), ("&&", "&&"),
]


@pytest.mark.parametrize("raw, want", HREFS)
def test_attribute_references(one, raw, want):
    assert one(pages.decode_attribute(F.col("x")), x=raw) == want


def test_links_keep_query_names(spark):
    df = spark.createDataFrame([(1, '<a href="/x?id=1&section=2&region=3&copy=4">A &amp; B</a>', "https://e.org/l")], "p int, html string, url string")
    row = pages.page_links(df, "p", "html", "url").first()
    assert (row["href"], row["abs_url"], row["text"]) == ("/x?id=1&section=2&region=3&copy=4", "https://e.org/x?id=1&section=2&region=3&copy=4", "A & B")


def test_unknown_layouts(spark):
    df = spark.createDataFrame([(1, "drupal_table"), (2, "odd"), (3, None), (4, "youtube_only")], "p int, l string")
    assert sorted(r["p"] for r in layouts.unknown_layouts(df, "l").collect()) == [2, 3]


def test_registries_agree():
    assert set(pages.link_rule_registry) <= set(layouts.layout_registry)


def docs(spark, layout, html, url="https://x.senate.gov/h/1", group=None):
    df = spark.createDataFrame([(1, layout, html, url, "senate")], "p int, layout string, html string, url string, g string")
    return pages.page_documents(df, "p", "html", "url", "layout", group).first()


DRUPAL = """<div><h3>Papers</h3><ol><li><a href="/download/otter-paper.pdf">Testimony of the warden</a></li>
<li><a href=/download/heron-note>Statement of the ringers</a></li><li><a href="/services/files/77Q">Written testimony, angling club</a></li></ol>
<a href="/meetings/later">What comes next</a><a href="https://www.youtube.com/watch?v=zzz">Live picture</a></div>"""
WP = """<div class="entry-content"><p><a href="/wp-content/uploads/2025/11/moss.pdf">Testimony on moss</a></p>
<p><a href="/wp-content/uploads/2025/12/order.pdf">Order of the day</a></p><p><a href="/team/">Team</a></p></div>"""
HOUSE = """<div><a href="https://docs.house.gov/q/testimony-peat.pdf">Testimony about peat</a>
<a href="/sites/default/files/documents/terms.pdf">Terms of the inquiry</a><a href="https://www.youtube.com/watch?v=yyy">Picture</a></div>"""
PLAIN = '<a href="/store/rain-2025.pdf">Rainfall</a><a href="/store/tables.pdf">Tables</a><a href="/diary">Diary</a>'


def test_documents_by_platform(spark):
    assert docs(spark, "drupal_table", DRUPAL)["pdf_urls"] == [f"https://x.senate.gov{u}" for u in ("/download/otter-paper.pdf", "/download/heron-note", "/services/files/77Q")]
    assert [u.rsplit("/", 1)[1] for u in docs(spark, "wordpress_blog", WP)["pdf_urls"]] == ["moss.pdf", "order.pdf"]
    assert [u.rsplit("/", 1)[1] for u in docs(spark, "evo_framework", HOUSE)["pdf_urls"]] == ["testimony-peat.pdf", "terms.pdf"]
    assert [u.rsplit("/", 1)[1] for u in docs(spark, "html_table", PLAIN)["pdf_urls"]] == ["rain-2025.pdf", "tables.pdf"]
    assert docs(spark, "evo_framework", "<p>nothing</p>")["pdf_urls"] == []
    twice = '<a href="/a.pdf">One</a><a href="/a.pdf/">Two</a><a href="https://x.senate.gov/a.pdf">Three</a>'
    assert docs(spark, "drupal_table", twice)["pdf_urls"] == ["https://x.senate.gov/a.pdf"]


def test_page_media(spark):
    html = '<iframe src="https://www.youtube.com/embed/QwErTy78_-0"></iframe><iframe src="https://www.senate.gov/isvp/?comm=tide&amp;filename=tide010926"></iframe>'
    r = docs(spark, "drupal_table", html)
    assert (r["embed_id"], r["stream_comm"], r["stream_file"]) == ("QwErTy78_-0", "tide", "tide010926")


def test_html_to_text(one):
    html = "<html><head><style>p{}</style></head><body><h1>A &amp; B</h1><script>x<y</script><p>One<br>Two</p></body></html>"
    assert one(pages.html_to_text(F.col("x")), x=html) == "A & B\nOne\nTwo"


def test_restarted_streak_keeps_its_state(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id bigint, k string, ts timestamp, ok boolean"

    def put(rows):
        spark.createDataFrame(rows, "id bigint, k string, s string, ok boolean").selectExpr("id", "k", "timestamp(s) ts", "ok").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = jobs.read_files(spark, source, spark.createDataFrame([], schema).schema)
        state, _ = jobs.stream_failure_streak(stream, "k", "ts", "id", F.col("ok"), 3, root)
        return {r["k"]: r["streak"] for r in state.collect()}

    put([(1, "a", "2024-01-01 00:00:00", False), (2, "b", "2024-01-01 00:00:00", True)])
    assert run() == {"a": 1, "b": 0}
    put([(3, "a", "2024-01-02 00:00:00", False), (4, "a", "2024-01-02 00:00:01", False)])
    assert run() == {"a": 3, "b": 0}
    assert run() == {"a": 3, "b": 0}  # nothing new


def test_streak_over_no_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = jobs.read_files(spark, str(tmp_path / "in"), spark.createDataFrame([], "id bigint, k string, ts timestamp, ok boolean").schema)
    state, alerts = jobs.stream_failure_streak(stream, "k", "ts", "id", F.col("ok"), 3, str(tmp_path / "out"))
    assert state.count() == 0 and alerts.count() == 0


def test_delimited_listing(spark):
    lines = ["v1\tTitle\t20260210\t700.5", "v1\tAgain\t20260210\t1", "v2\tT\tNA\t5", "v3\tT\t20260101\t5", "v4\tT\t20260210\tNA", "v5\tshort\t20260210", "v6\tA\t20260205\t9\textra"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    out = sorted((r["id"], r["title"], str(r["event_date"]), r["duration_s"]) for r in listings.delimited_listing(df, "line", "2026-02-05", ["i"]).collect())
    assert out == [("v1", "Title", "2026-02-10", 700), ("v4", "T", "2026-02-10", 0), ("v6", "A", "2026-02-05", 0)]
    assert listings.delimited_listing(df, "line", "2026-02-05", ["i"], bad_duration="drop").count() == 1


def test_registry_and_tiers(spark):
    doc = '{"house.a": {"name": "A", "tier": 1}, "senate.b": {"name": "B"}, "house.c": {"tier": 2}}'
    reg = listings.registry_explode(spark.createDataFrame([(doc,)], "j string"), "j", "name string, tier int")
    assert {r["key"] for r in filters.tier_filter(reg, "tier").collect()} == {"house.a", "house.c"}
    assert filters.tier_filter(reg, "tier", 3).count() == 3
    assert filters.tier_filter(reg, "tier", key_col="key", key="senate.b").count() == 1
    with pytest.raises(ValueError):
        filters.tier_filter(reg, "tier", key_col="key", key="nope")


def test_filters(spark):
    rows = [(1, "Markup of H.R. 1", False), (2, "Markup of H.R. 1", True), (3, "Budget Hearing", None)]
    df = spark.createDataFrame(rows, "i int, t string, v boolean")
    assert [r["i"] for r in filters.procedural_filter(df, "t", F.col("v")).orderBy("i").collect()] == [2, 3]
    vids = spark.createDataFrame([(1, "Opening Statement of X", 9000), (2, "Hearing", 599), (3, "Hearing", 600), (4, "Hearing", None)], "i int, t string, d int")
    recs, clips = filters.route_clips(vids, "t", "d")
    assert [r["i"] for r in recs.collect()] == [3] and clips.count() == 3


def test_publish_and_manifest(spark, tmp_path):
    recs = spark.createDataFrame([(1, "house.a", "2026-02-10", "T1"), (2, "house.a", "2026-02-11", "T2")], "id int, block_key string, d string, title string")
    recs = recs.withColumn("event_date", F.col("d").cast("date")).drop("d")
    arts = spark.createDataFrame([(1, "captions", "cap"), (1, "isvp_cleaned", "isvp"), (2, "captions", "")], "id int, kind string, text string")
    out = sinks.publish_best(recs, arts, "id", str(tmp_path / "pub"), "2026-03-01").collect()
    assert [(r["id"], r["kind"], r["text"], r["path"]) for r in out] == [(1, "isvp_cleaned", "isvp", "house.a/2026-02-10_1")]
    assert '"title":"T1"' in out[0]["meta"]
    root = str(tmp_path / "man")
    old = recs.select("id", "title").filter("id = 1")
    sinks.write_manifest(sinks.manifest_upsert(old.limit(0), old, "id", "2026-01-01"), root, 1)
    current = sinks.read_manifest(spark, root).select("id", "title")
    sinks.write_manifest(sinks.manifest_upsert(current, recs.select("id", F.lit("new").alias("title")), "id", "2026-01-02"), root, 2)
    assert sorted((r["id"], r["title"]) for r in sinks.read_manifest(spark, root).collect()) == [(1, "T1"), (2, "new")]


def test_alert_text(spark, tmp_path):
    df = spark.createDataFrame([("k", "web", 3)], "k string, s string, streak bigint")
    df = df.withColumn("last_success", F.lit(None).cast("timestamp")).withColumn("last_failure", F.lit("2026-02-01 10:00:00").cast("timestamp"))
    for _ in range(2):
        sinks.alert_append(df, "k", "s", "2026-02-01", str(tmp_path / "al"))
    text = spark.read.text(str(tmp_path / "al")).collect()
    assert sum("never" in r["value"] for r in text) == 1 and sum("2026-02-01 10:00:00" in r["value"] for r in text) == 1  # a retry overwrites


# ---------------------------------------------------------------- streams over several batches


def write_batches(spark, path, batches):
    import os
    import time

    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "id bigint, k string, ts string, ok boolean").withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(path)
        for name in os.listdir(path):
            if name.endswith(".parquet") and not name.startswith("b"):
                new = os.path.join(path, f"b{i}.parquet")
                os.rename(os.path.join(path, name), new)
                os.utime(new, (time.time() - 1000 + i * 10,) * 2)
        for name in os.listdir(path):
            if name.endswith(".crc"):
                os.remove(os.path.join(path, name))
    return jobs.read_files(spark, path, spark.read.parquet(path).schema, 1)


def test_streak_over_batches(spark, tmp_path):
    t = "2026-01-01 00:{:02d}:00"
    batches = [
        [(1, "a", t.format(1), False), (2, "a", t.format(2), False), (3, "b", t.format(3), True)],
        [(4, "a", t.format(4), False), (5, "b", t.format(5), False)],
        [(6, "a", t.format(6), True), (7, "a", t.format(7), False), (8, "c", t.format(8), False)],
    ]
    stream = write_batches(spark, str(tmp_path / "in"), batches)
    state, alerts = jobs.stream_failure_streak(stream, "k", "ts", "id", F.col("ok"), 3, str(tmp_path / "out"))
    assert {r["k"]: r["streak"] for r in state.collect()} == {"a": 1, "b": 1, "c": 1}
    assert [(r["k"], r["streak"]) for r in alerts.collect()] == [("a", 3)]


def test_ingest_passes_each_record_once(spark, tmp_path):
    t = "2026-01-{:02d} 00:00:00"
    batches = [[(1, "a", t.format(5), True), (2, "a", t.format(5), True)], [(2, "a", t.format(5), True), (3, "a", t.format(6), True)], [(9, "a", t.format(1), True), (3, "a", t.format(6), True)]]
    out = jobs.stream_ingest(write_batches(spark, str(tmp_path / "in"), batches), "id", "ts", "2 days", str(tmp_path / "out"))
    assert sorted(r["id"] for r in out.collect()) == [1, 2, 3]


def test_sessions_over_batches_and_late_rows(spark, tmp_path):
    t = "2026-01-01 {}:00"
    batches = [
        [(1, "a", t.format("00:00"), True), (2, "a", t.format("00:05"), True)],
        [(3, "a", t.format("00:12"), True), (4, "b", t.format("00:12"), True)],  # goes on with the session of the batch before
        [(5, "a", t.format("02:00"), True)],
        [(8, "c", t.format("02:01"), True)],  # the watermark of the batch before closes both
        [(6, "a", t.format("00:06"), True), (7, "a", t.format("05:00"), True)],  # 6 is late
    ]
    out = jobs.stream_gap_sessions(write_batches(spark, str(tmp_path / "in"), batches), "k", "ts", "10 minutes", "30 minutes", str(tmp_path / "out"))
    got = sorted((r["k"], str(r["session_start"])[11:16], str(r["session_end"])[11:16], r["parts"]) for r in out.collect())
    assert got == [("a", "00:00", "00:22", 3), ("a", "02:00", "02:10", 1), ("b", "00:12", "00:22", 1), ("c", "02:01", "02:11", 1)]


def test_health_counts_over_batches_and_late_rows(spark, tmp_path):
    t = "2026-01-01 {}:00"
    batches = [
        [(1, "ok", t.format("00:10"), True), (2, "bad", t.format("00:20"), True)],
        [(3, "ok", t.format("00:50"), True)],  # a newer value of the same window
        [(4, "ok", t.format("05:00"), True)],
        [(6, "ok", t.format("05:01"), True)],
        [(5, "ok", t.format("00:30"), True)],  # late
    ]
    out = jobs.stream_health_counts(write_batches(spark, str(tmp_path / "in"), batches), "ts", "k", "1 hour", None, "30 minutes", str(tmp_path / "out"))
    assert sorted((str(r["window_start"])[11:13], r["k"], r["n"]) for r in out.collect()) == [("00", "bad", 1), ("00", "ok", 2), ("05", "ok", 2)]


@pytest.mark.parametrize("raw,want", [("<h1>of&amp;&amp</h1>x", "of&&\nx"), ("a&ampb&amp;lt;", "a&b&lt;"), ("&lt &amp", "&lt &")])
def test_page_text_reads_an_ampersand_without_semicolon(one, raw, want):
    assert one(pages.html_to_text(F.col("x")), x=raw) == want


def test_a_listing_is_cut_without_lines_and_without_patterns_compiled_per_row(spark):
    df = spark.createDataFrame([(1, "generic_links", GENERIC, "https://e.example/l")], "p int, layout string, html string, url string").repartition(2)
    plan = layouts.page_listing(df, "p", "html", "url", "layout", "2026-01-01", "2026-03-01", False)._jdf.queryExecution().analyzed().toString()
    assert pages.BLOCK_EDGE not in plan  # the line around a link is not used
    assert plan.count(f", {pages.ITEM_END}, -1)") == 2 and plan.count(f", {pages.ITEM_END}, \x00, 1)") == 2  # the first only for texts with a zero character


@pytest.mark.parametrize("text", ["", "a", "<b>a<B >b", "a<b>", "<b><b>", "x\x00<b>y\x00", "\x00"])
def test_cut_equals_split(one, text):
    assert one(cut(F.col("x"), r"(?i)<b\s*>"), x=text) == one(F.split("x", r"(?i)<b\s*>"), x=text)


def test_dates_found_once_equal_dates(many):
    raw = ["", "x", "2026-02-30 March 1, 2026", "on 2026-03-01", "3/4/26", "13/4/2026 May 1, 2026", "1.2.0099", "12/31/123", "Sept. 4, 2025", "Sep 4 2025", "Foo 4, 2025 May 5, 2025", "June 31, 2025", "MAY 5 2025", "a May 123, 2025", "2025/1/2/2026", "é Mai 1, 2025"]
    assert many(dates.parse_date_once(F.col("x")), raw) == many(dates.parse_date(F.col("x")), raw)
