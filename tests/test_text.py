import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordlink.functions import cost, dates, keys, text, urls
from recordlink.operators import chunks

X = None


@pytest.fixture(autouse=True, scope="module")
def _column(spark):
    """Columns need a running session."""
    global X
    X = F.col("x")


def test_normalize_title(many):
    cases = {
        "HEARING NOTICE: Budget Review": "budget review",
        "Full Committee Hearing: Federal Reserve Policy": "federal reserve policy",
        "02/10/2026 Trade, Tariffs & Growth": "trade tariffs growth",
        "*** NEW *** Farm Bill": "farm bill",
        "Upcoming: Oversight Plans": "oversight plans",
        "An Oversight Hearing to examine border security": "border security",
        "Water Rights Location: Room 5": "water rights",
        "Nominations WASHINGTON, D.C. - Today the panel": "nominations",
        "one two three four five six seven eight nine": "one two three four five six seven eight",
        "Ünited Hearing: Crops": "crops",
        "": "",
    }
    assert many(text.normalize_title(X), list(cases)) == list(cases.values())


def test_slug_and_id(one):
    assert one(text.slug(F.col("k"), F.col("t")), k="house.ways_and_means", t="Tax Reform: Part 2!") == "house-ways-and-means-tax-reform-part-2"
    assert one(text.slug(F.col("k"), F.col("t")), k="joint", t="A") == "joint-unknown-a"
    import hashlib

    want = hashlib.sha256(b"house.a:2026-02-10:ai policy").hexdigest()[:12]
    got = one(text.record_id(F.col("k"), F.col("d").cast("date"), F.col("t")), k="house.a", d="2026-02-10", t="Hearing: AI Policy")
    assert got == want


def test_similarity(one):
    sim = text.token_jaccard(F.col("a"), F.col("b"))
    assert one(sim, a="Budget, Fiscal Year 2026", b="Budget Fiscal Year 2026") == 1.0
    assert one(sim, a="", b="x") == 0.0
    assert one(text.keyword_overlap(F.col("a"), F.col("b")), a="Review of the Farm Bill", b="farm bill hearing on a review") == 2
    assert one(text.search_keywords(X), x="Examining the Impact of AI on Jobs and Wages, Part Two of Three") == "impact jobs wages part two"


def test_sentence_case(many):
    cases = {
        "THANK YOU MR. CHAIRMAN. THE GDP GREW IN THE U.S. ECONOMY.": "Thank you mr. Chairman. The GDP grew in the U.S. Economy.",
        "Already mixed Case stays.": "Already mixed Case stays.",
    }
    assert many(text.sentence_case(X), list(cases)) == list(cases.values())


def test_small_text_functions(one, many):
    assert many(text.safe_filename(X), ["https://x.org/a/b c.pdf", "https://x.org/a/report"]) == ["b_c.pdf", "report.pdf"]
    assert many(text.duration_label(X.cast("int")), ["725", None, "59"]) == ["12m05s", "0m00s", "0m59s"]
    assert one(text.strip_markup(X), x=" <c>Hello</c>   <b>you</b> ") == "Hello you"
    value, label = text.coalesce_priority([("a", F.col("a")), ("b", F.col("b"))])
    assert one(F.concat_ws("/", value, label), a=" ", b="v") == "v/b"
    q = text.search_query(text.search_keywords(F.col("t")), F.col("g"), F.col("d").cast("date"), "s.org", "s.org/p")
    assert one(q, t="Farm Bill", g="House Agriculture", d="2026-01-02") == "s.org House Agriculture farm bill 2026"
    assert one(q, t="the of", g="", d="2026-01-02") is None


def test_parse_date(many):
    cases = {
        "2026-02-05T10:00:00-05:00": "2026-02-05", "01/28/26": "2026-01-28", "2/5/26": "2026-02-05", "12/10/2025": "2025-12-10",
        "01.28.26": "2026-01-28", "01.28.2026": "2026-01-28", "February 5, 2026": "2026-02-05", "Sept 15, 2025": "2025-09-15",
        "Posted: February 5, 2026 - 10:00 AM": "2026-02-05", "Hearing Date: Jan 28, 2026": "2026-01-28", "Room 12, 2026": None,
        "2026-13-45": None, "no date": None, "": None,
        "Smarch 5, 2026": None, "May 3 2026": "2026-05-03",
    }
    got = many(dates.parse_date(X).cast("string"), list(cases))
    assert got == list(cases.values())


def test_dates(one, many):
    assert many(dates.session_number(X.cast("date")), ["2025-01-05", "2026-12-01", "1789-03-04"]) == [119, 119, 1]
    plausible, recent = dates.date_window_flags(X.cast("date"), "2026-01-01", "2026-02-01")
    assert many(F.concat_ws(",", plausible.cast("string"), recent.cast("string")), ["2026-01-01", "2025-12-31", "2031-01-19", None]) == [
        "true,true", "true,false", "false,false", "false,false",
    ]


def test_absolutize_url(many):
    base = F.lit("https://senate.gov/hearings/page?x=1#top")
    cases = {
        "https://e.com/d.pdf": "https://e.com/d.pdf", "/files/t.pdf": "https://senate.gov/files/t.pdf", "doc.pdf": "https://senate.gov/hearings/doc.pdf",
        "../up.pdf": "https://senate.gov/up.pdf", "a/../b.pdf": "https://senate.gov/hearings/b.pdf", "./c.pdf": "https://senate.gov/hearings/c.pdf",
        "../../../d.pdf": "https://senate.gov/d.pdf", "//cdn.org/x": "https://cdn.org/x", "?p=2": "https://senate.gov/hearings/page?p=2",
        "": "", "javascript:void(0)": "", "mailto:a@b.c": "", "#s": "",
    }
    assert many(urls.absolutize_url(X, base), list(cases)) == list(cases.values())
    assert many(urls.absolutize_url(F.lit("doc.pdf"), X), ["https://senate.gov", "https://senate.gov/a/"]) == ["https://senate.gov/doc.pdf", "https://senate.gov/a/doc.pdf"]


def test_document_href_and_ids(many, one):
    hrefs = ["/f/T.PDF", "/download/x", "/services/files/A", "/public/?a=Files.Serve&File_id=A", "/doc?format=pdf", "/hearings/x", "", "/i.jpg"]
    assert many(urls.is_document_href(X), hrefs) == [True] * 5 + [False] * 3
    html = '<p>youtube.com/embed/AAAAAAAAAAA</p><iframe src="https://www.youtube.com/embed/abcDEF12_-9?rel=0"></iframe>'
    assert one(urls.embed_id(X), x=html) == "abcDEF12_-9"
    comm, name = urls.player_params(X)
    pair = F.concat_ws("|", comm, name)
    both = '<iframe class="a" src="https://www.senate.gov/isvp/?type=live&comm=foreign&filename=foreign020426&x=1">'
    assert many(pair, [both, '<iframe src="https://www.senate.gov/isvp/?comm=foreign">', "<p>"]) == ["foreign|foreign020426", "", ""]
    assert many(urls.program_id(X), ["https://t.org/program/a/b/672588", "https://t.org/x/672588"]) == ["672588", None]


def test_keys(many):
    assert many(keys.group_of_key(X), ["house.judiciary", "govinfo.senate", "govinfo", "senate.x"]) == ["house", "senate", "unknown", "senate"]
    assert many(keys.group_of_package(X), ["CHRG-119hhrg1", "CHRG-119SHRG2", "CHRG-119jhrg3"]) == ["house", "senate", "unknown"]
    assert many(keys.parent_code(X), ["hsif16"]) == ["hsif00"]


def test_cost(spark):
    df = spark.createDataFrame([("openai/gpt-4o-mini", 1_000_000, 500_000)], "m string, i bigint, o bigint")
    assert cost.token_cost(df, "m", "i", "o").first()["cost_usd"] == 0.45
    bad = spark.createDataFrame([("nobody/none", 1, 1)], "m string, i bigint, o bigint")
    with pytest.raises(Exception, match="unknown model"):
        cost.token_cost(bad, "m", "i", "o").collect()
    with pytest.raises(ValueError):
        cost.price_maps([("m", -1.0, 0.0)])


def test_retry_plan(spark):
    df = spark.createDataFrame([(0,), (1,), (3,), (4,), (5,), (None,)], "a bigint")
    rows = cost.retry_plan(df, "a", "2026-01-01 00:00:00", base_s=600, max_attempts=5).collect()
    assert [r["delay_s"] for r in rows] == [600, 600, 2400, 3600, None, 600]
    assert rows[4]["next_status"] == "dead_letter" and str(rows[2]["available_at"]) == "2026-01-01 00:40:00"


WORDS = st.lists(st.sampled_from("alpha beta gamma delta hearing house 7 x-ray".split()), max_size=6).map(" ".join)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(WORDS, WORDS), min_size=20, max_size=40))
def test_similarity_is_symmetric_and_bounded(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    ab, ba = text.token_jaccard(F.col("a"), F.col("b")), text.token_jaccard(F.col("b"), F.col("a"))
    for r in df.select("a", "b", ab.alias("ab"), ba.alias("ba"), text.normalize_title(F.col("a")).alias("n")).collect():
        assert r["ab"] == r["ba"] and 0.0 <= r["ab"] <= 1.0
        assert len(r["n"].split()) <= 8


def walked(sizes, size, overlap):
    """Bounds of chunks, paragraph by paragraph."""
    prefix, out, start = [0], [], 0
    for x in sizes:
        prefix.append(prefix[-1] + x)
    for i in range(len(sizes)):
        if i > start and prefix[i + 1] - prefix[start] > size:
            out.append((start, i))
            start = max(start, sum(p < prefix[i] - overlap for p in prefix))
    return [*out, (start, len(sizes))]


def test_chunk_bounds_equal_a_walk(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([0, 1, 3, 10, 40, 200]) for _ in range(rng.choice([1, 2, 5, 300, 700]))]) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, s array<bigint>")
    for size, overlap in ((50, 10), (1, 0), (100, 100), (100, 300)):
        got = {r["i"]: [(b["s"], b["e"]) for b in r["b"]] for r in df.select("i", chunks.chunk_bounds(F.col("s"), size, overlap).alias("b")).collect()}
        assert got == {i: walked(s, size, overlap) for i, s in rows}


def test_chunk_bounds_of_many_paragraphs(spark):
    """Four times the paragraphs take nowhere near sixteen times as long."""
    def seconds(n):
        df = spark.range(1).select(F.array_repeat(F.lit(7).cast("bigint"), n).alias("s"))
        start = time.time()
        assert df.select(F.size(chunks.chunk_bounds(F.col("s"), 300, 60)).alias("n")).first()["n"] > n / 60
        return time.time() - start

    seconds(1000)
    short, long = seconds(20_000), seconds(80_000)
    assert long < 8 * max(short, 0.5)
