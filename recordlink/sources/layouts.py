"""Record listings on HTML pages, by page layout.

The layouts are entries of one literal registry; the same expressions serve all of them, and a new layout is a new
entry. A page is read inside its row, without a join, a sort or a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions import dates, urls
from recordlink.functions.bind import cut, let
from recordlink.sources.pages import anchors, attribute, href_of, plain

NONE = r"(?!)"  # matches nothing


@dataclass
class LayoutSpec:
    """How to find the records of a page.

    Block layouts cut the page at `outer`, then at `block` up to `block_end`, and read the first link of
    `title_scope` in every block. Context layouts read every link and the text around it.
    """

    layout: str
    kind: str = "block"  # block | context
    outer: str = NONE  # opening tag a block must lie behind
    outer_end: str = NONE
    block: str = NONE
    block_end: str = NONE
    block_needs: str = ""  # the block must contain this
    title_scope: str = ""  # part of the block that holds the title link (group 1)
    title_tag: str = ""  # part of the link that holds the title (group 1)
    min_title: int = 10
    href_like: str = ""
    href_not: str = NONE
    stop_words: str = NONE
    url_date: str = NONE  # three groups
    url_order: str = "ymd"
    slot_date: bool = False  # month/day/year in three spans
    time_tag: bool = False
    text_date: bool = True
    text_before_time: bool = False
    month_of_url: bool = False  # first day of /YYYY/M/ in the link when no date is near
    dedup: str = "url"  # url | program
    time_first: bool = False  # try the links of <time> items before the blocks


def _opening(tag: str, classes: str) -> str:
    return rf"""(?i)<{tag}\b[^>]*class=["'][^"']*(?:{classes})[^"']*["'][^>]*>"""


_ROWS = {"outer_end": r"(?i)</table", "block": r"(?i)<tr\b[^>]*>", "block_end": r"(?i)</tr", "block_needs": r"(?i)<td"}
_TABLE = {"outer": _opening("table", "table-striped|recordList"), "url_date": r"/hearings?/(\d{2})/(\d{2})/(\d{4})(?:/|$)", "url_order": "mdy", **_ROWS}
_ARTICLE = {"block_end": r"(?i)</article"}

LAYOUTS = [
    LayoutSpec("drupal_table", **_TABLE),
    LayoutSpec("coldfusion_table", **_TABLE),
    LayoutSpec(
        "new_senate_cms", "context", min_title=5, href_like=r"/(?:committee-activity/)?hearings/[a-z0-9]", href_not=r"[?#]",
        title_tag=r"""(?is)<[^>]*class=["'][^"']*(?:LegislationList__title|ArticleTitle)[^"']*["'][^>]*>(.*?)</""",
        url_date=r"-(\d{2})-(\d{2})-(\d{4})/?$", url_order="mdy", time_tag=True,
    ),
    LayoutSpec("drupal_links", "context", href_like=r"/\d{4}/\d{1,2}/", stop_words="|".join(fv.NAV_WORDS), month_of_url=True),
    LayoutSpec(
        "wordpress_blog", block=_opening("article", "et_pb_post|post"), title_scope=r"(?is)<h2\b[^>]*>(.*?)</h2", min_title=0,
        url_date=r"/(\d{4})/(\d{2})/(\d{2})/", **_ARTICLE,
    ),
    LayoutSpec("wordpress_elementor", block=_opening("div", "jet-listing-grid__item")),
    LayoutSpec("evo_framework", "context", time_tag=True, text_date=False),
    LayoutSpec("aspnet_card", block=_opening("article", "card-h-event|article-item"), time_tag=True, **_ARTICLE),
    LayoutSpec("html_table", outer=r"(?i)<table\b[^>]*>", time_first=True, **_ROWS),
    LayoutSpec(
        "wordpress_single_event", block=r"""(?i)<div\b[^>]*class=["'](?:[^"']*\s)?single-event(?:\s[^"']*)?["'][^>]*>""",
        title_scope=r"""(?is)class=["'](?:[^"']*\s)?info(?:\s[^"']*)?["'][^>]*>(.*)""", min_title=0, slot_date=True, text_date=False,
    ),
    LayoutSpec("tribe_events", block=_opening("article", "tribe-events"), time_tag=True, **_ARTICLE),
    LayoutSpec("wordpress_featured_post", block=r"""(?i)<div\b[^>]*class=["'](?:[^"']*\s)?post(?:\s[^"']*)?["'][^>]*>"""),
    LayoutSpec("wordpress_calblocker", block=_opening("article", "calblocker"), **_ARTICLE),
    LayoutSpec("generic_links", "context", min_title=15, stop_words="|".join(fv.GENERIC_NAV_WORDS), time_tag=True, text_before_time=True),
    LayoutSpec("search_results", "context", href_like=r"/(?:program|event)/", dedup="program"),
]
NO_SITE = "youtube_only"
GENERIC = "generic_links"
layout_registry = {spec.layout: spec for spec in LAYOUTS}


def layout_tries(layout: Column, fallback: bool = True) -> Column:
    """The specs to try in turn for a layout, from the registry as one literal. An unknown or missing layout fails."""
    fields = LayoutSpec.__dataclass_fields__.values()
    types = {"bool": "boolean", "int": "int"}
    schema = ", ".join(f"{f.name}: {types.get(f.type, 'string')}" for f in fields)

    def tries(spec: LayoutSpec) -> list[dict]:
        chain = [layout_registry["evo_framework"]] if spec.time_first else []
        chain.append(spec)
        if fallback and spec.layout != GENERIC:
            chain.append(layout_registry[GENERIC])
        return [asdict(x) for x in chain]

    text = json.dumps({spec.layout: tries(spec) for spec in layout_registry.values()})
    known = F.try_element_at(F.from_json(F.lit(text), f"map<string, array<struct<{schema}>>>"), layout)
    unknown = F.raise_error(F.concat(F.lit("unknown page layout: "), F.coalesce(layout, F.lit("none"))))
    return F.when(layout == NO_SITE, F.array().cast(f"array<struct<{schema}>>")).when(known.isNotNull(), known).otherwise(unknown.cast(f"array<struct<{schema}>>"))


def unknown_layouts(pages: DataFrame, layout: str) -> DataFrame:
    """Pages whose layout is not registered: to be looked at before a run."""
    known = [*layout_registry, NO_SITE]
    return pages.filter(~F.coalesce(F.col(layout), F.lit("")).isin(known))


def _by_pattern(spec: Column, field: str, use: Callable[[str], Column], unset: Column | None = None) -> Column:
    """`use(pattern)` with the constant pattern that the spec holds in a field: one branch per pattern of the registry.

    A pattern that is a constant is compiled once; one held in a column would be compiled for every row.
    """
    found = sorted({getattr(x, field) for x in LAYOUTS} - {NONE, ""})
    chosen = unset
    for pattern in found:
        chosen = F.when(spec[field] == pattern, use(pattern)) if chosen is None else F.when(spec[field] == pattern, use(pattern)).otherwise(chosen)
    return chosen


def _url_date(href: Column, spec: Column) -> Column:
    def read(pattern: str) -> Column:
        g = [F.regexp_extract(href, pattern, i) for i in (1, 2, 3)]
        ordered = F.when(spec["url_order"] == "mdy", F.concat_ws("-", g[2], g[0], g[1])).otherwise(F.concat_ws("-", *g))
        return F.when(href.rlike(pattern), F.try_to_date(ordered, "yyyy-MM-dd"))

    return _by_pattern(spec, "url_date", read)


def _time_date(html: Column) -> Column:
    """Date of the first <time>: its datetime attribute, else its text."""
    tag = F.regexp_extract(html, r"(?is)<time\b([^>]*)>", 1)
    stamp = attribute(F.concat(F.lit("<time"), tag, F.lit(">")), "datetime")
    inner = plain(F.regexp_extract(html, r"(?is)<time\b[^>]*>(.*?)</time", 1))
    written = F.coalesce(let(F.coalesce(stamp, F.lit("")), dates.parse_date_once), let(inner, dates.parse_date_once))
    return F.when(html.rlike(r"(?i)<time\b"), written)


def _slot_date(html: Column) -> Column:
    """Date written as month, day and year spans."""
    month, day, year = (
        F.trim(F.regexp_extract(html, rf"""(?is)<span\b[^>]*class=["'](?:[^"']*\s)?{n}(?:\s[^"']*)?["'][^>]*>([^<]*)<""", 1)) for n in ("month", "day", "year")
    )
    return let(F.concat(month, F.lit(" "), day, F.lit(", "), year), dates.parse_date_once)


def _month_of_url(href: Column) -> Column:
    year = F.regexp_extract(href, r"/(\d{4})/(\d{1,2})/", 1)
    month = F.regexp_extract(href, r"/(\d{4})/(\d{1,2})/", 2)
    first = F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lit("01")), "yyyy-MM-dd")
    return F.when(F.year(first) >= 2020, first)


def _dated(href: Column, context: Column, spec: Column) -> Column:
    """Date of a record by the chain of its layout."""
    text_date = F.when(spec["text_date"], let(plain(context), dates.parse_date_once))
    time_date = F.when(spec["time_tag"], _time_date(context))
    return F.coalesce(
        _url_date(href, spec),
        F.when(spec["slot_date"], _slot_date(context)),
        F.when(spec["text_before_time"], text_date),
        time_date,
        F.when(~spec["text_before_time"], text_date),
        F.when(spec["month_of_url"], _month_of_url(href)),
    )


def _item(title: Column, href: Column, date: Column) -> Column:
    return F.struct(title.alias("title"), href.alias("href"), date.alias("event_date"))


def block_items(html: Column, spec: Column) -> Column:
    """Records of a block layout: one per block, from its first link."""

    def behind(pattern: str, text: Column) -> Column:
        return F.slice(cut(text, pattern), 2, 1 << 30)

    def up_to(field: str, text: Column) -> Column:
        return _by_pattern(spec, field, lambda p: F.get(cut(text, p), F.lit(0)), text)

    areas = _by_pattern(spec, "outer", lambda p: F.transform(behind(p, html), lambda a: up_to("outer_end", a)), F.array(html))
    raw = F.flatten(F.transform(areas, lambda a: _by_pattern(spec, "block", lambda p: behind(p, a), F.array().cast("array<string>"))))
    blocks = F.filter(F.transform(raw, lambda b: up_to("block_end", b)), lambda b: _by_pattern(spec, "block_needs", b.rlike, F.lit(True)))

    def read(b: Column) -> Column:
        return let(_by_pattern(spec, "title_scope", lambda p: F.regexp_extract(b, p, 1), b), lambda sc: read_scope(b, sc))

    def read_scope(b: Column, scope: Column) -> Column:
        return let(F.regexp_extract(scope, r"(?is)<a\b([^>]*\bhref\b[^>]*>.*?)</a", 1), lambda tag: read_link(b, scope, tag))

    def read_link(b: Column, scope: Column, tag: Column) -> Column:
        linked = plain(F.regexp_replace(tag, r"(?s)^[^>]*>", ""))
        title = F.when((tag == "") & spec["slot_date"], F.left(plain(scope), F.lit(120))).otherwise(linked)
        has_link = (tag != "") | (spec["slot_date"] & (scope != ""))
        return F.when(has_link, let(href_of(tag), lambda h: _item(title, h, _dated(h, b, spec))))

    return F.filter(F.transform(blocks, read), lambda r: r.isNotNull() & (F.length(r["title"]) >= spec["min_title"]))


def context_items(html: Column, spec: Column) -> Column:
    """Records of a context layout: every fitting link with the date nearest to it in its item."""

    def read(a: Column) -> Column:
        marked = _by_pattern(spec, "title_tag", lambda p: F.nullif(F.regexp_extract(a["inner"], p, 1), F.lit("")), F.lit(None).cast("string"))
        title = plain(F.coalesce(marked, a["inner"]))
        around = F.concat_ws(" ", a["before"], a["inner"], a["after"])
        dated = lambda h, t: F.when(fits(h, t), let(around, lambda c: _item(t, h, _dated(h, c, spec))))
        return let(href_of(a["tag"]), lambda h: let(title, lambda t: dated(h, t)))

    def fits(href: Column, title: Column) -> Column:
        return (
            (href != "")
            & (F.length(title) >= spec["min_title"])
            & _by_pattern(spec, "href_like", href.rlike, F.lit(True))
            & ~_by_pattern(spec, "href_not", href.rlike, F.lit(False))
            & ~_by_pattern(spec, "stop_words", F.lower(title).rlike, F.lit(False))
        )

    return F.filter(F.transform(anchors(html, with_line=False), read), lambda r: r.isNotNull())


def page_listing(
    pages: DataFrame, page: str, html: str, url: str, layout: str, cutoff: str, as_of: str, fallback: bool = True
) -> DataFrame:
    """Listed records (page, title, event_date, url) of each page by its layout.

    Only plausible dates not before the cutoff count. A page whose layout yields nothing is read again
    with the generic link layout. Layouts without a site list nothing; an unknown layout fails the job.
    """
    joined = pages.select(page, F.col(html).alias("__h"), F.col(url).alias("__u"), layout_tries(F.col(layout), fallback).alias("tries"))
    item = "array<struct<title: string, event_date: date, url: string, program: string>>"

    def recent(items: Column) -> Column:
        return F.transform(
            F.filter(items, lambda r: dates.date_window_flags(r["event_date"], cutoff, as_of)[1]),
            lambda r: F.struct(
                r["title"].alias("title"), r["event_date"].alias("event_date"),
                urls.absolutize_url(r["href"], F.col("__u")).alias("url"), urls.program_id(r["href"]).alias("program"),
            ),
        )

    def unique(items: Column, by_program: Column) -> Column:
        ids = F.transform(items, lambda r: F.when(by_program, r["program"]).otherwise(r["url"]))
        return let(ids, lambda ns: F.filter(items, lambda r, i: F.get(ns, i).isNotNull() & (F.array_position(ns, F.get(ns, i)) == i + 1)))

    def attempt(found: Column, s: Column) -> Column:
        """Items of one spec, unless an earlier one found some."""
        blocks = recent(block_items(F.col("__h"), s))
        links = let(recent(context_items(F.col("__h"), s)), lambda x: unique(x, s["dedup"] == "program"))
        return F.when(F.size(found) > 0, found).when(s["kind"] == "block", blocks).otherwise(links).cast(item)

    found = F.aggregate("tries", F.array().cast(item), attempt)
    return joined.select(page, F.explode(found).alias("__r")).select(page, "__r.title", "__r.event_date", "__r.url")
