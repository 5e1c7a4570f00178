"""Links, documents and text of HTML pages. A page is cut up inside its row; nothing is shuffled."""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions import text, urls
from recordlink.functions.bind import cut, let

# End of one item of a page and start of the next one.
ITEM_END = r"(?is)</(?:div|li|tr|article|section|table|ul|nav)\s*>"
# Any border of a block element: what lies between two borders is the line a link stands in.
BLOCK_EDGE = r"(?i)</?(?:div|li|tr|td|p|article|section|table|ul|ol|nav|h[1-6]|body)\b[^>]*>"


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute (quoted or not) in the text of a tag, as written; NULL when it is not there."""
    raw = F.regexp_extract(tag, rf"""(?is)^[^>]*?(?<![\w-]){name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return let(raw, lambda v: F.when(v != "", F.regexp_replace(v, r"""^["']|["']$""", "")))


def undecoded(html: Column) -> Column:
    """Text of a fragment with its entities as written, enough to look for words."""
    return F.regexp_replace(html, r"(?s)<[^>]*>", " ")


def plain(html: Column) -> Column:
    """Visible text of a fragment: tags become blanks, entities are decoded, blanks are squeezed."""
    return F.trim(F.regexp_replace(decode_entities(undecoded(html)), r"\s+", " "))


# Named characters by the rule of the HTML standard library tables; a non-breaking blank reads as a blank.
NAMED = {f"{name};": chr(code) for name, code in name2codepoint.items()} | {"apos;": "'", "nbsp;": " "}
# Names that an attribute value may also hold without a semicolon.
BARE = {name: " " if name == "nbsp" else char for name, char in html5.items() if not name.endswith(";")}
NUMERIC = r"#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?"
IN_TEXT = rf"^({NUMERIC}|[A-Za-z][A-Za-z0-9]*;)"
# A bare name before `=`, a letter or a digit is part of a query string, not a reference.
IN_ATTRIBUTE = rf"^({NUMERIC}|[A-Za-z][A-Za-z0-9]*;|[A-Za-z][A-Za-z0-9]*(?![=A-Za-z0-9;]))"


def _character(code: Column) -> Column:
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    number = F.when(~valid, 0xFFFD).when(code == 160, 32).otherwise(code)
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def _decode(c: Column, reference: str, names: dict[str, str]) -> Column:
    # one literal instead of a node per name: the plan stays small
    table = F.str_to_map(F.lit("\x01".join(f"{name}\x02{char}" for name, char in names.items())), F.lit("\x01"), F.lit("\x02"))

    def value_of(name: Column) -> Column:
        digits = F.rtrim(name, F.lit(";"))
        hexadecimal = F.conv(F.substr(digits, F.lit(3)), 16, 10).try_cast("bigint")
        code = F.when(name.rlike("^#[xX]"), hexadecimal).otherwise(F.substr(digits, F.lit(2)).try_cast("bigint"))
        return F.when(name.startswith("#"), let(code, _character)).otherwise(F.try_element_at(table, name))

    def one(piece: Column) -> Column:
        def after(ref: Column) -> Column:
            return F.concat(value_of(ref), F.substr(piece, F.length(ref) + 1))

        return F.coalesce(let(F.regexp_extract(piece, reference, 1), after), F.concat(F.lit("&"), piece))

    def decoded(pieces: Column) -> Column:
        rest = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), one)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))

    return let(c, lambda v: F.when(F.contains(v, F.lit("&")), let(F.split(v, "&"), decoded)).otherwise(v))


def decode_entities(c: Column) -> Column:
    """Character references of a text, each decoded once: numeric ones and names with a semicolon; others stay."""
    return _decode(c, IN_TEXT, NAMED)


def decode_attribute(c: Column) -> Column:
    """Character references of an attribute value: as in a text, and bare names that no `=`, letter or digit follows."""
    return _decode(c, IN_ATTRIBUTE, NAMED | BARE)


def href_of(tag: Column) -> Column:
    """Decoded link target of a tag, '' when it has none."""
    return decode_attribute(F.coalesce(attribute(tag, "href"), F.lit("")))


def anchors(html: Column, with_line: bool = True) -> Column:
    """Array of all anchors in page order: tag text, inner HTML, HTML before and after within the same item, line.

    `before` starts after the last item end behind the previous anchor, `after` stops at the next item end,
    `line` is everything between the block borders around the anchor; without `with_line` it is left out.
    """
    pieces = cut(html, r"(?i)<a\b")

    def parts(p: Column) -> Column:
        def closed(close: Column) -> Column:
            inner = F.when(close > 0, F.substr(p, F.lit(1), close - 1)).otherwise(p)
            rest = F.when(close > 0, F.regexp_replace(F.substr(p, close), r"(?i)^</a\s*>", "")).otherwise("")
            return F.struct(p.alias("all"), inner.alias("tag"), rest.alias("rest"))

        return let(F.regexp_instr(p, F.lit(r"(?i)</a\s*>")), closed)

    def build(ps: Column, around: Column | None) -> Column:
        def one(p: Column, i: Column) -> Column:
            previous = F.when(i == 1, F.get(ps, F.lit(0))["all"]).otherwise(F.get(ps, i - 1)["rest"])
            return F.struct(
                p["tag"].alias("tag"),
                F.regexp_replace(p["tag"], r"(?s)^[^>]*>", "").alias("inner"),
                F.element_at(cut(previous, ITEM_END), -1).alias("before"),
                F.get(cut(p["rest"], ITEM_END), F.lit(0)).alias("after"),
                *([] if around is None else [F.get(around, i - 1).alias("line")]),
            )

        return F.slice(F.transform(ps, one), F.lit(2), F.greatest(F.size(ps) - 1, F.lit(0)))

    taken = F.transform(pieces, parts)
    if not with_line:
        return let(taken, lambda ps: build(ps, None))
    lines = F.flatten(F.transform(cut(html, BLOCK_EDGE), lambda r: F.array_repeat(r, F.size(cut(r, r"(?i)<a\b")) - 1)))
    return let(taken, lambda ps: let(lines, lambda around: build(ps, around)))


def links(html: Column, base: Column) -> Column:
    """Anchors with a usable link, first per absolute URL: pos, href, abs_url, text, tag, before, after."""

    def described(a: Column) -> Column:
        def with_href(href: Column) -> Column:
            return F.struct(
                href.alias("href"), urls.absolutize_url(href, base).alias("abs_url"), plain(a["inner"]).alias("text"),
                a["tag"].alias("tag"), a["inner"].alias("inner"), a["before"].alias("before"), a["line"].alias("line"),
            )

        return let(href_of(a["tag"]), with_href)

    usable = F.filter(F.transform(anchors(html), described), lambda x: x["abs_url"] != "")

    def first_only(xs: Column) -> Column:
        names = F.transform(xs, lambda x: x["abs_url"])
        return let(names, lambda ns: F.filter(xs, lambda x, i: F.array_position(ns, x["abs_url"]) == i + 1))

    return let(usable, first_only)


def page_links(pages: DataFrame, page: str, html: str, url: str) -> DataFrame:
    """Link rows (page, pos, href, abs_url, text) of each page, first per absolute URL."""
    rows = pages.select(page, F.posexplode(links(F.col(html), F.col(url))).alias("pos", "__l"))
    return rows.select(page, F.col("pos").cast("bigint").alias("pos"), "__l.href", "__l.abs_url", "__l.text")


# ---------------------------------------------------------------- link rules


def has_testimony_signal(link: Column) -> Column:
    """Testimony words in the link text, its title or aria-label, or in the line around it."""
    pieces = [link["text"], attribute(link["tag"], "title"), attribute(link["tag"], "aria-label"), undecoded(link["line"])]
    return F.concat_ws(" | ", *pieces).rlike(fv.TESTIMONY_PATTERN)


def is_excluded(link: Column) -> Column:
    return link["text"].rlike(fv.LINK_EXCLUDE_PATTERN) | link["href"].rlike(fv.LINK_EXCLUDE_PATTERN)


def _file_like(href: Column) -> Column:
    return F.regexp_replace(href, r"\?.*$", "").rlike(fv.FILE_EXT_PATTERN)


def _drupal(link: Column) -> Column:
    h = link["href"]
    stored = h.contains("/download/") | h.contains("/services/files/")
    return urls.is_document_href(h) | (has_testimony_signal(link) & (stored | _file_like(h)))


def _wordpress(link: Column) -> Column:
    h = link["href"]
    return h.rlike(fv.WP_UPLOAD_PATTERN) | urls.is_document_href(h) | (has_testimony_signal(link) & _file_like(h))


def _coldfusion(link: Column) -> Column:
    h = F.lower(link["href"])
    return h.contains("files.serve") | urls.is_document_href(link["href"]) | (has_testimony_signal(link) & h.contains("file_id="))


def _aspnet(link: Column) -> Column:
    h = link["href"]
    trusted = h.contains("docs.house.gov") | has_testimony_signal(link) | h.rlike(fv.HOUSE_DOC_PATH_PATTERN)
    return urls.is_document_href(h) & trusted


def _house(link: Column) -> Column:
    return _aspnet(link) | (link["href"].contains("docs.house.gov") & has_testimony_signal(link))


# Rule per page layout; a layout not listed takes any testimony-signalled document. Open for new entries.
link_rule_registry = {
    "drupal_table": _drupal,
    "new_senate_cms": _drupal,
    "drupal_links": _drupal,
    "wordpress_blog": _wordpress,
    "wordpress_elementor": _wordpress,
    "coldfusion_table": _coldfusion,
    "evo_framework": _house,
    "aspnet_card": _aspnet,
}


def link_accept(layout: Column, link: Column) -> Column:
    """Is the link a document by the rule of its layout and not excluded? One CASE over the rules."""
    by_rule: dict = {}
    for name, rule in link_rule_registry.items():
        by_rule.setdefault(rule, []).append(name)
    accepted = F.lit(False)
    for rule, names in by_rule.items():
        accepted = F.when(layout.isin(*names), rule(link)).otherwise(accepted)
    return accepted & ~is_excluded(link)


WP_CONTAINER = (
    r"(?i)<div\b[^>]*class=[\"'][^\"']*(?:entry-content|post-content|et_pb_text|elementor-widget-text|"
    r"jet-listing-dynamic|page-content|article-body)"
)


def page_documents(pages: DataFrame, page: str, html: str, url: str, layout: str, group: str | None = None) -> DataFrame:
    """Document links of each page, the first embedded video and the stream parameters.

    Fallback chain: links accepted by the layout rule, else testimony-signalled documents, else all documents.
    """
    # WordPress pages are searched from their first content container on, where there is one.
    start = F.regexp_instr(F.col(html), F.lit(WP_CONTAINER))
    scoped = F.when(F.col(layout).isin("wordpress_blog", "wordpress_elementor") & (start > 0), F.substr(html, start)).otherwise(F.col(html))
    comm, name = urls.player_params(F.col(html))
    allowed = F.lit(True) if group is None else F.col(group) == "senate"
    staged = pages.select(
        page, F.col(layout).alias("__layout"), links(scoped, F.col(url)).alias("__scoped"), links(F.col(html), F.col(url)).alias("__links"),
        urls.embed_id(F.col(html)).alias("embed_id"), F.when(allowed, comm).alias("stream_comm"), F.when(allowed, name).alias("stream_file"),
    )
    inside = r"(?i)(?:class|id)\s*=\s*[\"'][^\"']*(?:" + fv.TESTIMONY_PATTERN.removeprefix("(?i)") + ")"
    documents = F.filter("__links", lambda x: urls.is_document_href(x["href"]) & ~is_excluded(x))
    signalled = F.filter(documents, lambda x: has_testimony_signal(x) | x["before"].rlike(inside))
    accepted = F.filter("__scoped", lambda x: link_accept(F.col("__layout"), x))

    def unique(xs: Column) -> Column:
        names = F.transform(xs, lambda x: urls.url_dedup_key(x["abs_url"]))
        kept = let(names, lambda ns: F.filter(xs, lambda x, i: F.array_position(ns, F.get(ns, i)) == i + 1))
        return F.transform(kept, lambda x: x["abs_url"])

    chosen = F.when(F.size(accepted) > 0, unique(accepted)).when(F.size(signalled) > 0, unique(signalled)).otherwise(unique(documents))
    return staged.select(page, chosen.alias("pdf_urls"), "embed_id", "stream_comm", "stream_file")


# ---------------------------------------------------------------- page text


def html_to_text(html: Column) -> Column:
    """Text of a page: every tag ends a line; scripts, styles and comments go; entities are decoded.

    `&amp` counts with and without its semicolon, as a cut title ends in it.
    """
    body = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(?:script|style)\s*>|<!--.*?-->", "")
    closed = F.regexp_replace(F.regexp_replace(body, r"(?s)<[^>]+>", "\n"), "&amp;?", "&amp;")
    lines = decode_entities(closed)
    return F.regexp_replace(F.regexp_replace(lines, r"[ \t]*\n\s*", "\n"), r"^\s+|\s+$", "")


def artifact_text_stats(df: DataFrame, url: str, body: str) -> DataFrame:
    """Extracted documents that are not blank, with a safe file name and their length."""
    kept = df.filter(F.col(body).rlike(r"\S"))
    return kept.withColumn("file_name", text.safe_filename(F.col(url))).withColumn("chars", F.length(body).cast("bigint"))
