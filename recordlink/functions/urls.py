"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlink import fixed_values as fv


def _fold_dots(url: Column) -> Column:
    """Resolve `.` and `..` steps of the path, however many; query and fragment stay as they are."""
    origin = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    tail = F.regexp_extract(url, r"[?#].*$", 0)
    path = F.regexp_replace(F.substr(url, F.length(origin) + 1), r"[?#].*$", "")

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.array_append(done, part))

    parts = F.split(path, "/")
    folded = F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), F.array(F.lit("")), step)
    closed = F.when(path.rlike(r"/\.\.?$"), F.array_append(folded, F.lit(""))).otherwise(folded)
    return F.concat(origin, F.array_join(closed, "/"), tail)


def absolutize_url(href: Column, base: Column) -> Column:
    """Absolute form of a link; '' for empty, fragment, script and mail links."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)//", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(page == origin, F.concat(origin, F.lit("/"))).otherwise(F.regexp_replace(page, r"[^/]*$", ""))
    joined = F.concat(folder, href)
    relative = F.when(href.rlike(r"(?:^|/)\.\.?/"), _fold_dots(joined)).otherwise(joined)
    return (
        F.when(href.isNull() | (href == "") | href.rlike(r"^(?:#|javascript:|mailto:)"), F.lit(""))
        .when(href.startswith("http"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(page, href))
        .otherwise(relative)
    )


def url_dedup_key(url: Column) -> Column:
    """Equal for URLs that differ only in trailing slashes."""
    return F.regexp_replace(url, r"/+$", "")


def is_document_href(href: Column) -> Column:
    """True when a link looks like a PDF-like document."""
    low = F.lower(F.coalesce(href, F.lit("")))
    return (
        low.endswith(".pdf")
        | low.contains("format=pdf")
        | low.contains("/download/")
        | low.contains("/services/files/")
        | low.contains("files.serve")
    )


def _extract_or_null(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def embed_id(html: Column) -> Column:
    """Video id (11 characters) of the first embedded player in an iframe."""
    frames = F.regexp_extract_all(html, F.lit(r"(?i)<iframe[^>]+src=[\"']([^\"']*)[\"']"), 1)
    ids = F.filter(F.transform(frames, lambda s: F.regexp_extract(s, fv.EMBED_ID_PATTERN, 1)), lambda s: s != "")
    return F.get(ids, F.lit(0))


def program_id(url: Column) -> Column:
    """Numeric program or event id of a broadcast URL."""
    return _extract_or_null(url, fv.PROGRAM_ID_PATTERN)


def query_param(url: Column, name: str) -> Column:
    """First value of a query parameter, percent-decoded; NULL when absent or empty. `&amp;` in HTML counts as `&`."""
    return F.try_url_decode(_extract_or_null(url, rf"[?&](?:amp;)?{name}=([^&#]*)"))


def player_params(html: Column) -> tuple[Column, Column]:
    """(comm, filename) of the first stream player iframe; both NULL unless both are there."""
    src = F.regexp_extract(html, fv.PLAYER_IFRAME_PATTERN, 1)
    comm, name = query_param(src, "comm"), query_param(src, "filename")
    both = comm.isNotNull() & name.isNotNull()
    return F.when(both, comm), F.when(both, name)
