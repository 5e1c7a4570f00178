"""Title and text expressions. Everything here stays inside Catalyst."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlink import fixed_values as fv


def words(text: Column) -> Column:
    """Whitespace tokens in order, without empty strings."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def clean_words(text: Column) -> Column:
    """Lower-case tokens made of a-z and 0-9 only, in order, repeats kept."""
    return words(F.regexp_replace(F.lower(text), r"[^a-z0-9\s]", ""))


def token_set(text: Column) -> Column:
    """Distinct clean tokens, sorted so that equal sets compare equal."""
    return F.array_sort(F.array_distinct(clean_words(text)))


def joined(words_: Column) -> Column:
    """A set of clean words as one text: it takes far less room in a row than an array."""
    return F.array_join(words_, " ")


def normalize_title(title: Column, n_words: int = 8, patterns: list[str] = fv.TITLE_STRIP_PATTERNS) -> Column:
    """Strip title decoration in order, then keep the first clean words."""
    stripped = reduce(lambda c, p: F.regexp_replace(c, p, ""), patterns, title)
    return F.array_join(F.slice(clean_words(stripped), 1, n_words), " ")


def record_id(key: Column, date: Column, title: Column, length: int = 12) -> Column:
    """Stable id: leading hex digits of SHA-256 over `key:date:normalized title`."""
    raw = F.concat_ws(":", key, F.date_format(date, "yyyy-MM-dd"), normalize_title(title))
    return F.substring(F.sha2(raw, 256), 1, length)


def slug(key: Column, title: Column, max_len: int = 80) -> Column:
    """`group-name-title` with every other character run turned into one dash."""
    safe = F.left(F.regexp_replace(F.lower(title), r"[^a-z0-9]+", "-"), F.lit(max_len))
    safe = F.regexp_replace(safe, r"^-+|-+$", "")
    tail = F.regexp_replace(F.regexp_extract(key, r"^[^.]*\.(.*)$", 1), "_", "-")
    name = F.when(key.contains("."), tail).otherwise(F.lit("unknown"))
    return F.concat_ws("-", F.split_part(key, F.lit("."), F.lit(1)), name, safe)


def token_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of the clean token sets of two texts; 0 when one is empty."""
    return set_jaccard(token_set(a), token_set(b))


def set_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two token arrays without repeats."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(common / union)


def significant_words(text: Column, stop: list[str] = fv.TITLE_STOPWORDS, min_len: int = 3) -> Column:
    """Clean tokens of at least `min_len` characters that are not stop words; order and repeats kept."""
    return F.filter(clean_words(text), lambda w: (F.length(w) >= min_len) & ~w.isin(stop))


def keyword_overlap(a: Column, b: Column, stop: list[str] = fv.TITLE_STOPWORDS, min_len: int = 3) -> Column:
    """How many distinct significant words two texts share."""
    return F.size(F.array_intersect(significant_words(a, stop, min_len), significant_words(b, stop, min_len)))


def search_keywords(title: Column, stop: list[str] = fv.TITLE_STOPWORDS, max_words: int = 5) -> Column:
    """The first significant words of a title as one search string."""
    return F.array_join(F.slice(significant_words(title, stop), 1, max_words), " ")


def search_query(keywords: Column, group_name: Column, date: Column, site: str, site_path: str) -> Column:
    """Search string of site, group name, keywords and year; the group name stands in for missing keywords."""
    name = F.nullif(group_name, F.lit(""))
    terms = F.coalesce(F.nullif(keywords, F.lit("")), name)
    head = F.when(name.isNotNull(), F.concat_ws(" ", F.lit(site), name)).otherwise(F.lit(site_path))
    return F.when(terms.isNotNull(), F.concat_ws(" ", head, terms, F.year(date).cast("string")))


def sentence_case(text: Column, keep: list[str] = fv.ABBREVIATIONS, ratio: float = 0.6) -> Column:
    """Recase text that is mostly capitals; listed abbreviations stay as written."""
    trailing = ".,;:!?'\""
    kept = sorted({k.rstrip(trailing) for k in keep})
    upper_share = F.length(F.regexp_replace(text, r"[^\p{Lu}]", "")) / F.greatest(F.length(text), F.lit(1))
    pieces = F.split(F.regexp_replace(text, r"([.!?]\s+)", "\u0001$1\u0001"), "\u0001")

    def recase(word: Column, position: Column) -> Column:
        is_kept = F.rtrim(F.upper(word), F.lit(trailing)).isin(kept)
        first = F.concat(F.upper(F.left(word, F.lit(1))), F.lower(F.substring(word, 2, 1 << 30)))
        return F.when(is_kept, word).when(position == 0, first).otherwise(F.lower(word))

    def piece(p: Column) -> Column:
        boundary = p.rlike(r"^[.!?]\s+$")
        return F.when(boundary, p).otherwise(F.array_join(F.transform(words(p), recase), " "))

    return F.when(upper_share < ratio, text).otherwise(F.array_join(F.transform(pieces, piece), ""))


def strip_markup(text: Column) -> Column:
    """Delete tags, squeeze blanks, trim."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"<[^>]+>", ""), r"\s{2,}", " "))


def contains_any(text: Column, phrases: list[str]) -> Column:
    """True when the lower-case text contains one of the phrases (one compiled alternation)."""
    import re

    return F.lower(text).rlike("|".join(re.escape(p) for p in phrases))


def starts_with_any(text: Column, prefixes: list[str]) -> Column:
    """True when the lower-case text starts with one of the prefixes."""
    import re

    return F.lower(text).rlike("^(?:" + "|".join(re.escape(p) for p in prefixes) + ")")


def safe_filename(url: Column, suffix: str = ".pdf") -> Column:
    """Last URL segment with a required suffix and only safe characters."""
    name = F.element_at(F.split(url, "/"), -1)
    named = F.when(name.endswith(suffix), name).otherwise(F.concat(name, F.lit(suffix)))
    return F.regexp_replace(named, r"[^A-Za-z0-9._-]", "_")


def duration_label(seconds: Column) -> Column:
    """`12m05s`; missing counts as zero."""
    total = F.coalesce(seconds.cast("bigint"), F.lit(0).cast("bigint"))
    return F.format_string("%dm%02ds", F.floor(total / 60), total % 60)


def coalesce_priority(candidates: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """First non-empty candidate and the label of the one that won."""
    present = [(label, F.nullif(F.trim(c), F.lit("")).isNotNull(), c) for label, c in candidates]
    value, label = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, ok, c in reversed(present):
        value = F.when(ok, c).otherwise(value)
        label = F.when(ok, F.lit(name)).otherwise(label)
    return value, label
