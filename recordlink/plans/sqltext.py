"""SQL fragments (DuckDB dialect) shared by the checks. Used for verification only."""

from __future__ import annotations

from recordlink import fixed_values as fv


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(items: list[str]) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


def clean_words(e: str) -> str:
    return f"list_filter(string_split_regex(regexp_replace(lower({e}), '[^a-z0-9\\s]', '', 'g'), '\\s+'), lambda w: w <> '')"


def token_set(e: str) -> str:
    return f"list_sort(list_distinct({clean_words(e)}))"


def norm_title(e: str, n: int = 8) -> str:
    for p in fv.TITLE_STRIP_PATTERNS:
        e = f"regexp_replace({e}, {q(p)}, '', 'g')"
    return f"array_to_string(list_slice({clean_words(e)}, 1, {n}), ' ')"


def significant(e: str) -> str:
    return f"list_filter({clean_words(e)}, lambda w: length(w) >= 3 AND NOT list_contains({sql_list(fv.TITLE_STOPWORDS)}, w))"


def jaccard(a: str, b: str) -> str:
    """Over two token lists without repeats."""
    inter = f"len(list_intersect({a}, {b}))"
    return (
        f"(CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 "
        f"ELSE {inter}::DOUBLE / (len({a}) + len({b}) - {inter}) END)"
    )


# Overlapping record sources derived from orders, customer and part (see bindings.records).
RECORDS = """
base AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS d,
         CASE WHEN c_nationkey < 12 THEN 'house.n' ELSE 'senate.n' END || c_nationkey AS k,
         p_name || ' ' || lower(p_type) || ' ' || p_brand AS t
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN part ON o_custkey = p_partkey
),
records AS (
  SELECT o_orderkey * 4 AS rec, k AS block_key, t AS title, d AS event_date, 2 AS authority,
         'web_url' AS source, 'https://site.example.org/' || o_orderkey AS source_value, FALSE AS has_video FROM base
  UNION ALL
  SELECT o_orderkey * 4 + 1, k, 'Full Committee Hearing: ' || t,
         CASE WHEN o_orderpriority = '1-URGENT' THEN d + 1 ELSE d END, 1,
         'video_id', 'v' || o_orderkey, TRUE FROM base WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT o_orderkey * 4 + 2,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'govinfo.' || split_part(k, '.', 1) ELSE k END,
         t || ' outlook', d, 4, 'event_id', 'e' || o_orderkey, FALSE FROM base WHERE o_orderstatus = 'F'
)"""
