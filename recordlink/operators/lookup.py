"""Exact, fragment and identity joins. Join strategies are left to Catalyst and AQE size checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink.functions import dates, keys, text
from recordlink.operators.rank import staleness


def code_lookup(
    items: DataFrame, item_id: str, codes: str, dim: DataFrame, dim_code: str, dim_key: str, allowed: DataFrame | None = None
) -> DataFrame:
    """Key of the first code (in array order) that is known exactly or by its parent code; exact beats parent.

    With `allowed` (one column: the key) items whose key is not allowed are dropped.
    """
    exploded = items.select(item_id, F.posexplode(codes).alias("__pos", "__code")).filter("__code <> ''")
    probes = exploded.select(
        item_id, "__pos",
        F.inline(F.array(
            F.struct(F.lit(0).alias("__level"), F.col("__code").alias("__probe")),
            F.struct(F.lit(1).alias("__level"), keys.parent_code(F.col("__code")).alias("__probe")),
        )),
    )
    # of the keys of one code only the least can win, so a code that many rows hold is met once
    known = dim.groupBy(F.col(dim_code).alias("__probe")).agg(F.min(dim_key).alias("key"))
    hits = probes.join(known, "__probe")
    best = hits.groupBy(item_id).agg(
        F.min_by(F.struct("key", F.col("__probe").alias("matched_code")), F.struct("__pos", "__level", "key")).alias("__b")
    )
    out = best.select(item_id, "__b.key", "__b.matched_code").filter("key IS NOT NULL")
    return out.join(allowed.select(F.col(allowed.columns[0]).alias("key")).distinct(), "key", "left_semi").select(*out.columns) if allowed is not None else out


def fragment_match(
    items: DataFrame, item_id: str, title: str, group: str, dim: DataFrame, fragment: str, key: str, fallback: str = keys.FALLBACK_PREFIX
) -> DataFrame:
    """Key of the longest dimension fragment contained in a title.

    Search text, in order: the text after `COMMITTEE ON` without an article, with it, the whole title.
    Equal titles of a group are looked up once. The pairs come from an equi-join on the first three characters of the
    fragment against the distinct three-character pieces of the text, so no title meets a fragment it cannot contain.
    """
    kind = F.coalesce(F.col(group), F.lit("")).alias("__group")
    upper = F.upper("__title")
    pattern = r"COMMITTEE\s+ON\s+(.+?)(?:\s*[-—,]\s*(?:UNITED\s+STATES|U\.S\.)|$)"
    named = F.trim(F.regexp_extract(upper, pattern, 1))
    search = F.when(upper.rlike(pattern), named).otherwise(upper)
    bare = F.regexp_replace(search, r"(?i)^THE\s+", "")
    texts = F.array_distinct(F.array(bare, search, upper))
    titles = items.select(kind, F.col(title).alias("__title")).filter("__title <> ''").distinct()
    lowered = titles.select("__group", "__title", F.posexplode(texts).alias("__pos", "__t")).withColumn("__t", F.lower("__t"))
    starts = F.when(F.length("__t") > 0, F.sequence(F.lit(1), F.length("__t"))).otherwise(F.array().cast("array<int>"))

    def pieces(n: int) -> Column:
        return F.transform(starts, lambda i: F.substr(F.col("__t"), i, F.lit(n)))

    grams = F.array_distinct(F.flatten(F.array(pieces(1), pieces(2), pieces(3))))
    fragments = dim.select(F.lower(F.trim(fragment)).alias("__f"), F.col(key).alias("key")).filter("__f <> ''")
    fragments = fragments.withColumn("__gram", F.left("__f", F.lit(3)))
    probes = lowered.withColumn("__gram", F.explode(grams))
    in_group = F.col("__group").isin("", "unknown") | F.col("key").startswith(F.concat("__group", F.lit(".")))
    # A left join, kept by the coalesce: of the two sides only the dimension may be gathered, as the pieces are many times their texts.
    hits = probes.join(fragments, "__gram", "left").filter(F.coalesce(in_group & F.col("__t").contains(F.col("__f")), F.lit(False)))
    rank = F.struct("__pos", (-F.length("__f")).alias("__len"), "__f", "key")
    of_title = hits.groupBy("__group", "__title").agg(F.min(rank).alias("__rank"))
    best = (
        items.select(item_id, kind, F.col(title).alias("__title")).join(of_title, ["__group", "__title"])
        .groupBy(item_id).agg(F.min("__rank").alias("__rank")).select(item_id, F.col("__rank.key").alias("matched_key"))
    )
    spare = F.concat(F.lit(fallback + "."), F.coalesce(F.nullif(F.col(group), F.lit("")), F.lit("unknown")))
    return items.join(best, item_id, "left").withColumn("key", F.coalesce("matched_key", spare))


def dim_default_join(df: DataFrame, key: str, dim: DataFrame, dim_key: str, name: str) -> DataFrame:
    """Add the name of a key; an unknown key names itself."""
    names = dim.select(F.col(dim_key).alias(key), F.col(name).alias("__name"))
    return df.join(names, key, "left").withColumn("block_name", F.coalesce("__name", key)).drop("__name")


def attach_by_id(records: DataFrame, found: DataFrame, record_id: str, value: str) -> DataFrame:
    """Overwrite a value with the one looked up for the id (the last found one wins, here the greatest)."""
    new = found.groupBy(record_id).agg(F.max(value).alias("__new"))
    return records.join(new, record_id, "left").withColumn(value, F.coalesce("__new", value)).drop("__new")


def rekey_children(child: DataFrame, mapping: DataFrame, id_col: str, key_cols: list[str]) -> DataFrame:
    """Move child rows from old to new ids; a row the new id already has stays, moved copies of it go."""
    moves = mapping.select(F.col("old_id").alias(id_col), "new_id")
    moved = child.join(moves, id_col, "left").withColumn("__moved", F.col("new_id").isNotNull().cast("int"))
    moved = moved.withColumn("__from", F.col(id_col)).withColumn(id_col, F.coalesce("new_id", id_col)).drop("new_id")
    rest = [c for c in child.columns if c not in (id_col, *key_cols)]
    best = moved.groupBy(id_col, *key_cols).agg(
        F.min_by(F.struct(*rest), F.struct("__moved", "__from")).alias("__r")
    )
    return best.select(id_col, *key_cols, "__r.*").select(*child.columns)


def rotation_queue(keys_df: DataFrame, searches: DataFrame, key: str, searched_at: str, as_of: str, max_age: int, cap: int) -> DataFrame:
    """Keys never searched, then stale keys oldest first; at most `cap`."""
    last = searches.groupBy(key).agg(F.max(searched_at).alias("last_searched"))
    aged = staleness(keys_df.select(key).distinct().join(last, key, "left"), "last_searched", as_of, max_age)
    due = aged.filter(F.col("last_searched").isNull() | F.col("is_stale"))
    return due.orderBy(F.col("last_searched").asc_nulls_first(), key).limit(cap).select(key, "last_searched", "age_days")


def skip_done(df: DataFrame, done: DataFrame, key: str, order: list[str], cap: int) -> DataFrame:
    """Rows whose id was not handled yet, first `cap` in order."""
    return df.join(done.select(key).distinct(), key, "left_anti").orderBy(*order).limit(cap)


def duplicate_backfill(df: DataFrame, keys_: list[str], record_id: str, event_id: str, sources: str) -> DataFrame:
    """Within a group of several rows, rows without an event id lose to the first row that has one.

    Output: one row per loser with its winner, and the winner's source map after taking in the losers'
    entries (a loser overrides). Groups are reduced to one winner before the losers are joined to it,
    and maps are merged entry by entry, so no group is gathered in one row.
    """
    event = F.nullif(F.col(event_id), F.lit(""))
    winners = df.groupBy(*keys_).agg(
        F.count("*").alias("__n"), F.min_by(F.col(record_id), F.when(event.isNotNull(), F.col(record_id))).alias("winner")
    ).filter((F.col("__n") > 1) & F.col("winner").isNotNull())
    losers = df.filter(event.isNull()).join(winners, keys_).select(
        "winner", F.col(record_id).alias("loser"), F.col(sources).alias("__m")
    )
    own = df.join(winners.select(F.col("winner").alias(record_id)), record_id, "left_semi").select(
        F.col(record_id).alias("winner"), F.lit(None).cast(df.schema[record_id].dataType).alias("loser"), F.col(sources).alias("__m")
    )
    entries = losers.unionByName(own).select("winner", "loser", F.explode("__m").alias("k", "v"))
    merged = entries.groupBy("winner", "k").agg(
        F.max_by("v", F.struct(F.col("loser").isNotNull().alias("is_loser"), "loser")).alias("v")
    )
    maps = merged.groupBy("winner").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("merged_sources"))
    return losers.select("winner", "loser").join(maps, "winner")
