"""Attach side data (clips, streams, broadcast pages, stored ids) to records by similarity.

Records and videos with equal titles in a block collapse to one row before any pairing, and every
choice of a best partner is an aggregate, so a block of copies is neither paired out nor gathered.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions import text
from recordlink.operators import matrix
from recordlink.operators.similarity import best_partner, similar_pairs
from recordlink.session import materialize


def _title_sets(df: DataFrame, block: list[str], title: str, ord_col: str, name: str, words: Callable[[Column], Column] = text.token_set) -> DataFrame:
    """One row per (block, token set) with the first row's order value, kept: a search reads it several times.

    Copies of a title are gone before its words are taken; kept, no later filter on the words moves down to the rows.
    """
    titles = df.groupBy(*block, F.col(title).alias("__title")).agg(F.min(ord_col).alias(name))
    return materialize(titles.select(*block, text.joined(words(F.col("__title"))).alias("tokens"), name).groupBy(*block, "tokens").agg(F.min(name).alias(name)))


def _best_of_titles(
    videos: DataFrame, rec_sets: DataFrame, block: list[str], video_title: str, threshold: float | None = None,
    words: Callable[[Column], Column] = text.token_set,
) -> DataFrame:
    """(block, title of a video, best, score): `best_partner` of each title, so that rows of videos never carry its words."""
    titles = materialize(videos.select(*block, F.col(video_title).alias("__title")).distinct().withColumn("tokens", text.joined(words(F.col("__title")))))
    best = best_partner(titles, rec_sets, block, "__rec", threshold, keep=("__title",))
    return best.select(*block, F.col("__title").alias(video_title), "best", "score")


def best_similar(
    records: DataFrame, videos: DataFrame, block: list[str], title: str, ord_col: str, video_title: str, video_ord: str, threshold: float
) -> DataFrame:
    """(video, record, sim), kept: for each video the most similar record of its block, first in order on a tie."""
    rec_sets = _title_sets(records, block, title, ord_col, "__rec")
    best = _best_of_titles(videos, rec_sets, block, video_title, threshold)
    vid = videos.select(*block, video_title, F.col(video_ord).alias("video"))
    return materialize(vid.join(best, [*block, video_title]).select("video", F.col("best").alias("record"), F.col("score").alias("sim")))


def attach_best_similar(
    records: DataFrame, clips: DataFrame, key: str, date: str, title: str, ord_col: str, url: str,
    clip_title: str, clip_ord: str, clip_url: str, threshold: float = fv.CLIP_SIMILARITY, clip_duration: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(records, clip list): a record without URL takes its first clip's; the list keeps every matched clip as a row.

    The list has URL, title and duration (NULL where clips have none) of the clip.
    """
    matched = best_similar(records, clips, [key, date], title, ord_col, clip_title, clip_ord, threshold)
    length = F.lit(None).cast("int") if clip_duration is None else F.col(clip_duration)
    details = clips.select(F.col(clip_ord).alias("video"), F.col(clip_url).alias("clip_url"), F.col(clip_title).alias("clip_title"), length.alias("clip_duration"))
    listed = matched.join(details, "video")
    first = listed.groupBy("record").agg(F.min_by("clip_url", "video").alias("__url"), F.count("*").alias("n_clips"))
    out = records.join(first, records[ord_col] == first["record"], "left").drop("record")
    out = out.withColumn(url, F.coalesce(F.nullif(F.col(url), F.lit("")), "__url")).withColumn(
        "n_clips", F.coalesce("n_clips", F.lit(0)).cast("bigint")
    )
    return out.drop("__url"), listed


def assign_streams(
    records: DataFrame, videos: DataFrame, date: str, title: str, ord_col: str, url: str, duration: str,
    video_title: str, video_ord: str, video_duration: str, threshold: float = fv.STREAM_SIMILARITY, long_s: int = fv.MIN_STREAM_SECONDS,
) -> DataFrame:
    """(record, video): full streams matched by date and title, each record to one stream at most.

    Streams choose in order: each takes the most similar record of its date (first in order on a tie) that has no long
    video yet and that no earlier stream has taken. Streams shorter than `long_s` take no part. A day is one group: of its
    titles with their numbers, which are compared when a stream chooses (`take_in_order`), never of pairs.
    """
    has_long = F.nullif(F.col(url), F.lit("")).isNotNull() & (F.coalesce(F.col(duration), F.lit(0)) >= long_s)

    def titles(df: DataFrame, text_col: str, number: str, name: str) -> DataFrame:
        """One row per title of a day; its words are taken once."""
        numbers = df.select(date, F.col(text_col).alias("__title"), F.col(number).cast("bigint").alias("__n")).groupBy(date, "__title").agg(F.collect_list("__n").alias(name))
        return numbers.select(date, text.joined(text.token_set(F.col("__title"))).alias("tokens"), name)

    def read(streams: pa.Table, recs: pa.Table) -> pa.Table:
        return take_in_order(streams, recs, threshold)

    streams = titles(videos.filter(F.col(video_duration) >= long_s), video_title, video_ord, "__v")
    recs = titles(records.filter(~has_long), title, ord_col, "__r")
    held = similar_pairs(streams, recs, [date], threshold, ["__v"], ["__r"], in_place=(read, "record bigint, video bigint"))
    kinds = records.schema[ord_col].dataType, videos.schema[video_ord].dataType
    return materialize(held.select(F.col("record").cast(kinds[0]), F.col("video").cast(kinds[1])))


def take_in_order(streams: pa.Table, recs: pa.Table, threshold: float) -> pa.Table:
    """(record, video) of one day, from its titles with their sets (`__ta`, `__tb`) and numbers (`__v`, `__r`).

    Of records with one token set the first one left is always taken first, so a choice is one between sets, each with its first number.
    """
    won: list[tuple[int, int]] = []
    if len(streams) and len(recs):
        asking, offered = matrix.read_sets(streams["__ta"], recs["__tb"])
        number, owner = _numbers(recs["__r"])
        code = recs["__tb"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        _, row = np.unique(code, return_index=True)  # a row of each set
        order = np.lexsort((number, code[owner]))
        number, name = number[order], code[owner][order]
        place = np.searchsorted(name, np.arange(len(row)))
        end = np.append(place[1:], len(name))
        none = np.iinfo(np.int64).max
        head = number[place]  # first record left of each set
        offered = offered.take(row)
        by_word = np.argsort(offered.word, kind="stable")
        holder, word = np.repeat(np.arange(len(row)), offered.size)[by_word], offered.word[by_word]
        used = np.zeros(len(row), bool)
        first, last = np.searchsorted(word, asking.word, "left"), np.searchsorted(word, asking.word, "right")
        number_v, owner_v = _numbers(streams["__v"])
        for at in np.argsort(number_v):
            asker = owner_v[at]
            places = range(asking.start[asker], asking.start[asker + 1])
            shared = np.bincount(np.concatenate([holder[first[p] : last[p]] for p in places]), minlength=len(row))
            sim = shared / (asking.size[asker] + offered.size - shared)
            sim[used] = -1
            level = sim.max()
            if level < threshold - 1e-12:
                continue
            among = np.flatnonzero(sim == level)
            s = among[head[among].argmin()]
            won.append((int(head[s]), int(number_v[at])))
            place[s] += 1
            used[s] = place[s] == end[s]
            head[s] = none if used[s] else number[place[s]]
    record, video = zip(*won) if won else ((), ())
    return pa.table({"record": pa.array(record, pa.int64()), "video": pa.array(video, pa.int64())})


def _numbers(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows and the row of each."""
    whole = lists.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(whole)), whole.value_lengths().to_numpy(zero_copy_only=False))


def attach_date_similar(
    records: DataFrame, videos: DataFrame, date: str, title: str, ord_col: str, url: str, duration: str,
    video_title: str, video_ord: str, video_url: str, video_duration: str,
    threshold: float = fv.STREAM_SIMILARITY, long_s: int = fv.MIN_STREAM_SECONDS,
) -> DataFrame:
    """Overwrite URL and duration of each record that a full stream is assigned to."""
    held = assign_streams(records, videos, date, title, ord_col, url, duration, video_title, video_ord, video_duration, threshold, long_s)
    v = videos.select(F.col(video_ord).alias("video"), F.struct(F.col(video_url).alias("u"), F.col(video_duration).alias("s")).alias("__v"))
    won = held.join(v, "video").select("record", "__v")
    out = records.join(won, records[ord_col] == won["record"], "left").drop("record")
    return (
        out.withColumn(url, F.coalesce(F.col("__v.u"), F.col(url)))
        .withColumn(duration, F.coalesce(F.col("__v.s"), F.col(duration)))
        .drop("__v")
    )


def two_tier_matches(records: DataFrame, videos: DataFrame, key: str, date: str, title: str, ord_col: str, video_title: str, video_ord: str) -> DataFrame:
    """(video, record), kept: candidates share key and date, or only the date when no key fits.

    The most shared significant words win, first in order on a tie, even with none shared.
    """

    def words(c: Column) -> Column:
        return F.array_sort(F.array_distinct(text.significant_words(c)))

    vids = videos.select(key, date, F.col(video_ord).alias("video"), F.col(video_title).alias("__named"))

    def choose(block: list[str], wanted: DataFrame) -> DataFrame:
        """Best record per wanted video inside a block."""
        first = records.groupBy(*block).agg(F.min(ord_col).alias("__first"))
        best = _best_of_titles(wanted, _title_sets(records, block, title, ord_col, "__rec", words), block, "__named", words=words)
        found = wanted.join(first, block).join(best, [*block, "__named"], "left")
        return found.select("video", F.coalesce("best", "__first").alias("record"))

    near = choose([key, date], vids)
    rest = vids.join(records.select(key, date).distinct(), [key, date], "left_anti")
    return materialize(near.unionByName(choose([date], rest)))


def usable_videos(videos: DataFrame, url: str, date: str) -> DataFrame:
    """Videos with a URL and a date; others are skipped."""
    return videos.filter(F.nullif(F.col(url), F.lit("")).isNotNull() & F.col(date).isNotNull())


def unmatched_videos(records: DataFrame, videos: DataFrame, date: str) -> DataFrame:
    """Usable videos that two tiers leave without a record: any record of the date takes a video, so these have none."""
    return videos.join(records.select(date).distinct(), date, "left_anti")


def attach_two_tier(
    records: DataFrame, videos: DataFrame, key: str, date: str, title: str, ord_col: str, url: str,
    video_title: str, video_ord: str, video_url: str,
) -> tuple[DataFrame, DataFrame]:
    """(records, unmatched videos): videos matched in two tiers come in order and a record keeps the first URL it gets."""
    videos = usable_videos(videos, video_url, date)
    matched = two_tier_matches(records, videos, key, date, title, ord_col, video_title, video_ord)
    urls = videos.select(F.col(video_ord).alias("video"), F.col(video_url).alias("__url"))
    first_url = matched.join(urls, "video").groupBy("record").agg(F.min_by("__url", "video").alias("__url"))
    out = records.join(first_url, records[ord_col] == first_url["record"], "left").drop("record")
    out = out.withColumn(url, F.coalesce(F.nullif(F.col(url), F.lit("")), "__url")).drop("__url")
    return out, unmatched_videos(records, videos, date)


def reconcile_ids(
    new: DataFrame, stored: DataFrame, record_id: str, key: str, date: str, title: str, event_id: str, threshold: float = fv.SAME_DAY_SIMILARITY
) -> DataFrame:
    """(old_id, new_id, rule): a stored row under another id, found by event id, else by key, date and title."""
    by_event = stored.filter(F.nullif(F.col(event_id), F.lit("")).isNotNull()).groupBy(event_id).agg(F.min(record_id).alias("old_id"))
    event_hits = (
        new.select(F.col(record_id).alias("new_id"), event_id)
        .join(by_event, event_id)
        .filter(F.col("old_id") != F.col("new_id"))
        .select("old_id", "new_id", F.lit("event_id").alias("rule"))
    )
    rest = new.join(event_hits.select(F.col("new_id").alias(record_id)), record_id, "left_anti")

    def two_least(df: DataFrame, group: list[str]) -> DataFrame:
        """(group, __o1, __o2): the two smallest ids; Spark cuts a ranking this low before it shuffles the rows."""
        low = df.withColumn("__r", F.dense_rank().over(Window.partitionBy(*group).orderBy("__id"))).filter("__r <= 2")
        return low.groupBy(*group).agg(F.min("__id").alias("__o1"), F.nullif(F.max("__id"), F.min("__id")).alias("__o2"))

    # Two smallest ids per title and per token set are enough: at most one of them can be the new id itself.
    # Words are taken of distinct titles only, so no row carries them.
    named = stored.select(key, date, F.col(title).alias("__title"), F.col(record_id).alias("__id")).filter(F.col("__id").isNotNull())
    titles = two_least(named, [key, date, "__title"])
    ids = F.explode(F.array_compact(F.array("__o1", "__o2"))).alias("__id")
    stored_sets = materialize(two_least(titles.select(key, date, text.token_set(F.col("__title")).alias("tokens"), ids), [key, date, "tokens"]))
    new_rows = rest.select(key, date, F.col(title).alias("__title"), F.col(record_id).alias("new_id"))
    new_titles = materialize(new_rows.select(key, date, "__title").distinct().withColumn("__words", text.token_set(F.col("__title"))))
    new_sets = new_titles.select(key, date, F.col("__words").alias("tokens")).distinct()
    pairs = similar_pairs(new_sets, stored_sets, [key, date], threshold, [], ["__o1", "__o2"], left_tokens="__words")
    # of all sets that a new set resembles its two smallest ids are enough too
    found = pairs.select(key, date, "__words", F.explode(F.array_compact(F.array("__o1", "__o2"))).alias("__id"))
    best = two_least(found, [key, date, "__words"])
    hits = new_rows.join(new_titles.join(best, [key, date, "__words"]).drop("__words"), [key, date, "__title"])
    old = F.when(F.col("__o1") != F.col("new_id"), F.col("__o1")).otherwise(F.col("__o2"))
    title_hits = (
        hits.withColumn("old_id", old).groupBy("new_id").agg(F.min("old_id").alias("old_id"))
        .filter(F.col("old_id").isNotNull()).select("old_id", "new_id", F.lit("title").alias("rule"))
    )
    return event_hits.unionByName(title_hits)
