"""Ordered scans that survive a hot key.

A plain window partitioned by a key puts all rows of that key into one task. Here every key is cut
into segments of its order column (an hour, a range of positions). Rows are windowed inside
(key, segment); one small row per (key, segment), the last of the segment, carries the state from one
segment to the next. The result equals the unsegmented window for every segment width.
Key and segment columns must not be NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions import text

SEG = "__seg"


def time_segment(ts: str | Column, width: str = "1 hour") -> Column:
    """Segment number of a timestamp: fixed-width slices of time."""
    unit = {"minute": 60, "hour": 3600, "day": 86400}
    n, name = width.split()
    seconds = int(n) * unit[name.rstrip("s")]
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_timestamp(c.cast("timestamp")) / seconds).cast("bigint")


def position_segment(position: str | Column, width: int = 65536) -> Column:
    """Segment number of an integer position."""
    c = F.col(position) if isinstance(position, str) else position
    return F.floor(c / width).cast("bigint")


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    segment: Column,
    sums: dict[str, Column] | None = None,
    lags: dict[str, Column] | None = None,
    marks: dict[str, Column] | None = None,
    levels: int | None = None,
) -> DataFrame:
    """Add running values per key in ascending order.

    sums:  inclusive running sum of an expression;
    lags:  value of the previous row (may be NULL);
    marks: position (1, 2, ...) of the last row up to here that meets a condition; also adds `pos`.
    Expressions may use columns of `df` only. `order` must be unique within a key. The carried rows come from the same
    exchange as the windows if nothing but the order and the expressions is used of the rows; else they read these few
    columns a second time. `levels` is how many times segments are themselves cut into groups of `FAN` before one window
    goes over what is left of a key: none with keys, one without.
    """
    sums, lags, marks = sums or {}, lags or {}, marks or {}
    levels = (0 if keys else 1) if levels is None else levels
    d = df.withColumn(SEG, segment)
    local = Window.partitionBy(*keys, SEG).orderBy(*order)
    run = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.row_number().over(local)
    inner = d.select(
        "*",
        *[F.sum(e).over(run).alias(f"__s_{n}") for n, e in sums.items()],
        *[F.lag(F.struct(e.alias("v")), 1).over(local).alias(f"__g_{n}") for n, e in lags.items()],
        *[F.struct(e.alias("v")).alias(f"__v_{n}") for n, e in lags.items()],
        *([place.cast("bigint").alias("__pos")] if marks else []),
        F.lead(F.lit(1), 1).over(local).isNull().alias("__end"),
    )
    if marks:
        inner = inner.select("*", *[F.max(F.when(c, F.col("__pos"))).over(run).alias(f"__m_{n}") for n, c in marks.items()])
    # The last row of a segment holds the segment's totals; these few rows travel on alone.
    totals = [*[f"__s_{n}" for n in sums], *[f"__v_{n}" for n in lags], *(["__pos"] if marks else []), *[f"__m_{n}" for n in marks]]
    ends = inner.filter("__end").select(*keys, SEG, *totals)
    carry = _carried(ends, keys, SEG, list(sums), list(lags), list(marks), levels).drop(*totals)
    joined = inner.join(carry, [*keys, SEG], "left")
    return joined.select(
        *df.columns,
        *[(F.coalesce(F.col(f"__s_{n}"), F.lit(0)) + F.coalesce(F.col(f"__cs_{n}"), F.lit(0))).alias(n) for n in sums],
        *[F.coalesce(f"__g_{n}", f"__cg_{n}").getField("v").alias(n) for n in lags],
        *([(F.col("__pos") + F.col("__base")).alias("pos")] if marks else []),
        *[F.coalesce(F.col(f"__m_{n}") + F.col("__base"), F.col(f"__cm_{n}")).alias(n) for n in marks],
    )


FAN = 4096  # segments of one group on the next level


def _carried(ends: DataFrame, keys: list[str], seg: str, sums: list[str], lags: list[str], marks: list[str], levels: int) -> DataFrame:
    """Segment rows with what lies before them in their key: `__cs_` sums, `__cg_` last values, `__base` rows, `__cm_` marks.

    With levels left, this is settled inside groups of `FAN` segments first; each group's last row carries its totals up.
    """
    up = f"{seg}_up"
    # without keys the few rows of the last level are one group: pmod(x, 1) is 0 for all
    grouped = ends.withColumn(up, F.floor(F.col(seg) / FAN).cast("bigint") if levels else F.pmod(F.col(seg), F.lit(1)))
    group = [*keys, up]
    across = Window.partitionBy(*group).orderBy(seg)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    if marks:
        grouped = grouped.withColumn("__base", F.coalesce(F.sum("__pos").over(before), F.lit(0)))
    inside = grouped.select(
        "*",
        *[F.sum(f"__s_{n}").over(before).alias(f"__cs_{n}") for n in sums],
        *[F.lag(f"__v_{n}", 1).over(across).alias(f"__cg_{n}") for n in lags],
        *[F.max(F.col("__base") + F.col(f"__m_{n}")).over(before).alias(f"__cm_{n}") for n in marks],
        F.lead(F.lit(1), 1).over(across).isNull().alias("__top"),
    )
    if not levels:
        return inside.drop(up, "__top")
    tops = inside.filter("__top").select(
        *group,
        *[(F.coalesce(f"__cs_{n}", F.lit(0)) + F.coalesce(f"__s_{n}", F.lit(0))).alias(f"__s_{n}") for n in sums],
        *[f"__v_{n}" for n in lags],
        *([(F.col("__base") + F.col("__pos")).alias("__pos")] if marks else []),
        *[F.coalesce(F.col("__base") + F.col(f"__m_{n}"), f"__cm_{n}").alias(f"__m_{n}") for n in marks],
    )
    above = _carried(tops, keys, up, sums, lags, marks, levels - 1)
    above = above.select(
        *group,
        *[F.col(f"__cs_{n}").alias(f"__us_{n}") for n in sums], *[F.col(f"__cg_{n}").alias(f"__ug_{n}") for n in lags],
        *([F.col("__base").alias("__ubase")] if marks else []), *[F.col(f"__cm_{n}").alias(f"__um_{n}") for n in marks],
    )
    both = inside.join(above, group, "left")
    mine = {f"__cs_{n}": F.coalesce(f"__cs_{n}", F.lit(0)) + F.coalesce(f"__us_{n}", F.lit(0)) for n in sums}
    mine |= {f"__cg_{n}": F.coalesce(f"__cg_{n}", f"__ug_{n}") for n in lags}
    mine |= {f"__cm_{n}": F.coalesce(F.col("__ubase") + F.col(f"__cm_{n}"), f"__um_{n}") for n in marks}
    mine |= {"__base": F.col("__base") + F.col("__ubase")} if marks else {}
    return both.withColumns(mine).select(*[c for c in inside.columns if c not in (up, "__top")])


def number_changes(
    df: DataFrame, keys: list[str], order: list[str], segment: Column, value: Column,
    starts: Callable[[Column, Column], Column], name: str, flag: str = "__new",
) -> DataFrame:
    """Number the groups of each key: `name` counts the rows up to here at which a group starts.

    `starts(previous, current)` decides from the previous row (struct with field v, NULL at the start of a
    key) and the current value. Whether a segment opens with a start is settled among the segment ends, so
    lag and running count need one pass.
    """
    d = df.withColumn(SEG, segment).withColumn("__v", value)
    local = Window.partitionBy(*keys, SEG).orderBy(*order)
    run = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = d.select(
        "*",
        F.lag(F.struct(F.col("__v").alias("v")), 1).over(local).alias("__p"),
        F.first(F.struct(F.col("__v").alias("v"))).over(run).alias("__first"),
        F.lead(F.lit(1), 1).over(local).isNull().alias("__end"),
    )
    inside = F.when(F.col("__p").isNull(), F.lit(False)).otherwise(starts(F.col("__p"), F.col("__v")))
    inner = marked.withColumn("__f", inside.cast("bigint"))
    inner = inner.withColumn("__n", F.sum("__f").over(run))
    across = Window.partitionBy(*keys).orderBy(SEG) if keys else Window.orderBy(SEG)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    ends = inner.filter("__end").select(
        *keys, SEG, "__n", "__first", F.lag(F.struct(F.col("__v").alias("v")), 1).over(across).alias("__last")
    )
    ends = ends.withColumn("__open", starts(F.col("__last"), F.col("__first.v")).cast("bigint"))
    carry = ends.select(
        *keys, SEG, "__open", (F.coalesce(F.sum(F.col("__n") + F.col("__open")).over(before), F.lit(0)) + F.col("__open")).alias("__base")
    )
    joined = inner.join(carry, [*keys, SEG], "left")
    new = F.when(F.col("__p").isNull(), F.col("__open")).otherwise(F.col("__f"))
    return joined.select(*df.columns, (F.col("__n") + F.col("__base")).alias(name), (new == 1).alias(flag))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key: an aggregate with map-side combine, not a window over the key."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("__r")
    return df.groupBy(*keys).agg(first).select(*keys, "__r.*").select(*df.columns)


def collapse_repeats(df: DataFrame, doc: str, body: str) -> DataFrame:
    """Lines of a caption text without headers, time lines, tags and adjacent repeats.

    Works inside the row (a line array and its own shifted copy), so nothing is shuffled.
    """
    raw = F.filter(
        F.split(body, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"),
        lambda x: ~(x.rlike(r"^(?:WEBVTT|Kind:|Language:)") | x.contains("-->")),
    )
    clean = F.filter(
        F.transform(raw, lambda x: F.trim(F.regexp_replace(x, r"<[^>]+>", ""))), lambda x: x != ""
    )
    staged = df.select(doc, clean.alias("__lines"))
    kept = F.filter(F.col("__lines"), lambda x, i: (i == 0) | (x != F.get(F.col("__lines"), i - F.lit(1))))
    return staged.select(doc, kept.alias("lines"))


def gap_paragraphs(df: DataFrame, keys: list[str], ts: str, tie: str, segment: Column, gap_s: float = fv.GAP_SECONDS) -> DataFrame:
    """Number the paragraphs of each key: a new one starts after a pause longer than the gap."""
    seconds = F.col(ts).cast("timestamp").cast("double")
    later = lambda previous, now: previous.isNotNull() & (now - previous["v"] > gap_s)
    return number_changes(df, keys, [ts, tie], segment, seconds, later, "paragraph").drop("__new")


def speaker_turns(df: DataFrame, doc: str, seq: str, speaker: str, body: str, width: int = 4096) -> DataFrame:
    """Number speaker turns and give each part the header its turn starts with.

    A blank or `>>` speaker is no speaker; a change from a name to no name starts a `[SPEAKER]` turn.
    Lines in (doc, seq) order make up the transcript.
    """
    named = F.trim(F.coalesce(F.col(speaker), F.lit("")))
    parts = df.filter(F.trim(F.coalesce(F.col(body), F.lit(""))) != "").withColumn(
        "__who", F.when((named != "") & (named != ">>"), named)
    )
    tidy = F.trim(F.regexp_replace(F.regexp_replace(text.sentence_case(F.trim(body)), r"\n+", " "), r"\s{2,}", " "))
    changed = lambda previous, now: ~now.eqNullSafe(previous["v"])
    out = number_changes(parts, [doc], [seq], position_segment(seq, width), F.col("__who"), changed, "turn_no")
    header = F.when(F.col("__new"), F.coalesce("__who", F.lit("[SPEAKER]")))
    return out.select(doc, seq, "turn_no", header.alias("header"), tidy.alias("line"))


def failure_streak(
    df: DataFrame, keys: list[str], ts: str, tie: str, ok: Column, count: Column, width: str = "1 hour"
) -> DataFrame:
    """Per key: consecutive failures since the last success, last success, last failure, last good count.

    Rows are reduced per (key, time slice) first. Slices after the one with the last success count whole;
    only the failures inside that slice are compared row by row, so a hot key is never in one place.
    """
    events = df.select(
        *keys, time_segment(ts, width).alias(SEG), F.col(ts).alias("__ts"), F.col(tie).alias("__tie"), ok.alias("__ok"), count.alias("__n")
    )
    position = F.struct("__ts", "__tie")
    slices = events.groupBy(*keys, SEG).agg(
        F.max(F.when(F.col("__ok"), F.struct("__ts", "__tie", F.col("__n").alias("n")))).alias("__last"),
        F.max(F.when(~F.col("__ok"), F.col("__ts"))).alias("__bad"),
        F.count_if(~F.col("__ok")).alias("__fails"),
    )
    state = slices.groupBy(*keys).agg(
        F.max("__last").alias("__last"), F.max("__bad").alias("last_failure"), F.max(F.when(F.col("__last").isNotNull(), F.col(SEG))).alias("__seg_ok")
    )
    whole = (
        slices.join(state.select(*keys, "__seg_ok"), keys)
        .filter(F.col("__seg_ok").isNull() | (F.col(SEG) > F.col("__seg_ok")))
        .select(*keys, F.col("__fails").alias("__c"))
    )
    edge = state.filter("__seg_ok IS NOT NULL").select(*keys, F.col("__seg_ok").alias(SEG), "__last.__ts", "__last.__tie")
    edge = edge.select(*keys, SEG, position.alias("__after"))
    inside = (
        events.filter(~F.col("__ok")).join(edge, [*keys, SEG]).filter(position > F.col("__after")).groupBy(*keys).agg(F.count("*").alias("__c"))
    )
    streaks = whole.unionByName(inside).groupBy(*keys).agg(F.sum("__c").alias("streak"))
    return state.join(streaks, keys, "left").select(
        *keys,
        F.coalesce("streak", F.lit(0)).cast("bigint").alias("streak"),
        F.col("__last.__ts").alias("last_success"),
        "last_failure",
        F.col("__last.n").alias("last_count"),
    )


def budget_cutoff(df: DataFrame, order: str, cost: str, cap: float, width: int = 65536, scale: int = 6) -> DataFrame:
    """Rows processed while the cost of all earlier rows stays under the cap."""
    exact = F.coalesce(F.col(cost), F.lit(0)).cast(f"decimal(38,{scale})")
    run = ordered_scan(df.withColumn("__c", exact), [], [order], position_segment(order, width), sums={"__run": F.col("__c")})
    spent = F.col("__run") - F.col("__c")
    return run.withColumn("spent_before", spent).filter(F.col("spent_before") < F.lit(cap)).drop("__c", "__run")


def stop_after_empty(
    df: DataFrame, keys: list[str], order: list[str], segment: Column, found: Column, links: Column, n: int = 4
) -> DataFrame:
    """Cut each queue at the first row that is at least the n-th empty result in a row on a page without links."""
    d = df.withColumn("__hit", found).withColumn("__blank", links == 0)
    run = ordered_scan(d, keys, order, segment, marks={"__hit_pos": F.col("__hit")})
    flagged = run.withColumn("empty_streak", F.col("pos") - F.coalesce("__hit_pos", F.lit(0)))
    stop = flagged.groupBy(*keys).agg(
        F.min(F.when((F.col("empty_streak") >= n) & F.col("__blank"), F.col("pos"))).alias("__stop")
    )
    kept = flagged.join(stop, keys).filter(F.col("__stop").isNull() | (F.col("pos") <= F.col("__stop")))
    return kept.drop("__hit", "__blank", "__hit_pos", "__stop")


def next_stage(stage: Column, stages: list[str] = fv.STAGES) -> Column:
    """The stage after the given one; NULL at the end and for an unknown stage."""
    array = F.array(*[F.lit(s) for s in stages])
    place = F.array_position(array, stage)
    return F.when(place > 0, F.get(array, place.cast("int")))
