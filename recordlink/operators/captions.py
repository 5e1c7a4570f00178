"""Caption files and rolling screens."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recordlink import fixed_values as fv
from recordlink.functions import text
from recordlink.functions.bind import let
from recordlink.operators.ordered import SEG, gap_paragraphs
from recordlink.session import store


def _seconds(stamp: Column) -> Column:
    """`HH:MM:SS.mmm` as seconds."""
    part = [F.regexp_extract(stamp, r"^(\d{2}):(\d{2}):(\d{2})\.(\d{3})$", i).cast("int") for i in (1, 2, 3, 4)]
    return part[0] * 3600 + part[1] * 60 + part[2] + part[3] / 1000.0


def parse_cues(df: DataFrame, keep: list[str], body: str) -> DataFrame:
    """Cue rows (seq, start_s, end_s, text) of caption texts; `keep` names the columns to carry.

    A cue is a time line and the lines after it up to a blank or the next time line. The text is cut at
    its time lines inside the row, so a file is never spread over a shuffle.
    """
    line = r"(?m)^[ \t]*(?=\d{2}:\d{2}:\d{2}\.\d{3}\s*-->\s*\d{2}:\d{2}:\d{2}\.\d{3})"
    unified = F.regexp_replace(F.col(body), r"\r\n?", "\n")
    blocks = F.filter(
        F.split(F.regexp_replace(unified, line, "\u0001"), "\u0001"), lambda b: b.rlike(fv.CUE_TIME_PATTERN)
    )

    def cue(block: Column) -> Column:
        lines = F.transform(F.split(block, "\n"), lambda x: F.trim(x))
        rest = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
        blank = F.array_position(rest, "")
        kept = F.when(blank > 0, F.slice(rest, F.lit(1), (blank - 1).cast("int"))).otherwise(rest)
        return F.struct(
            _seconds(F.regexp_extract(block, fv.CUE_TIME_PATTERN, 1)).alias("start_s"),
            _seconds(F.regexp_extract(block, fv.CUE_TIME_PATTERN, 2)).alias("end_s"),
            F.trim(F.array_join(kept, " ")).alias("text"),
        )

    cues = F.filter(F.transform(blocks, cue), lambda c: c["text"] != "")
    return df.select(*keep, F.posexplode(cues).alias("seq", "__c")).select(*keep, "seq", "__c.*")


def overlap_length(previous: Column, current: Column) -> Column:
    """Longest suffix of the previous words that is a prefix of the current words.

    At most one position may hold a partial word (one word starting with the other).
    """
    n, m = F.size(previous), F.least(F.size(previous), F.size(current))

    def differs(a: Column, b: Column) -> Column:
        return F.when(a == b, 0).when(a.startswith(b) | b.startswith(a), 1).otherwise(2)

    def fits(k: Column) -> Column:
        # With at most one word different, one of the two end words agrees; most lengths fail this test.
        apart = (F.get(previous, n - k) != F.get(current, F.lit(0))) & (F.get(previous, n - 1) != F.get(current, k - 1))
        pairs = F.zip_with(F.slice(previous, n - k + 1, k), F.slice(current, F.lit(1), k), differs)
        return F.when((k > 1) & apart, F.lit(False)).otherwise(F.aggregate(pairs, F.lit(0), lambda s, x: s + x) <= 1)

    lengths = F.when(m > 0, F.sequence(F.lit(1), m)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.array_max(F.filter(lengths, fits)), F.lit(0))


def _cue_segment(width_s: float) -> Column:
    return F.floor(F.col("end_s") / width_s).cast("bigint")


def _overlap(previous: list[bytes], current: list[bytes]) -> int:
    """`overlap_length` of two lists of words."""
    n = len(previous)
    for k in range(min(n, len(current)), 0, -1):
        # with at most one word different, one of the two end words agrees
        if k > 1 and previous[n - k] != current[0] and previous[-1] != current[k - 1]:
            continue
        a, b = previous[n - k :], current[:k]
        if a == b:
            return k
        apart = [(x, y) for x, y in zip(a, b) if x != y]
        if len(apart) == 1 and (apart[0][0].startswith(apart[0][1]) or apart[0][1].startswith(apart[0][0])):
            return k
    return 0


SETTLED, FIRST, OPEN, LAST = range(4)  # kinds of rows of `_segment_fragments`


def _segment_fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """New words of sorted screens (doc, segment, end, start, seq, text), compared inside their segment only.

    Out come the fragments that differ from the one before (SETTLED); and of each segment, what other segments decide on: its
    first screen (FIRST, whole text), its first fragment behind that (OPEN), its last text and fragment (LAST).
    """
    here = text = words = last = None  # of the row before: segment, text, its words, last fragment of the segment
    for batch in batches:
        at, kinds, news, texts = [], [], [], []
        ends = []  # (doc, segment, last fragment, last text)
        segments = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        for i, (segment, now) in enumerate(zip(segments, batch.column(5).to_pylist())):
            current = now.split() if now is not None else None  # of bytes: the blanks of `text.words`
            if segment != here:
                if here is not None:
                    ends.append((*here, last, text))
                at.append(i), kinds.append(FIRST), news.append(None), texts.append(now)
                here, last = segment, None
            elif now is not None and now != text:
                new = now.strip(b" ") if text is None else b" ".join(current[_overlap(words, current) :])
                if new and new != last:
                    at.append(i), kinds.append(OPEN if last is None else SETTLED), news.append(new), texts.append(None)
                    last = new
            text, words = now, current
        yield _fragment_rows(batch.take(pa.array(at, pa.int64())), kinds, news, texts)
        yield _end_rows(batch.schema, ends)
    if here is not None:
        yield _end_rows(batch.schema, [(*here, last, text)])


def _fragment_rows(rows: pa.RecordBatch, kinds: list[int], news: list, texts: list) -> pa.RecordBatch:
    columns = [*rows.columns[:5], pa.array(kinds, pa.int32()), pa.array(news, pa.binary()), pa.array(texts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, [*rows.schema.names[:5], "kind", "new", "whole"])


def _end_rows(schema: pa.Schema, ends: list[tuple]) -> pa.RecordBatch:
    doc, segment, new, whole = zip(*ends) if ends else ((), (), (), ())
    columns = [pa.array(doc, schema.types[0]), pa.array(segment, schema.types[1]), *[pa.nulls(len(ends), t) for t in schema.types[2:5]]]
    return _fragment_rows(pa.RecordBatch.from_arrays(columns, schema.names[:5]), [LAST] * len(ends), list(new), list(whole))


def rolling_diff(cues: DataFrame, doc: str, width_s: float = 600.0) -> DataFrame:
    """New words of each caption screen, in (end, start, seq) order: (doc, end_s, start_s, seq, new_text).

    Equal screens in a row count once, screens that add nothing are dropped, and so are equal fragments
    in a row. Screens are exchanged once and scanned inside (document, segment); what a segment's first screen adds and
    whether its first fragment repeats is settled among one row per segment.
    """
    order = ["end_s", "start_s", "seq"]
    rows = cues.select(doc, _cue_segment(width_s).alias(SEG), *order, F.col("text").cast("binary").alias("text"))
    scanned = rows.repartition(doc, SEG).sortWithinPartitions(doc, SEG, *order).mapInArrow(
        _segment_fragments, StructType([*rows.schema.fields[:5], *StructType.fromDDL("kind int, new binary, whole binary").fields])
    )
    found = scanned.withColumns({"new": F.col("new").cast("string"), "whole": F.col("whole").cast("string")})
    parts = store(found.withColumnRenamed("new", "new_text"), "fragments")

    def of(kind: int, *columns: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.struct(*columns)))

    edges = parts.filter(F.col("kind") != SETTLED).groupBy(doc, SEG).agg(
        of(FIRST, *order, "whole").alias("first"), of(OPEN, *order, "new_text").alias("open"), of(LAST, "whole", "new_text").alias("last")
    )
    across = Window.partitionBy(doc).orderBy(SEG)
    text_before = F.lag("last.whole").over(across)
    shown = edges.withColumn("__prev", text_before).withColumn(
        "__w", F.struct(text.words(F.coalesce("__prev", F.lit(""))).alias("a"), text.words(F.col("first.whole")).alias("b"))
    )
    rest = let(overlap_length(F.col("__w.a"), F.col("__w.b")), lambda k: F.array_join(F.slice("__w.b", k + 1, F.greatest(F.size("__w.b") - k, F.lit(0))), " "))
    fresh = F.when(F.col("__prev").isNull(), F.trim("first.whole")).when(F.col("first.whole") != F.col("__prev"), rest)
    opened = shown.withColumn("__new", F.nullif(fresh, F.lit("")))
    latest = F.last(F.coalesce("last.new_text", "__new"), ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1))
    settled = opened.withColumn("__before", latest)
    both = F.array(
        F.struct(*[f"first.{c}" for c in order], F.col("__new").alias("new_text"), F.col("__before").alias("old")),
        F.struct(*[f"open.{c}" for c in order], "open.new_text", F.coalesce("__new", "__before").alias("old")),
    )
    kept = F.filter(both, lambda x: x["new_text"].isNotNull() & ~x["new_text"].eqNullSafe(x["old"]))
    names = [doc, *order, "new_text"]
    return parts.filter(F.col("kind") == SETTLED).select(*names).unionByName(settled.select(doc, F.inline(kept)).select(*names))


def caption_paragraphs(cues: DataFrame, doc: str, gap_s: float = fv.GAP_SECONDS, width_s: float = 600.0) -> DataFrame:
    """Fragments of `rolling_diff` with their paragraph number (a pause longer than the gap starts a new one)."""
    parts = rolling_diff(cues, doc, width_s)
    timed = parts.withColumn("__ts", F.timestamp_millis((F.col("end_s") * 1000).cast("bigint")))
    return gap_paragraphs(timed, [doc], "__ts", "seq", _cue_segment(width_s), gap_s).drop("__ts")


