"""Chunks of long texts and the answers given for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions import text
from recordlink.functions.bind import let
from recordlink.functions.cost import estimate_tokens


STEP = 256


def prefix_sums(sizes: Column) -> Column:
    """0 and the running sums of an array. Summed in slices of `STEP`, so that no step copies more than a slice."""

    def running(xs: Column, start: Column) -> Column:
        return F.aggregate(xs, F.array(start), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))

    zero = F.lit(0).cast("bigint")
    firsts = F.sequence(F.lit(1), F.greatest(F.size(sizes), F.lit(1)), F.lit(STEP))
    slices = F.transform(firsts, lambda at: running(F.slice(sizes, at, F.lit(STEP)), zero))

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.element_at(p, -1))
        return let(running(totals, zero), lambda base: F.flatten(F.transform(parts, lambda p, i: F.transform(F.slice(p, F.lit(2), F.lit(STEP)), lambda x: x + F.get(base, i)))))

    return F.concat(F.array(zero), let(slices, joined))


def first_at_least(prefix: Column, value: Column) -> Column:
    """Number of values of an ascending array below `value`, by halving."""
    halves = F.array(*[F.lit(1 << i) for i in range(24, -1, -1)])

    def step(at: Column, half: Column) -> Column:
        return F.when((at + half <= F.size(prefix)) & (F.get(prefix, at + half - 1) < value), at + half).otherwise(at)

    return F.aggregate(halves, F.lit(0), step)


def chunk_bounds(sizes: Column, size: int, overlap: int) -> Column:
    """Array of (s, e): paragraphs s..e-1 of each chunk, from the token size of every paragraph.

    A paragraph that would exceed the limit closes the chunk; the next one starts with the longest tail
    of whole paragraphs within the overlap. A single oversize paragraph stays whole. One step per chunk: where a chunk
    ends and where the next one starts are found by halving in the running sums.
    """
    state = "struct<b:array<struct<s:int,e:int>>,start:int,at:int>"
    first = F.struct(F.array().cast("array<struct<s:int,e:int>>").alias("b"), F.lit(0).alias("start"), F.lit(0).alias("at")).cast(state)

    def walk(prefix: Column) -> Column:
        n = F.size(prefix) - 1

        def step(acc: Column, _: Column) -> Column:
            start = acc["start"]
            # the first paragraph that exceeds the limit, behind the one that closed the chunk before
            over = first_at_least(prefix, F.get(prefix, start) + size + 1) - 1
            end = F.least(n, F.greatest(acc["at"] + 1, over))

            def closed(i: Column) -> Column:
                tail = first_at_least(prefix, F.get(prefix, i) - overlap)
                grown = F.array_append(acc["b"], F.struct(start.alias("s"), i.alias("e")).cast("struct<s:int,e:int>"))
                return F.struct(grown.alias("b"), F.greatest(start, tail).alias("start"), i.alias("at")).cast(state)

            return F.when(acc["at"] < n, let(end, closed)).otherwise(acc)

        return F.aggregate(F.sequence(F.lit(1), n), first, step)["b"]

    return let(prefix_sums(sizes), walk)


def chunk_paragraphs(
    df: DataFrame, keep: list[str], body: str, size: int = fv.CHUNK_TOKENS, overlap: int = fv.OVERLAP_TOKENS, sep: str = "\n\n"
) -> DataFrame:
    """Chunk rows (chunk_no, chunk) of each text on paragraph boundaries. One row stays one task's work; no shuffle."""
    staged = df.select(*keep, F.split(body, sep).alias("__p"))
    sizes = F.transform("__p", lambda p: F.floor(F.length(p) / 4).cast("bigint"))
    bounds = staged.select(*keep, "__p", F.posexplode(chunk_bounds(sizes, size, overlap)).alias("chunk_no", "__b"))
    part = F.slice("__p", F.col("__b.s") + 1, F.col("__b.e") - F.col("__b.s"))
    return bounds.select(*keep, F.col("chunk_no").cast("bigint").alias("chunk_no"), F.array_join(part, sep).alias("chunk"))


def chunk_requests(
    df: DataFrame, doc: str, body: str, title: str, group: str, size: int = fv.CHUNK_TOKENS, overlap: int = fv.OVERLAP_TOKENS,
    sep: str = "\n\n", default: str = "Recorded session", template: str = "{context}{note}\n\n{chunk}",
) -> DataFrame:
    """Batch requests: short texts whole, longer ones in chunks with `chunk k of n` notes."""
    short = estimate_tokens(F.col(body)) <= size
    staged = df.select(doc, title, group, F.split(body, sep).alias("__p"), short.alias("__short"), F.col(body).alias("__t"))
    sizes = F.transform("__p", lambda p: F.floor(F.length(p) / 4).cast("bigint"))
    one = F.array(F.struct(F.lit(0).alias("s"), F.size("__p").alias("e")).cast("struct<s:int,e:int>"))
    bounds = F.when(F.col("__short"), one).otherwise(chunk_bounds(sizes, size, overlap))
    rows = staged.withColumn("__bs", bounds).withColumn("n_chunks", F.size("__bs").cast("bigint"))
    rows = rows.select(doc, title, group, "__p", "n_chunks", F.posexplode("__bs").alias("chunk_no", "__b"))
    chunk = F.array_join(F.slice("__p", F.col("__b.s") + 1, F.col("__b.e") - F.col("__b.s")), sep)
    named = F.array_join(F.array_compact(F.array(
        F.when(F.coalesce(F.col(title), F.lit("")) != "", F.concat(F.lit("Title: "), title)),
        F.when(F.coalesce(F.col(group), F.lit("")) != "", F.concat(F.lit("Group: "), group)),
    )), "\n")
    context = F.when(named == "", F.lit(default)).otherwise(named)
    note = F.when(F.col("n_chunks") > 1, F.format_string("\n\nNote: This is chunk %d of %d.", F.col("chunk_no") + 1, "n_chunks")).otherwise("")
    before, rest = template.split("{context}")
    middle, rest = rest.split("{note}")
    inner, after = rest.split("{chunk}")
    request = F.concat(F.lit(before), context, F.lit(middle), note, F.lit(inner), chunk, F.lit(after))
    return rows.select(doc, F.col("chunk_no").cast("bigint").alias("chunk_no"), "n_chunks", request.alias("request"))


def chunk_rollup(df: DataFrame, doc: str, chunk_no: str, body: str, in_tokens: str, out_tokens: str) -> DataFrame:
    """Cleaned chunks back to one text per document, with summed tokens.

    The gathered chunks of a document are one text, the size of the document row they came from.
    """
    ordered = F.array_sort(F.collect_list(F.struct(chunk_no, body)))
    return df.groupBy(doc).agg(
        F.array_join(F.transform(ordered, lambda x: x[body]), "\n\n").alias("text"),
        F.sum(in_tokens).alias("input_tokens"),
        F.sum(out_tokens).alias("output_tokens"),
        F.count("*").alias("chunks_processed"),
    )


def parse_json_answer(df: DataFrame, keep: list[str], raw: str, fields: list[str], required: str, defaults: dict[str, str]) -> DataFrame:
    """Rows of a JSON array of objects; code fences are stripped, anything else gives no rows."""
    bare = F.regexp_replace(F.trim(raw), r"^```(?:json)?\s*", "")
    bare = F.trim(F.regexp_replace(F.trim(bare), r"\s*```$", ""))
    items = F.when(bare.startswith("["), F.from_json(bare, "array<string>"))
    schema = ", ".join(f"{f} string" for f in fields)
    exploded = df.select(*keep, F.posexplode(items).alias("item_no", "__j")).filter(F.col("__j").startswith("{"))
    parsed = exploded.withColumn("__o", F.from_json("__j", schema))
    parsed = parsed.filter(F.coalesce(F.col(f"__o.{required}"), F.lit("")) != "")
    return parsed.select(
        *keep, F.col("item_no").cast("bigint").alias("item_no"),
        *[F.coalesce(F.col(f"__o.{f}"), F.lit(defaults[f])).alias(f) if f in defaults else F.col(f"__o.{f}").alias(f) for f in fields],
    )


def quote_extract(answers: DataFrame, records: DataFrame, record_id: str, raw: str, urls: list[tuple[str, Column]]) -> DataFrame:
    """Quote rows with the attributes of their record and its best source URL."""
    quotes = parse_json_answer(answers, [record_id], raw, ["quote", "speaker", "context"], "quote", {"speaker": "Unknown", "context": ""})
    url, _ = text.coalesce_priority(urls)
    return quotes.join(records.withColumn("source_url", F.coalesce(url, F.lit(""))), record_id)
