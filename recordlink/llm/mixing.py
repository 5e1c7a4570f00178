"""Mixing sources to target weights: Poisson replication.

The repetition rate of a source is target rows of the source / rows of the source. Each document draws its number of
copies by inverting the Poisson distribution of that rate at a uniform number that is a hash of seed and id; it is
exploded by the count, and all copies are dealt and ordered by a hash of (seed, id, copy), a global shuffle: the order
is the same on every run with the same number of shuffle partitions, and `order_key` sorts the copies on any cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 16.0
SALTS = 16


def hash_number(*parts: Column) -> Column:
    """First 52 bits of an MD5, as a number: the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def _invert(rate: Column, u: Column) -> Column:
    """Smallest k with CDF(k) >= u for a rate of at most PIECE."""
    start = F.struct(F.lit(0).alias("k"), F.exp(-rate).alias("p"), F.exp(-rate).alias("c"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        more = F.struct(k.alias("k"), p.alias("p"), (s["c"] + p).alias("c"))
        return F.when(u > s["c"], more).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(80)), start, step)["k"]


def poisson_count(rate: Column, seed: int, key: Column) -> Column:
    """A hash-seeded Poisson number. Rates over PIECE are drawn as sums of equal parts, so that exp() never underflows."""
    parts = F.greatest(F.lit(1), F.ceil(rate / PIECE)).cast("int")
    numbers = F.transform(
        F.sequence(F.lit(1), parts),
        lambda i: _invert(rate / parts, (hash_number(F.lit(str(seed)), key, i.cast("string")) + 0.5) / float(1 << 52)),
    )
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def source_rates(docs: DataFrame, weights: dict[str, float] | None, power: float, total: int | None) -> DataFrame:
    """(source, rate) over all rows. A null source is a source of its own, '' in `weights` stands for it."""
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(power))
    else:
        named = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.create_map().cast("map<string,double>")
        share = F.coalesce(F.try_element_at(named, F.col("source")).cast("double"), F.lit(0.0))
    shares = counts.withColumn("share", share)
    sums = shares.agg(F.sum("share").alias("shares"), F.sum("n").alias("rows")).first()  # two numbers
    wanted = float(total if total is not None else sums["rows"] or 0)
    scale = wanted / sums["shares"] if sums["shares"] else 0.0
    return shares.select("source", (F.lit(scale) * F.col("share") / F.col("n")).alias("rate"))


def mix_sources(
    docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, total: int | None = None, seed: int = 17
) -> DataFrame:
    """`docs` with each row repeated by its Poisson count, plus `copy` (from 0), `copies` and `order_key`.

    `weights` gives the target weight of each source (others get none); without it, weights are n ** power of the row
    counts, which flattens the mixture. `total` is the expected number of rows out, as many as came in by default.

    Defined cases: a null source is one source; a null id hashes as empty text; rows that repeat an id repeat the same
    draw; null, empty and long texts are passed on as they are; columns named like the added ones are replaced; an empty table gives an empty result.
    """
    rates = source_rates(docs, weights, power, total).withColumnRenamed("source", "__source")
    salted = rates.select("__source", F.col("rate").alias("__rate"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.drop("copy", "copies", "order_key").withColumns(
        {"__source": F.coalesce("source", F.lit("")), "__salt": F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")}
    )
    counted = rows.join(salted, ["__source", "__salt"]).withColumn("copies", poisson_count(F.col("__rate"), seed, key)).filter("copies > 0")
    exploded = counted.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    ordered = exploded.withColumn("order_key", hash_number(F.lit(f"order{seed}"), key, F.col("copy").cast("string")))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ordered.drop("__source", "__salt", "__rate").repartition(width, "order_key")
    return dealt.sortWithinPartitions("order_key", "doc_id", "copy")
