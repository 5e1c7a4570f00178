"""Set-similarity joins inside blocks, without pairing out a block.

Blocks of at most `IN_PLACE` times `DIRECT` rows on each side are compared in one task as matrices (`matrix.py`), of which only the
wanted pairs come out. Larger blocks get a dictionary of their own: how often each (block, token) occurs on the right. Two sets with Jaccard >= t
share a token among the first n - ceil(t*n) + 1 tokens of each, for any common token order; with tokens ordered by the
dictionary, rare first, only those prefix tokens are joined. A token with many right rows is cut into parts sized from
its count. `similar_pairs` gives all pairs above a threshold, `best_partner` the best one of each left set. Both are
exact.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from recordlink.functions import text
from recordlink.operators import matrix
from recordlink.session import materialize

DIRECT = 256  # the most right rows of a rare token
IN_PLACE = 16  # times so many rows of a side make a block that is compared in place
GROUP = 16384  # rows of such blocks that a task reads at once
PART = 4096  # right rows of a frequent token that one key of the join holds


def _prefix_length(tokens: Column, threshold: float) -> Column:
    n = F.size(tokens)
    return F.greatest((n - F.ceil(n * threshold - 1e-9) + 1).cast("int"), F.lit(1))


def _mask(tokens: str) -> Column:
    """One of 64 bits for each token."""
    return F.aggregate(tokens, F.lit(0).cast("bigint"), lambda m, t: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(t), F.lit(64)).cast("int"))))


def _may_share(needed: Column) -> Column:
    """Can `__ta` and `__tb` share so many tokens? Each bit that the other set has not stands for a token that is not shared."""
    a_only, b_only = (F.bit_count(F.col(x).bitwiseAND(F.bitwise_not(F.col(y)))) for x, y in (("__ma", "__mb"), ("__mb", "__ma")))
    return (F.size("__ta") - a_only >= needed) & (F.size("__tb") - b_only >= needed)


def large_blocks(a: DataFrame, b: DataFrame, block: list[str]) -> tuple[DataFrame | None, int]:
    """Blocks that are too large to be compared in place on a side, or None; and the number of groups for the others."""
    side = [df.select(*block, F.lit(n).alias("__s")) for n, df in enumerate((a, b))]
    counts = side[0].unionByName(side[1]).groupBy(*block).agg(F.count_if(F.col("__s") == 0).alias("__a"), F.count_if(F.col("__s") == 1).alias("__b"))
    counts = counts.filter((F.col("__a") > 0) & (F.col("__b") > 0)).withColumn("__large", F.greatest("__a", "__b") > IN_PLACE * DIRECT)
    rows, large = counts.agg(F.sum(F.col("__a") + F.col("__b")), F.max("__large")).first()
    return materialize(counts.filter("__large").select(*block)) if large else None, -(-(rows or 1) // GROUP)


def token_counts(right: DataFrame, block: list[str], tokens: str) -> DataFrame:
    """The dictionary: (block, __tok, __c), in how many right rows of the block a token is."""
    return right.select(*block, F.explode(tokens).alias("__tok")).groupBy(*block, "__tok").agg(F.count("*").alias("__c"))


def _ranked(side: DataFrame, block: list[str], tokens: str, counts: DataFrame) -> DataFrame:
    """Rows with `__k`: (count, token) of each token by the dictionary, rare first. Rows must differ."""
    listed = side.withColumn("__tok", F.explode(tokens)).join(counts, [*block, "__tok"], "left")
    pair = F.struct(F.coalesce("__c", F.lit(0)).alias("c"), F.col("__tok").alias("t"))
    return listed.groupBy(*side.columns).agg(F.array_sort(F.collect_list(pair)).alias("__k"))


def _by_size(side: DataFrame, large: DataFrame | None, block: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows of small and of large blocks."""
    return (side, None) if large is None else (side.join(large, block, "left_anti"), side.join(large, block, "left_semi"))


def _cogrouped(a: DataFrame, b: DataFrame, by: list[str], read: Callable[[pa.Table, pa.Table], pa.Table], schema: StructType | str) -> DataFrame:
    other = {c: f"__b_{c}" for c in by}  # both sides may be made of one table
    return a.groupBy(*by).cogroup(b.withColumnsRenamed(other).groupBy(*other.values())).applyInArrow(read, schema)


def _in_place(
    a: DataFrame, b: DataFrame, block: list[str], groups: int, choose: Callable[[matrix.Sets, matrix.Sets], tuple[np.ndarray, ...]],
    from_a: list[str], from_b: list[str], value: str, order: str | None = None,
) -> DataFrame:
    """Rows (from_a, from_b, value) that `choose` names in each block: places on both sides and a number.

    A group holds the blocks of one hash, as a group of its own costs more than a small block. Right rows come by `order`.
    """
    b = b.withColumns({c: F.col(c).cast(a.schema[c].dataType) for c in block})
    a, b = (side.withColumn("__g", F.pmod(F.xxhash64(*block), F.lit(groups)).cast("int")) for side in (a, b))
    b = b.withColumnsRenamed({c: f"__b_{c}" for c in block})
    names = [*from_a, *from_b, value]
    types = [*(a.schema[c].dataType for c in from_a), *(b.schema[c].dataType for c in from_b), DoubleType()]

    def read(x: pa.Table, y: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(x) and len(y):
            code = np.zeros(len(x) + len(y), np.int64)
            for c in block:
                both = pa.chunked_array([*x[c].chunks, *y[f"__b_{c}"].chunks]).combine_chunks().dictionary_encode()
                code = np.unique(code * len(both.dictionary) + both.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
            p, q = matrix.read_sets(x["__ta"], y["__tb"])
            by_a = np.argsort(code[: len(x)], kind="stable")
            by_b = np.argsort(code[len(x) :], kind="stable") if order is None else np.lexsort((y[order].to_numpy(), code[len(x) :]))
            at_a, at_b = (np.searchsorted(c, np.arange(code.max() + 2)) for c in (code[: len(x)][by_a], code[len(x) :][by_b]))
            for k in np.flatnonzero((np.diff(at_a) > 0) & (np.diff(at_b) > 0)):
                rows_a, rows_b = by_a[at_a[k] : at_a[k + 1]], by_b[at_b[k] : at_b[k + 1]]
                r, c, v = choose(p.take(rows_a), q.take(rows_b))
                found.append((rows_a[r], rows_b[c], v))
        r, c, v = (np.concatenate(f) for f in zip(*found))
        return pa.table([*(x[n].take(pa.array(r)) for n in from_a), *(y[n].take(pa.array(c)) for n in from_b), pa.array(v)], names=names)

    return _cogrouped(a, b, ["__g"], read, StructType([StructField(n, t) for n, t in zip(names, types)]))


def _parts(count: Column) -> Column:
    return F.greatest(F.ceil(count / PART), F.lit(1)).cast("int")


def _names(pairs: str) -> Column:
    return F.transform(pairs, lambda x: x["t"])


def _meet(a: DataFrame, b: DataFrame, block: list[str], a_prefix: str, b_prefix: str, cheap: Column | None = None) -> DataFrame:
    """Pairs of rows that share a token of their prefixes, once each; a token's right rows lie in parts.

    Prefixes are arrays of (count, token) in dictionary order, and are used up. `cheap` is a condition on numbers of the
    pair; it is tried before the prefixes are compared, which costs far more than to read the pair.
    """
    own_a, own_b = ([c for c in side.columns if c != prefix] for side, prefix in ((a, a_prefix), (b, b_prefix)))
    left = a.select(*own_a, _names(a_prefix).alias("__na"), F.inline(a_prefix).alias("__c", "__tok"))
    left = left.withColumn("__part", F.explode(F.sequence(F.lit(0), _parts(F.col("__c")) - 1))).drop("__c")
    right = b.select(*own_b, _names(b_prefix).alias("__nb_"), F.inline(b_prefix).alias("__c", "__tok"))
    mine = F.pmod(F.xxhash64(*[c for c in own_b if c not in block]), _parts(F.col("__c"))).cast("int")
    right = right.withColumn("__part", mine).drop("__c")
    first = F.element_at(F.array_intersect("__na", "__nb_"), 1) == F.col("__tok")
    once = first if cheap is None else cheap & first
    return left.join(right, [*block, "__tok", "__part"]).filter(once).drop("__tok", "__part", "__na", "__nb_")


def similar_pairs(
    left: DataFrame,
    right: DataFrame,
    block: list[str],
    threshold: float,
    keep_left: list[str],
    keep_right: list[str],
    residual: Column | None = None,
    strict: bool = False,
    left_tokens: str | None = None,
    floor: Column | None = None,
    in_place: tuple[Callable[[pa.Table, pa.Table], pa.Table], str] | None = None,
) -> DataFrame:
    """Pairs (left row, right row) of the same block with Jaccard(tokens) >= threshold (> when strict).

    Both sides have the block columns and `tokens`, a sorted array without repeats or a text of such words joined by
    blanks. They are read twice: keep what is costly. `keep_left` and
    `keep_right` name the columns to return and must not overlap; rows of a side differ in them or in their tokens.
    `residual` may use any of them. `left_tokens` names an output column with the token set of the left row.
    `floor` may name a higher similarity that a pair must have; pairs below it may or may not be returned.
    `in_place` is for work that uses the pairs of a block up: a function of its two sides (sets `__ta` and `__tb`, and the columns to
    keep) and the schema of what it gives instead of the pairs. A block of any size is then read in one task.
    """
    some = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in block])
    a = left.select(*block, F.col("tokens").alias("__ta"), *keep_left).filter(some & _filled("__ta", left.schema["tokens"]))
    b = right.select(*block, F.col("tokens").alias("__tb"), *keep_right).filter(some & _filled("__tb", right.schema["tokens"]))
    if in_place is not None:
        return _cogrouped(a, b, block, *in_place)
    large, groups = large_blocks(a, b, block)
    (a, large_a), (b, large_b) = (_by_size(side, large, block) for side in (a, b))
    out = [*block, *(["__ta"] if left_tokens else []), *keep_left, *keep_right, "sim"]
    from_a = [c for c in out if c in a.columns]

    def choose(p: matrix.Sets, q: matrix.Sets) -> tuple[np.ndarray, ...]:
        found = []
        for rows, shared in matrix.compared(p, q):
            sim = matrix.jaccard(shared, p.size[rows], q.size)
            r, c = np.nonzero(sim > threshold + 1e-12 if strict else sim >= threshold - 1e-12)
            found.append((rows[r], c, sim[r, c]))
        return tuple(np.concatenate(f) for f in zip(*found))

    every = _in_place(a, b, block, groups, choose, from_a, keep_right, "sim")
    if residual is not None:
        every = every.filter(residual)
    if large is not None:
        every = every.unionByName(_prefix_pairs(large_a, large_b, block, threshold, residual, floor).select(*out))
    enough = F.col("sim") > threshold + 1e-12 if strict else F.col("sim") >= threshold - 1e-12
    extra = [F.col("__ta").alias(left_tokens)] if left_tokens else []
    return every.filter(enough).select(*block, *keep_left, *keep_right, *extra, "sim")


def _filled(name: str, field: StructField) -> Column:
    """Is a set not empty?"""
    return F.col(name) != "" if field.dataType == StringType() else F.size(name) > 0


def _as_lists(side: DataFrame, name: str) -> DataFrame:
    """Sets as arrays of words."""
    return side.withColumn(name, F.split(name, " ")) if side.schema[name].dataType == StringType() else side


def _prefix_pairs(a: DataFrame, b: DataFrame, block: list[str], threshold: float, residual: Column | None, floor: Column | None) -> DataFrame:
    """All columns and `sim` of the pairs of large blocks that share a token of their prefixes."""
    words = a.schema["__ta"].dataType
    a, b = _as_lists(a, "__ta").withColumn("__ma", _mask("__ta")), _as_lists(b, "__tb").withColumn("__mb", _mask("__tb"))
    least = F.lit(threshold) if floor is None else F.greatest(floor, F.lit(threshold))
    fits = _may_share(least / (1 + least) * (F.size("__ta") + F.size("__tb")) - 1e-9)
    counts = token_counts(b, block, "__tb")
    pa_, pb_ = (
        _ranked(side, block, tokens, counts).withColumn(name, F.slice("__k", F.lit(1), _prefix_length(F.col("__k"), threshold))).drop("__k")
        for side, tokens, name in ((a, "__ta", "__pa"), (b, "__tb", "__pb"))
    )
    pairs = _meet(pa_, pb_, block, "__pa", "__pb", fits if residual is None else fits & residual)
    scored = pairs.withColumn("sim", text.set_jaccard(F.col("__ta"), F.col("__tb")))
    return scored.withColumn("__ta", F.array_join("__ta", " ")) if words == StringType() else scored


def best_partner(left: DataFrame, right: DataFrame, block: list[str], order: str, threshold: float | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(block, tokens, keep, best, score): for each left row the right row of its block with the best score, first on a tie.

    The score is the Jaccard similarity, at least `threshold`, or without one the number of shared tokens, at least 1.
    Left rows are distinct (block, tokens), or (block, tokens, keep); right rows have a unique number `order` too. In large blocks
    the search raises its own bound: partners that share a rare token (of at most `DIRECT` right rows) are scored first. Any other
    partner shares frequent tokens only, so its score depends on its frequent tokens and its size: such rows are one
    class with one first row. Classes are joined only through so many of a left set's frequent tokens as a score above
    the one found leaves open, and not at all where none is left.
    """
    some = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in block])
    a = left.select(*block, F.col("tokens").alias("__ta"), *keep).filter(some & _filled("__ta", left.schema["tokens"]))
    b = right.select(*block, F.col("tokens").alias("__tb"), F.col(order).alias("__o")).filter(some & _filled("__tb", right.schema["tokens"]))
    large, groups = large_blocks(a, b, block)
    (a, large_a), (b, large_b) = (_by_size(side, large, block) for side in (a, b))
    least = 1.0 if threshold is None else threshold - 1e-12

    def choose(p: matrix.Sets, q: matrix.Sets) -> tuple[np.ndarray, ...]:
        best, score = np.zeros(len(p.size), np.int64), np.zeros(len(p.size))
        for rows, shared in matrix.compared(p, q):
            s = shared if threshold is None else matrix.jaccard(shared, p.size[rows], q.size)
            best[rows] = s.argmax(axis=1)  # the first one of equals
            score[rows] = s[np.arange(len(rows)), best[rows]]
        good = np.flatnonzero(score >= least)
        return good, best[good], score[good]

    names = [*block, "tokens", *keep, "best", "score"]
    found = _in_place(a, b, block, groups, choose, [*block, "__ta", *keep], ["__o"], "score", "__o")
    found = found.withColumnsRenamed({"__ta": "tokens", "__o": "best"})
    if large is None:
        return found
    sets = large_a.select(*block, "__ta").distinct()
    far = _best_in_large(_as_lists(sets, "__ta"), _as_lists(large_b, "__tb"), block, threshold)
    if left.schema["tokens"].dataType == StringType():
        far = far.withColumn("tokens", F.array_join("tokens", " "))
    if keep:
        far = far.join(large_a.withColumnRenamed("__ta", "tokens"), [*block, "tokens"])
    return found.unionByName(far.select(names))


def _best_in_large(a: DataFrame, b: DataFrame, block: list[str], threshold: float | None) -> DataFrame:
    """(block, tokens, best, score) of large blocks."""
    a, b = a.withColumn("__ma", _mask("__ta")), b.withColumn("__mb", _mask("__tb"))

    def score(shared: Column, n_a: Column, n_b: Column) -> Column:
        return shared.cast("double") if threshold is None else shared / (n_a + n_b - shared)

    def best_of(pairs: DataFrame) -> DataFrame:
        enough = F.col("__s") >= (1.0 if threshold is None else threshold - 1e-12)
        return pairs.filter(enough).groupBy(*block, "__ta").agg(F.max(F.struct(F.col("__s").alias("s"), (-F.col("__o")).alias("o"))).alias("__h"))

    fits = None if threshold is None else _may_share(threshold / (1 + threshold) * (F.size("__ta") + F.size("__tb")) - 1e-9)
    ranked_a, ranked_b = large_sides(a, b, block)
    near = rare_candidates(ranked_a, ranked_b, block, fits)
    shared = F.size(F.array_intersect("__ta", "__tb"))
    near = best_of(near.withColumn("__s", score(shared, F.size("__ta"), F.size("__tb"))).select(*block, "__ta", "__s", "__o"))
    bounded = ranked_a.join(near, [*block, "__ta"], "left")
    found = F.coalesce("__h.s", F.lit(0.0))
    floor = F.greatest(found, F.lit(1.0)) if threshold is None else F.ceil(F.greatest(found, F.lit(threshold)) * F.size("__ta") - 1e-9)
    classes = class_candidates(bounded.withColumn("__need", floor.cast("int")).drop("__h"), ranked_b, block)
    far = best_of(classes.withColumn("__s", score(F.size(F.array_intersect("__fa", "__fb")), F.size("__ta"), F.col("__nb"))))
    best = near.unionByName(far).groupBy(*block, "__ta").agg(F.max("__h").alias("__h"))
    return best.select(*block, F.col("__ta").alias("tokens"), (-F.col("__h.o")).alias("best"), F.col("__h.s").alias("score"))


def large_sides(a: DataFrame, b: DataFrame, block: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with their rare tokens `__r` and frequent tokens `__f`, as (count, token) rare first."""
    counts = token_counts(b, block, "__tb")

    def split(side: DataFrame, tokens: str) -> DataFrame:
        k = _ranked(side, block, tokens, counts)
        return k.withColumns({"__r": F.filter("__k", lambda x: x["c"] <= DIRECT), "__f": F.filter("__k", lambda x: x["c"] > DIRECT)}).drop("__k")

    return split(a, "__ta"), split(b, "__tb")


def rare_candidates(a: DataFrame, b: DataFrame, block: list[str], cheap: Column | None = None) -> DataFrame:
    """Pairs that share a rare token."""
    return _meet(a.drop("__f"), b.drop("__f").withColumnRenamed("__r", "__q"), block, "__r", "__q", cheap)


def class_candidates(a: DataFrame, b: DataFrame, block: list[str]) -> DataFrame:
    """(block, __ta, __fa, __fb, __nb, __o): left sets with classes of right rows that have the same frequent tokens and size.

    A class is met through the |F| - need + 1 rarest frequent tokens of the left set; all its own are listed.
    """
    classes = b.groupBy(*block, F.col("__f").alias("__g"), F.size("__tb").alias("__nb")).agg(F.min("__o").alias("__o"))
    open_ = F.size("__f") - F.col("__need") + 1
    asked = a.filter(open_ > 0).select(*block, "__ta", _names("__f").alias("__fa"), F.slice("__f", F.lit(1), open_).alias("__p"))
    return _meet(asked, classes.withColumn("__fb", _names("__g")), block, "__p", "__g")
