"""Attributes of records from several suppliers, merged by precedence in one keyed aggregate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Supplier:
    """Rows (key, attributes): what one supplier says of records. A NULL attribute says nothing.

    Attributes in `overrides` replace what earlier suppliers and the record have, all others only fill a gap. Of several
    rows of a key the first in `order` that says something counts. `count_as` names a column for the number of rows.
    """

    rows: DataFrame
    overrides: frozenset[str] = field(default_factory=frozenset)
    order: str | None = None
    count_as: str | None = None


def precedence_merge(base: DataFrame, key: str, suppliers: list[Supplier]) -> DataFrame:
    """The rows of `base` (one per key) with the attributes of all suppliers, in the order given.

    Suppliers are not joined one after the other: their narrow rows and the records meet in a single aggregate, so the
    number of shuffles does not grow with the suppliers. Rows of keys that `base` does not have are left out.
    """
    taken = {key, *(s.order for s in suppliers if s.order)}
    names = list(dict.fromkeys(c for s in suppliers for c in s.rows.columns if c not in taken))
    kinds = {c: s.rows.schema[c].dataType for s in reversed(suppliers) for c in s.rows.columns if c in names}
    kinds |= {c: base.schema[c].dataType for c in names if c in base.columns}
    own = [c for c in base.columns if c not in names and c != key]
    row = F.struct(*own, F.lit(1).alias("__is"))

    def said(df: DataFrame, have: list[str], at: int, order: str | None, rest) -> DataFrame:
        values = [(F.col(c) if c in have else F.lit(None)).cast(kinds[c]).alias(c) for c in names]
        place = F.lit(0).cast("bigint") if order is None else -F.col(order).cast("bigint")
        return df.select(key, rest.alias("__row"), F.lit(at).alias("__s"), place.alias("__o"), *values)

    none = F.lit(None).cast(base.select(row.alias("r")).schema["r"].dataType)
    every = said(base, [c for c in names if c in base.columns], 0, None, row)
    for i, s in enumerate(suppliers, 1):
        every = every.unionByName(said(s.rows, [c for c in s.rows.columns if c in names], i, s.order, none))

    def rank(c: str):
        above = [i for i, s in enumerate(suppliers, 1) if c in s.overrides]
        number = F.when(F.col("__s").isin(above), F.col("__s")).otherwise(-F.col("__s")) if above else -F.col("__s")
        return F.when(F.col(c).isNotNull(), F.struct(number.alias("s"), F.col("__o").alias("o")))

    counts = [F.count(F.when(F.col("__s") == i, 1)).alias(s.count_as) for i, s in enumerate(suppliers, 1) if s.count_as]
    merged = every.groupBy(key).agg(F.first("__row", ignorenulls=True).alias("__row"), *[F.max_by(c, rank(c)).alias(c) for c in names], *counts)
    return merged.filter("__row is not null").select(key, *[F.col("__row")[c].alias(c) for c in own], *names, *[s.count_as for s in suppliers if s.count_as])
