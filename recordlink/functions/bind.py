"""Name a value once inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, as a lambda variable."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


SEPARATOR = "\x00"


def cut(text: Column, pattern: str) -> Column:
    """`F.split(text, pattern)` with a pattern that matches no empty text, compiled once: `split` compiles it for every row."""
    marked = lambda v: F.split(F.regexp_replace(v, pattern, SEPARATOR), SEPARATOR)
    return let(text, lambda v: F.when(F.contains(v, F.lit(SEPARATOR)), F.split(v, pattern)).otherwise(marked(v)))
