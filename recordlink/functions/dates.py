"""Date expressions. `as_of` is always an argument; nothing reads the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlink import fixed_values as fv
from recordlink.functions.bind import let

ISO = r"(\d{4})-(\d{2})-(\d{2})"
SLASH = r"(\d{1,2})/(\d{1,2})/(\d{2,4})"
DOT = r"(\d{1,2})\.(\d{1,2})\.(\d{2,4})"
MONTH = r"([\p{L}\p{N}_]+)\s+(\d{1,2}),?\s+(\d{4})"


def as_date(value: str) -> Column:
    return F.lit(value).cast("date")


def month_number(name: Column) -> Column:
    """Month number of an English month name or abbreviation, else NULL."""
    low = F.lower(name)
    table = F.str_to_map(F.lit(",".join(f"{k}:{v}" for k, v in fv.MONTHS.items())), F.lit(","), F.lit(":"))
    return F.try_element_at(table, low).cast("int")


def _assemble(year: Column, month: Column, day: Column) -> Column:
    """Date of three texts of digits; NULL at once where a part is missing, without a failing parse."""
    number = year.cast("int")
    full_year = F.when(number < 100, number + 2000).otherwise(number)
    text = F.concat_ws("-", F.lpad(full_year.cast("string"), 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.when((year != "") & month.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def _numeric(text: Column, pattern: str) -> Column:
    part = [F.regexp_extract(text, pattern, i) for i in (1, 2, 3)]
    return _assemble(part[2], part[0], part[1])


def parse_date(text: Column) -> Column:
    """ISO, M/D/Y, M.D.Y or `Month D, Y`. The first pattern found decides; an impossible date is NULL."""
    iso = F.try_to_date(F.regexp_extract(text, ISO, 0), "yyyy-MM-dd")
    month = month_number(F.regexp_extract(text, MONTH, 1)).cast("string")
    named = _assemble(F.regexp_extract(text, MONTH, 3), month, F.regexp_extract(text, MONTH, 2))
    return (
        F.when(text.rlike(ISO), iso)
        .when(text.rlike(SLASH), _numeric(text, SLASH))
        .when(text.rlike(DOT), _numeric(text, DOT))
        .otherwise(named)
    )


def parse_date_once(text: Column) -> Column:
    """`parse_date` inside an expression that is not compiled: each pattern is looked for once, its parts in what it found."""
    iso, slash, dot = (F.regexp_extract(text, p, 0) for p in (ISO, SLASH, DOT))

    def of_name(m: Column) -> Column:
        month, year = month_number(F.regexp_extract(m, MONTH, 1)).cast("string"), F.regexp_extract(m, MONTH, 3)
        return let(month, lambda n: F.when(n.isNotNull(), let(year, lambda y: _assemble(y, n, F.regexp_extract(m, MONTH, 2)))))

    named = let(F.regexp_extract(text, MONTH, 0), lambda m: F.when(m != "", of_name(m)))
    dotted = let(dot, lambda m: F.when(m != "", _numeric(m, DOT)).otherwise(named))
    slashed = let(slash, lambda m: F.when(m != "", _numeric(m, SLASH)).otherwise(dotted))
    return let(iso, lambda m: F.when(m != "", F.try_to_date(m, "yyyy-MM-dd")).otherwise(slashed))


def date_window_flags(date: Column, cutoff: str, as_of: str, back: int = 730, ahead: int = 180) -> tuple[Column, Column]:
    """(plausible, recent): inside [as_of-back, as_of+ahead]; plausible and not before the cutoff."""
    plausible = F.coalesce(date.between(F.date_sub(as_date(as_of), back), F.date_add(as_date(as_of), ahead)), F.lit(False))
    return plausible, plausible & F.coalesce(date >= as_date(cutoff), F.lit(False))


def age_days(ts: Column, as_of: str) -> Column:
    """Whole days from `ts` to `as_of`, rounded down; NULL when there is no time."""
    elapsed = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(ts.cast("timestamp"))
    return F.floor(elapsed / 86400).cast("bigint")


def session_number(date: Column) -> Column:
    """Number of the two-year session that holds the date (first session began in 1789)."""
    return F.floor((F.year(date) - 1789) / 2).cast("bigint") + 1
