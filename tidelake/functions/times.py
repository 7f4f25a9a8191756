"""Times as exact microseconds since the epoch, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND, MINUTE, HOUR, DAY = 10**6, 60 * 10**6, 3600 * 10**6, 86400 * 10**6
#: Microseconds in one unit; nanoseconds are handled by division.
UNITS = {"s": SECOND, "ms": 1000, "us": 1}


def us(column: str | Column) -> Column:
    """Microseconds of a timestamp, with or without a zone (read as UTC)."""
    return F.unix_micros(F.col(column).cast("timestamp") if isinstance(column, str) else column.cast("timestamp"))


def floor_to(column: Column, step: int, origin: int = 0) -> Column:
    """The latest origin + n * step at or before column; exact for times before the origin too."""
    return column - F.pmod(column - F.lit(origin), F.lit(step))


def unit_by_digits(column: Column) -> Column:
    """The unit an integer time is written in, by its digits: 16 or more us, 13 or more ms, else s."""
    digits = F.length(F.abs(column.cast("long")).cast("string"))
    return F.when(digits >= 16, "us").when(digits >= 13, "ms").when(column.isNotNull(), "s")


def to_us(column: Column, unit: Column) -> Column:
    """Microseconds of an integer time in the given unit (s, ms, us or ns; ns must be whole microseconds, else null)."""
    whole = F.when(column % 1000 == 0, F.floor(column / 1000).cast("long"))
    return F.when(unit == "ns", whole).when(unit == "us", column).when(unit == "ms", column * 1000).when(unit == "s", column * SECOND)


def plausible_unit(column: Column, least_us: int, most_us: int) -> Column:
    """The one unit in which an integer time falls within bounds; AMBIGUOUS for several, OUT_OF_RANGE for none, null for null."""
    scaled = {"s": (column >= -(-least_us // SECOND)) & (column <= most_us // SECOND), "ms": (column >= -(-least_us // 1000)) & (column <= most_us // 1000)}
    scaled |= {"us": column.between(least_us, most_us), "ns": (column >= least_us * 1000) & (column <= most_us * 1000 + 999)}
    fits = F.array_compact(F.array(*(F.when(test, F.lit(unit)) for unit, test in scaled.items())))
    return F.when(column.isNull(), F.lit(None)).when(F.size(fits) > 1, "AMBIGUOUS").when(F.size(fits) == 1, fits[0]).otherwise("OUT_OF_RANGE")


def decimal_seconds(token: Column) -> Column:
    """Microseconds of a plain decimal-seconds token in [0, year 2100); null for signs, exponents and finer fractions."""
    whole, fraction = F.split(token, r"\.")[0], F.coalesce(F.get(F.split(token, r"\."), F.lit(1)), F.lit(""))
    fine = F.length(F.regexp_replace(fraction, "0+$", "")) <= 6
    value = whole.cast("long") * SECOND + F.rpad(F.substring(fraction, 1, 6), 6, "0").cast("long")
    return F.when(token.rlike(r"^\d{1,10}(\.\d+)?$") & fine & (F.length(whole) <= 10), F.when(value < 4102444800 * SECOND, value))


def closes_at(open_us: Column, interval_us: int, unit: Column) -> Column:
    """The inclusive close of a candle in its source's unit, as microseconds: one unit before the next open."""
    return open_us + F.lit(interval_us) - F.when(unit == "s", F.lit(SECOND)).when(unit == "ms", F.lit(1000)).otherwise(F.lit(1))
