"""Boolean and classifying Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sound_ohlc(open_: Column, high: Column, low: Column, close: Column, volume: Column | None = None) -> Column:
    """Prices positive and finite, high and low around open and close, volume finite and not negative."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    test = finite(open_) & finite(high) & finite(low) & finite(close) & (low > 0)
    test = test & (high >= F.greatest(open_, close)) & (low <= F.least(open_, close))
    return F.coalesce(test & (finite(volume) & (volume >= 0) if volume is not None else F.lit(True)), F.lit(False))


def value_class(token: Column) -> Column:
    """null, empty, boolean, integer, float or string, by how a token is written."""
    text = F.trim(token)
    return (
        F.when(token.isNull(), "null").when(text == "", "empty").when(F.lower(text).isin("true", "false"), "boolean")
        .when(text.rlike(r"^[+-]?\d+$"), "integer").when(text.rlike(r"^[+-]?(\d+\.\d*|\.\d+|\d+)([eE][+-]?\d+)?$"), "float").otherwise("string")
    )


def normal_alias(text: Column) -> Column:
    """Trimmed, lower case, runs of blanks as one space."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def fits_decimal(token: Column, scale: int = 18, precision: int = 38) -> Column:
    """Whether a plain decimal token goes into DECIMAL(precision, scale) without rounding."""
    digits = F.regexp_extract(token, r"^[+-]?0*(\d*)", 1)
    fraction = F.regexp_replace(F.regexp_extract(token, r"\.(\d*)$", 1), "0+$", "")
    return F.coalesce(token.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)$") & (F.length(digits) <= precision - scale) & (F.length(fraction) <= scale), F.lit(False))


def close_to(a: Column, b: Column, rel: float = 1e-9, abs_: float = 0.0) -> Column:
    """Equal within a relative or absolute tolerance; NaN equals NaN, infinities equal themselves, null only null."""
    near = F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_))
    infinite = (F.abs(a) == float("inf")) | (F.abs(b) == float("inf"))
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).when(infinite | F.isnan(a) | F.isnan(b), a == b).otherwise(near)


def hex_quantity(token: Column) -> Column:
    """A 0x quantity of up to 112 bits as DECIMAL(38,0); longer or malformed ones are null."""
    digits = F.ltrim(F.substring(token, 3, 1 << 30), F.lit("0"))
    padded = F.lpad(digits, 28, "0")
    high, low = (F.conv(F.substring(padded, at, 14), 16, 10).cast("decimal(38,0)") for at in (1, 15))
    value = (high * F.lit(1 << 56).cast("decimal(20,0)")).cast("decimal(38,0)") + low
    return F.when(token.rlike("^0x[0-9a-fA-F]+$") & (F.length(digits) <= 28), value.cast("decimal(38,0)"))


def address_word(word: Column) -> Column:
    """The 20-byte address in a 32-byte word whose first 12 bytes are zero; else null."""
    return F.when(word.rlike("^0x0{24}[0-9a-fA-F]{40}$"), F.concat(F.lit("0x"), F.lower(F.substring(word, 27, 40))))
