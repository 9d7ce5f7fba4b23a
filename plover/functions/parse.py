"""Text, number, clock and time parsing columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, FloatType, TimestampNTZType, TimestampType

# Fixed values that must equal the reference's for the same results:
#   percent sign stripped from rate text: "%"
#   tenure text: words/"n/a" removed by the pattern "([ ]*+[a-zA-Z].*)|(n/a)",
#   then "< 1" becomes "0" and "10+" becomes "10"
#   year of "Mon-YYYY" text: characters 5 to 8 (1-based)
#   merged level: "Source Verified" -> "Verified"
#   flight time pattern: date "yyyy-MM-dd", clock "Hmm" padded to 4 digits
PERCENT_SIGN = "%"
TENURE_WORDS = "([ ]*+[a-zA-Z].*)|(n/a)"
TENURE_LT1 = ("< 1", "0")
TENURE_10PLUS = ("10\\+", "10")
MONTH_YEAR_POS = (5, 4)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_number_text(col: str | Column) -> Column:
    """Weather-style text to double: trims, junk ('T', '0.00s', '') -> null."""
    return F.trim(_c(col).cast("string")).try_cast("double")


def parse_percent(col: str | Column) -> Column:
    """C1: '13.56%' -> 13.56; '' / null / junk -> null."""
    return parse_number_text(F.regexp_replace(_c(col), PERCENT_SIGN, ""))


def parse_month_year(col: str | Column) -> Column:
    """C2: 'Dec-2015' -> 2015.0 (fixed character positions)."""
    pos, length = MONTH_YEAR_POS
    return F.substring(_c(col), pos, length).try_cast("double")


def parse_tenure(col: str | Column) -> Column:
    """C4: '10+ years' -> 10, '< 1 year' -> 0, '3 years' -> 3, 'n/a' -> null."""
    s = F.trim(F.regexp_replace(_c(col), TENURE_WORDS, ""))
    s = F.trim(F.regexp_replace(s, *TENURE_LT1))
    s = F.trim(F.regexp_replace(s, *TENURE_10PLUS))
    return s.try_cast("double")


def merge_levels(col: str | Column, mapping: dict[str, str]) -> Column:
    """Replace whole category labels by others, then trim."""
    c = _c(col)
    out = c
    for src, dst in mapping.items():
        out = F.regexp_replace(out, src, dst)
    return F.trim(out)


def net_amount(paid: str | Column, amount: str | Column, scale: int = 2) -> Column:
    """round(paid - amount, 2) (HALF_UP)."""
    return F.round(_c(paid) - _c(amount), scale)


def clock_text(col: str | Column) -> Column:
    """Clock number as 4-digit text ('5' -> '0005'); lpad cuts longer text."""
    return F.lpad(_c(col).cast("string"), 4, "0")


def clock_hour(col: str | Column, wrap_24: bool = False) -> Column:
    """Hour from the padded clock; '2400' gives 24 unless ``wrap_24``."""
    h = F.substring(clock_text(col), 1, 2).try_cast("int")
    return F.when(h == 24, F.lit(0)).otherwise(h) if wrap_24 else h


def parse_timestamp(col: str | Column, fmt: str | None = None) -> Column:
    """Text -> timestamp, null on failure."""
    c = _c(col).cast("string")
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def flight_timestamp(date_col: str | Column, clock_col: str | Column) -> Column:
    """C11-C12: 'yyyy-MM-dd' + clock 'Hmm' -> timestamp.

    The clock is padded to 4 digits and parsed as HHmm; '2400' is midnight of
    the next day; a null clock gives null (not the bare date).
    """
    d = _c(date_col).cast("string")
    clock = clock_text(clock_col)
    base = F.try_to_timestamp(F.concat_ws(" ", d, clock), F.lit("yyyy-MM-dd HHmm"))
    midnight = F.try_to_timestamp(F.concat_ws(" ", d, F.lit("0000")), F.lit("yyyy-MM-dd HHmm"))
    return (
        F.when(_c(clock_col).isNull(), F.lit(None).cast("timestamp"))
        .when(clock == "2400", midnight + F.expr("INTERVAL 1 DAY"))
        .otherwise(base)
    )


def epoch_seconds(col: str | Column, dtype: DataType | None = None) -> Column:
    """C14: whole epoch seconds, like ``cast('long')`` of a timestamp.

    For TIMESTAMP_NTZ the wall clock is read as UTC, independent of the
    session time zone.
    """
    c = _c(col)
    if isinstance(dtype, TimestampNTZType):
        return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.unix_seconds(c.cast("timestamp"))


def is_missing(col: str, dtype: DataType) -> Column:
    """Null, or NaN for float/double; timestamps and text use null only."""
    c = F.col(col)
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_time_type(dtype: DataType) -> bool:
    return isinstance(dtype, (DateType, TimestampType, TimestampNTZType))


def route_name(origin: str | Column, dest: str | Column) -> Column:
    """C18: 'origin - dest'."""
    return F.concat_ws(" - ", _c(origin), _c(dest))
