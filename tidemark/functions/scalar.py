"""Column expressions used by the bar operators. All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import (ANOMALY_PCT, BENCH_KEY_DAYS, BENCH_KEY_PER_MONTH, BENCH_KEY_YEAR, BENCH_PREFIX,
                              COMPUTED_DECIMAL, NUMERIC_ROW_PATTERN, PCT_DECIMALS, PRICE_DECIMAL, SPIKE_FACTOR)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_even(x, scale: int) -> Column:
    """Half-even rounding on the decimal repr (closest built-in to Python's round)."""
    return F.bround(_c(x), scale)


def pct_change(open_="open", close="close") -> Column:
    """Intraday change open -> close in percent, rounded to 2 dp; NULL when open is 0."""
    o, c = _c(open_), _c(close)
    return round_half_even(F.try_divide(c - o, o) * F.lit(100), PCT_DECIMALS)


def price_anomaly(pct="pct_change") -> Column:
    """abs(rounded pct_change) > 3, strict; compares the already rounded value."""
    return F.abs(_c(pct)) > F.lit(ANOMALY_PCT)


def volume_spike(volume, volume_sum, rows) -> Column:
    """volume > 2 * (trailing volume sum / rows in the trailing frame), strict."""
    return _c(volume) > F.lit(SPIKE_FACTOR) * (_c(volume_sum).cast("double") / _c(rows))


def to_price_decimal(x) -> Column:
    """Double to its shortest-repr decimal (null stays null)."""
    return _c(x).cast(PRICE_DECIMAL)


def to_computed_decimal(x) -> Column:
    return _c(x).cast(COMPUTED_DECIMAL)


def is_numeric_text(x) -> Column:
    """True when the text is an optionally negative decimal number without
    exponent, sign '+', blanks or bare dots. NULL input gives NULL (dropped by a filter)."""
    return _c(x).rlike(NUMERIC_ROW_PATTERN)


def null_display(x) -> Column:
    """Render a value as text with 'N/A' for NULL (profile report convention)."""
    return F.coalesce(_c(x).cast("string"), F.lit("N/A"))


def bench_date_key(i, year: int = BENCH_KEY_YEAR, per_month: int = BENCH_KEY_PER_MONTH,
                   days: int = BENCH_KEY_DAYS) -> Column:
    """Synthetic benchmark sort key for integer ``i``: BENCH-<year>-MM-DD with
    MM = i div per_month + 1 and DD = i mod days + 1, both zero padded."""
    i = _c(i).cast("long")
    return F.format_string(f"{BENCH_PREFIX}{year}-%02d-%02d", F.floor(i / per_month) + 1,
                           F.pmod(i, F.lit(days)) + 1)
