"""Reject routing: every message either becomes a typed bar or a reject row
``(raw, reason)``; nothing is dropped silently and the job never stops on a
bad record.

Reasons are checked in the consumer's order: the JSON must decode; then the
fields are coerced open, high, low, close, volume (absent or null:
``missing_field``; present but not a number: ``bad_number``); then the change
is computed (``zero_open``); then the record must be storable (NaN/infinite
prices: ``bad_number``; no symbol: ``missing_symbol``; no date:
``missing_date``). The first failing check names the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import BAR_COLUMNS
from tidemark.sources.messages import decode_fields, parse

# Fixed reject reason codes.
BAD_JSON = "bad_json"
MISSING_FIELD = "missing_field"
BAD_NUMBER = "bad_number"
ZERO_OPEN = "zero_open"
MISSING_SYMBOL = "missing_symbol"
MISSING_DATE = "missing_date"

NUMERIC_FIELDS = ["open", "high", "low", "close", "volume"]
PRICE_FIELDS = ["open", "high", "low", "close"]


def _finite(c: str) -> Column:
    return ~F.isnan(c) & (F.abs(F.col(c)) != F.lit(float("inf")))


def reject_reason(decoded: DataFrame) -> Column:
    r = F.when(F.col("_m").isNull(), F.lit(BAD_JSON))
    for f in NUMERIC_FIELDS:
        r = r.when(~F.col(f"_p_{f}"), F.lit(MISSING_FIELD)).when(F.col(f).isNull(), F.lit(BAD_NUMBER))
    r = r.when(F.col("open") == 0, F.lit(ZERO_OPEN))
    for f in PRICE_FIELDS:
        r = r.when(~_finite(f), F.lit(BAD_NUMBER))
    r = r.when(~F.col("_p_symbol"), F.lit(MISSING_SYMBOL)).when(~F.col("_p_date"), F.lit(MISSING_DATE))
    return r


def classify(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Messages with their typed fields and ``reason`` (NULL when valid)."""
    d = decode_fields(parse(messages, value_col))
    return d.withColumn("reason", reject_reason(d))


def _extra(messages: DataFrame, value_col: str) -> list[str]:
    return [c for c in messages.columns if c != value_col]


def valid_part(classified: DataFrame, extra: list[str] = ()) -> DataFrame:
    return classified.filter(F.col("reason").isNull()).select(*BAR_COLUMNS, *extra)


def reject_part(classified: DataFrame, value_col: str = "value", extra: list[str] = ()) -> DataFrame:
    return classified.filter(F.col("reason").isNotNull()).select(
        F.col(value_col).alias("raw"), "reason", *extra)


def validate_split(messages: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(valid bars, rejects). Extra message columns (e.g. ``seq``) ride along."""
    c = classify(messages, value_col)
    extra = _extra(messages, value_col)
    return valid_part(c, extra), reject_part(c, value_col, extra)
