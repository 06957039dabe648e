"""Trailing-window enrichment of bars.

Per symbol, in date order (rows, not calendar days), with the current row in
its own frame:

* ``moving_avg_7``  mean close of the last 7 rows, rounded half-even to 2 dp,
                    NULL while fewer than 7 rows exist;
* ``volume_spike``  volume > 2 * mean volume of the last 1..7 rows (partial
                    frames allowed, mean not rounded);
* ``pct_change``    (close - open) / open * 100 rounded to 2 dp;
* ``is_anomaly``    abs(pct_change) > 3 on the rounded value.

Two physical plans give the same rows:

``enrich_by_symbol``  one ``Window.partitionBy(symbol)``. Simple, but every row
    of a symbol lands in one task: with a handful of symbols, one of which may
    hold a third of the data, that task is the whole job.

``enrich`` (default)  splits each symbol into ordered *buckets* (a fixed-length
    prefix of the date string, e.g. ``yyyy-MM``; a prefix of fixed length keeps
    string order, so bucket order is time order). The window runs per
    (symbol, bucket): one shuffle of the bars, any number of tasks per symbol.
    Only the first 6 rows of a bucket need rows from earlier buckets; those
    come from a *halo*: the last <= 6 rows before each bucket, read off a
    window over the bucket *tails* (the last <= 6 rows of each bucket). The
    head rows are completed by joining that halo on (symbol, bucket), which
    reuses the window's hash partitioning, so the bars are shuffled once.

    The only per-symbol window runs over the tails: at most 6 rows per
    bucket, so its length is bounded by the calendar span / bucket width, not
    by the number of rows. Choose buckets much longer than 6 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import pct_change, price_anomaly, round_half_even, volume_spike
from tidemark.operators.validate import BAD_NUMBER, MISSING_DATE, MISSING_FIELD, MISSING_SYMBOL, ZERO_OPEN
from tidemark.schemas import BAR_COLUMNS, ENRICHED_COLUMNS, MA_DECIMALS, WINDOW_ROWS

HALO = WINDOW_ROWS - 1  # rows from before the current one that share its frame

# Default bucket: the first 7 characters of the date ('yyyy-MM', a month).
DEFAULT_BUCKET_CHARS = 7


def _order_cols(df: DataFrame) -> list[str]:
    # The reference orders by arrival; arrival equals date order there. A seq
    # column, when present, breaks ties between equal dates.
    return ["date", "seq"] if "seq" in df.columns else ["date"]


def finish_indicators(df: DataFrame, close_sum: Column, vol_sum: Column, rows: Column) -> DataFrame:
    """Derive the four indicator columns from trailing sums and frame size."""
    ma = F.when(rows == WINDOW_ROWS, round_half_even(close_sum / F.lit(float(WINDOW_ROWS)), MA_DECIMALS))
    return (df.withColumn("pct_change", pct_change())
              .withColumn("moving_avg_7", ma.cast("double"))
              .withColumn("is_anomaly", price_anomaly())
              .withColumn("volume_spike", volume_spike("volume", vol_sum, rows)))


def enrich_by_symbol(bars: DataFrame) -> DataFrame:
    """One window per symbol (reference-shaped plan; used to cross-check)."""
    w = Window.partitionBy("symbol").orderBy(*_order_cols(bars)).rowsBetween(-HALO, 0)
    df = (bars.withColumn("_csum", F.sum("close").over(w))
              .withColumn("_vsum", F.sum("volume").over(w))
              .withColumn("_rows", F.count(F.lit(1)).over(w)))
    return finish_indicators(df, F.col("_csum"), F.col("_vsum"), F.col("_rows")).select(*ENRICHED_COLUMNS)


def enrich(bars: DataFrame, bucket_chars: int = DEFAULT_BUCKET_CHARS, order: list[str] | None = None,
           bucket: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Skew-safe enrichment: window per (symbol, bucket) plus a halo join.

    ``order`` defaults to (date[, seq]) and ``bucket`` to the first
    ``bucket_chars`` characters of the date; any ``bucket`` works whose order
    agrees with ``order`` (e.g. ``floor(seq / n)`` when ordering by ``seq``).
    ``keep`` names extra input columns carried to the output.

    Input contract: the ordering is unique per symbol (for bars: one row per
    (symbol, date), or add ``seq``; ``upsert_latest`` deduplicates), and rows
    with a NULL symbol or bucket are not enriched (``valid_bars`` and the
    reject routing take them out first).
    """
    order = order or _order_cols(bars)
    bucket = bucket if bucket is not None else F.substring("date", 1, bucket_chars)
    # Explicit non-null keys: the joins below would otherwise infer them for
    # some branches only, and branches that differ cannot reuse one exchange.
    base = (bars.withColumn("_b", bucket)
                .filter(F.col("symbol").isNotNull() & F.col("_b").isNotNull()))

    wb = Window.partitionBy("symbol", "_b").orderBy(*order)
    trailing = wb.rowsBetween(-HALO, 0)
    whole = wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One Window operator (same partition + order spec), one exchange.
    staged = (base.withColumn("_rn", F.row_number().over(wb))
                  .withColumn("_n", F.count(F.lit(1)).over(whole))
                  .withColumn("_csum", F.sum("close").over(trailing))
                  .withColumn("_vsum", F.sum("volume").over(trailing))
                  .withColumn("_rows", F.count(F.lit(1)).over(trailing)))

    # Rows past the first 6 of their bucket already have their whole frame.
    body = finish_indicators(staged.filter(F.col("_rn") > HALO),
                   F.col("_csum"), F.col("_vsum"), F.col("_rows"))

    # Tails: the last <= 6 rows of every bucket. In the time-ordered sequence
    # of all tail rows of a symbol, the 6 tail rows before a bucket's first
    # tail row are exactly the 6 rows before that bucket (every earlier row
    # that close to it is among the last 6 of its own bucket). So one window
    # over the tails yields each bucket's halo. The tails keep every bar
    # column so this branch reads the same exchange as the others.
    tails = staged.filter(F.col("_n") - F.col("_rn") < HALO)
    wt = Window.partitionBy("symbol").orderBy(*order).rowsBetween(-HALO, -1)
    halo = (tails.withColumn("_halo", F.collect_list(
                F.struct(*order, "close", "volume", "open", "high", "low")).over(wt))
            .filter(F.col("_rn") == F.greatest(F.col("_n") - (HALO - 1), F.lit(1)))
            .select("symbol", "_b", "_halo"))

    # Head rows (first 6 of a bucket): prepend the last (7 - rn) halo rows.
    # Their own earlier closes come as lags, so that the sum runs oldest to
    # newest as in one window and does not depend on where a bucket begins.
    lags = [F.coalesce(F.lag("close", k).over(wb), F.lit(0.0)).alias(f"_l{k}") for k in range(HALO - 1, 0, -1)]
    head = (staged.select("*", *lags).filter(F.col("_rn") <= HALO).join(halo, ["symbol", "_b"], "left"))
    h = F.coalesce(F.col("_halo"), F.array().cast(halo.schema["_halo"].dataType))
    take = F.least(F.lit(WINDOW_ROWS) - F.col("_rn"), F.size(h))
    frame = F.slice(h, F.size(h) - take + 1, take)
    halo_close = F.aggregate(frame, F.lit(0.0), lambda a, x: a + x["close"])
    halo_vol = F.aggregate(frame, F.lit(0).cast("long"), lambda a, x: a + x["volume"])
    close_sum = halo_close
    for k in range(HALO - 1, 0, -1):
        close_sum = close_sum + F.col(f"_l{k}")
    head = finish_indicators(head, close_sum + F.col("close"), halo_vol + F.col("_vsum"), take + F.col("_rows"))

    out = [*ENRICHED_COLUMNS, *[c for c in keep if c not in ENRICHED_COLUMNS]]
    return body.select(*out).unionByName(head.select(*out))


def bar_reject_reason() -> Column:
    """Why the reference cannot process a bar, in the order of the message checks; NULL for a valid bar."""
    missing = bad = F.lit(False)
    for c in ("open", "high", "low", "close"):
        missing = missing | F.col(c).isNull()
        bad = bad | F.coalesce(F.isnan(c) | (F.abs(F.col(c)) == F.lit(float("inf"))), F.lit(False))
    return (F.when(missing | F.col("volume").isNull(), F.lit(MISSING_FIELD)).when(F.col("open") == 0, F.lit(ZERO_OPEN))
            .when(bad, F.lit(BAD_NUMBER)).when(F.col("symbol").isNull(), F.lit(MISSING_SYMBOL)).when(F.col("date").isNull(), F.lit(MISSING_DATE)))


def valid_bars(bars: DataFrame) -> DataFrame:
    """Bars the reference can process: finite prices, non-zero open, volume, symbol and date present.
    The others are in ``reject_bars`` and never enter a window."""
    return bars.filter(bar_reject_reason().isNull())


def reject_bars(bars: DataFrame) -> DataFrame:
    """The bars that are not enriched, each with its reason."""
    return bars.withColumn("reason", bar_reject_reason()).filter(F.col("reason").isNotNull())


def row_indicators(bars: DataFrame) -> DataFrame:
    """Valid bars with the indicators that need no other row: pct_change and is_anomaly."""
    return valid_bars(bars).withColumn("pct_change", pct_change()).withColumn("is_anomaly", price_anomaly())


def enrich_bars(bars: DataFrame, bucket_chars: int = DEFAULT_BUCKET_CHARS) -> DataFrame:
    """Validate, then enrich: the batch equivalent of the stream consumer."""
    return enrich(valid_bars(bars).select(*BAR_COLUMNS, *([c for c in ["seq"] if c in bars.columns])),
                  bucket_chars)
