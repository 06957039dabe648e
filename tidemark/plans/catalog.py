"""Named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the shared tables (or data Spark derives from them) in
full; parameters such as a symbol name are the feature being shown (a point
lookup, a one-symbol chart), never a way to make the check cheaper.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import bench_date_key, pct_change, round_half_even
from tidemark.operators import analysis as A
from tidemark.operators import profile as P
from tidemark.operators import profile_parts as PP
from tidemark.operators import rollups as R
from tidemark.operators import validate as VAL
from tidemark.operators.indicators import enrich_bars, reject_bars, row_indicators, valid_bars
from tidemark.schemas import BAR_COLUMNS, BENCH_PREFIX, ENRICHED_COLUMNS, RAW_BAR_COLUMNS
from tidemark.session import scratch_path
from tidemark.sources import bar_files as BF
from tidemark.sources import keyed_store as KS
from tidemark.sources import message_log as ML
from tidemark.sources import messages as MSG
from tidemark.sources import snapshots as SNAP
from tidemark.sources.fs import child_dirs
from tidemark.sources.bars import bar_date, bars, order_bars
from tidemark.sources.tables import read_table
from tidemark.streaming import bucketed as SB
from tidemark.streaming import enrich_state as ST
from tidemark.streaming import sinks as SK


QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Date-prefix length of the enrichment buckets per bar grain: buckets far
# longer than the 6-row halo (year for daily bars, month for hourly, day for
# minute bars), so the halo is a small fraction of each bucket.
BUCKET_CHARS = {"day": 4, "hour": 7, "minute": 10}

# The one-symbol chart shows this symbol.
CHART_SYMBOL = "click"


# The bounded acquisition: end exclusive.
RANGE = ("2024-01-08 00:00:00", "2024-01-15 00:00:00")


def query(name: str):
    def reg(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return reg


def enriched(spark: SparkSession, sf_dir: str, symbol: str = "event_type", grain: str = "hour",
             bucket_chars: int | None = None) -> DataFrame:
    return enrich_bars(bars(spark, sf_dir, grain, symbol),
                       BUCKET_CHARS[grain] if bucket_chars is None else bucket_chars)


# --- bars and indicators ------------------------------------------------------
@query("ohlcv_bars")
def q_ohlcv_bars(spark, sf_dir):
    return bars(spark, sf_dir)


@query("ohlcv_bars_daily")
def q_ohlcv_bars_daily(spark, sf_dir):
    return bars(spark, sf_dir, grain="day")


@query("pct_change")
def q_pct_change(spark, sf_dir):
    return bars(spark, sf_dir).select("symbol", "date", "open", "close", pct_change().alias("pct_change"))


@query("price_anomaly")
def q_price_anomaly(spark, sf_dir):
    return row_indicators(bars(spark, sf_dir)).select("symbol", "date", "pct_change", "is_anomaly")


@query("moving_avg_7")
def q_moving_avg_7(spark, sf_dir):
    return enriched(spark, sf_dir).select("symbol", "date", "close", "moving_avg_7")


@query("volume_spike")
def q_volume_spike(spark, sf_dir):
    return enriched(spark, sf_dir).select("symbol", "date", "volume", "volume_spike")


@query("enrich")
def q_enrich(spark, sf_dir):
    return enriched(spark, sf_dir)


@query("enrich_day_buckets")
def q_enrich_day_buckets(spark, sf_dir):
    # Same rows as ``enrich`` with day buckets (<= 24 hourly bars each), so the
    # halo path carries real rows across bucket borders at test scale.
    return enriched(spark, sf_dir, bucket_chars=10)


@query("enrich_users")
def q_enrich_users(spark, sf_dir):
    return enriched(spark, sf_dir, symbol="user_id")


@query("enrich_rejects")
def q_enrich_rejects(spark, sf_dir):
    # The bars that enrich_users leaves out: bars in = enriched + rejects.
    return reject_bars(bars(spark, sf_dir, symbol="user_id")).select("symbol", "date", "open", "volume", "reason")


@query("ohlcv_bars_range")
def q_ohlcv_bars_range(spark, sf_dir):
    # Acquisition with a half-open date range: the bound reaches the scan.
    return bars(spark, sf_dir, start=RANGE[0], end=RANGE[1])


@query("enrich_daily")
def q_enrich_daily(spark, sf_dir):
    return enriched(spark, sf_dir, grain="day")


@query("ohlcv_bars_orders")
def q_ohlcv_bars_orders(spark, sf_dir):
    return order_bars(spark, sf_dir)


@query("enrich_orders")
def q_enrich_orders(spark, sf_dir):
    # Daily bars over several years with the default (year) buckets: the halo
    # carries rows across real bucket borders.
    return enrich_bars(order_bars(spark, sf_dir), BUCKET_CHARS["day"])


# --- analysis result sets -----------------------------------------------------
@query("series_close")
def q_series_close(spark, sf_dir):
    return A.series_close(valid_bars(bars(spark, sf_dir)))


@query("series_close_vs_ma")
def q_series_close_vs_ma(spark, sf_dir):
    return A.series_close_vs_ma(enriched(spark, sf_dir), CHART_SYMBOL)


@query("anomaly_points")
def q_anomaly_points(spark, sf_dir):
    return A.anomaly_points(row_indicators(bars(spark, sf_dir)))


@query("spike_points")
def q_spike_points(spark, sf_dir):
    return A.spike_points(enriched(spark, sf_dir))


@query("anomaly_counts")
def q_anomaly_counts(spark, sf_dir):
    return A.anomaly_counts(row_indicators(bars(spark, sf_dir)))


@query("most_volatile")
def q_most_volatile(spark, sf_dir):
    return A.most_volatile(row_indicators(bars(spark, sf_dir)))


@query("summary_totals")
def q_summary_totals(spark, sf_dir):
    return A.summary_totals(enriched(spark, sf_dir))


@query("distinct_symbols")
def q_distinct_symbols(spark, sf_dir):
    return A.distinct_symbols(valid_bars(bars(spark, sf_dir)))


@query("sort_symbol_date")
def q_sort_symbol_date(spark, sf_dir):
    return A.sort_symbol_date(enriched(spark, sf_dir))


# --- profile ------------------------------------------------------------------


def profile_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned bars in the raw-file layout (prices and volume as DOUBLE)."""
    b = bars(spark, sf_dir)
    return b.select(b.date.alias("Date"), b.close.alias("Close"), b.high.alias("High"), b.low.alias("Low"),
                    b.open.alias("Open"), b.volume.cast("double").alias("Volume"), "symbol")


def _profile_wide(spark, sf_dir):
    df = profile_input(spark, sf_dir)
    return P.profile_wide(df, "symbol", P.resolve_date_column(df))


@query("profile_counts")
def q_profile_counts(spark, sf_dir):
    return P.profile_counts(_profile_wide(spark, sf_dir), "symbol")


@query("profile_nulls")
def q_profile_nulls(spark, sf_dir):
    return P.profile_nulls(_profile_wide(spark, sf_dir), "symbol", RAW_BAR_COLUMNS)


@query("profile_describe")
def q_profile_describe(spark, sf_dir):
    df = profile_input(spark, sf_dir)
    return P.rounded(P.profile_describe(P.profile_wide(df, "symbol"), "symbol", P.numeric_columns(df, ("symbol",))))


@query("profile_describe_text")
def q_profile_describe_text(spark, sf_dir):
    df = profile_input(spark, sf_dir)
    d = P.profile_describe(P.profile_wide(df, "symbol"), "symbol", P.numeric_columns(df, ("symbol",)))
    return P.profile_describe_text(P.rounded(d), "symbol")


@query("profile_date_range")
def q_profile_date_range(spark, sf_dir):
    return P.profile_date_range(_profile_wide(spark, sf_dir), "symbol")


@query("profile_combined")
def q_profile_combined(spark, sf_dir):
    return P.rounded(_profile_wide(spark, sf_dir))


@query("profile_schema")
def q_profile_schema(spark, sf_dir):
    return P.profile_schema(profile_input(spark, sf_dir))


@query("quality_verdict")
def q_quality_verdict(spark, sf_dir):
    return P.quality_verdict(_profile_wide(spark, sf_dir))


LINEITEM_PROFILE_GROUP = "l_returnflag"
LINEITEM_PROFILE_DATE = "l_shipdate"


@query("profile_lineitem")
def q_profile_lineitem(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    wide = P.profile_wide(li, LINEITEM_PROFILE_GROUP, LINEITEM_PROFILE_DATE)
    return P.rounded(P.profile_describe(wide, LINEITEM_PROFILE_GROUP, P.numeric_columns(li, (LINEITEM_PROFILE_GROUP,))))


@query("profile_lineitem_nulls")
def q_profile_lineitem_nulls(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    wide = P.profile_wide(li, LINEITEM_PROFILE_GROUP, LINEITEM_PROFILE_DATE)
    return P.profile_nulls(wide, LINEITEM_PROFILE_GROUP, li.columns)


# The profile kept up by days: all but the last are there, then the last one is added.
LAST_DAY = "2024-01-28"


def profile_parts_path(spark: SparkSession, sf_dir: str) -> str:
    def build(path):
        rows = profile_input(spark, sf_dir).withColumn("day", F.substring("Date", 1, 10))
        PP.write_parts(rows.where(F.col("day") < LAST_DAY), path, "symbol", "day", "Date")
        PP.write_parts(rows.where(F.col("day") >= LAST_DAY), path, "symbol", "day", "Date")
    return _cached_path(spark, sf_dir, "profile-parts", build)


@query("profile_by_parts")
def q_profile_by_parts(spark, sf_dir):
    wide = PP.profile(PP.read_parts(spark, profile_parts_path(spark, sf_dir)), "symbol")
    return P.rounded(wide)


@query("profile_report")
def q_profile_report(spark, sf_dir):
    # The report written as a table, a folder a section, and read back.
    df = profile_input(spark, sf_dir)
    path = scratch_path(spark, "profile-report")
    PP.write_report(PP.report(_profile_wide(spark, sf_dir), "symbol", df.dtypes), path)
    rows = PP.read_report(spark, path)
    return rows.withColumn("number", F.when(F.isnan("number"), F.col("number")).otherwise(
        F.bround(F.when(~F.isnan("number"), F.col("number")).cast("decimal(38,12)"), P.STAT_DECIMALS).cast("double")))


# --- keyed table ----------------------------------------------------------------


_STORES: dict[tuple, object] = {}

# Reads of the keyed table: one symbol, a closed date range, a point.
SCAN_SYMBOL = "click"
RANGE_START, RANGE_END = "2024-01-10", "2024-01-20"
POINT_DATE = "2024-01-15 10"


def stored_version(spark: SparkSession, sf_dir: str, version: int) -> SNAP.Snapshot:
    """The stored bars after the first ``version`` changes: 0 enriched, 1 puts, 2 updates, 3 deletes.

    A version is written once per session, from the one before it, so a query
    reads the same rows whichever queries ran before.
    """
    k = (spark.sparkContext.applicationId, sf_dir, "snapshots", version)
    if k not in _STORES:
        if version == 0:
            # the puts add up to a row a tick to the bars
            buckets = SNAP.buckets_for(read_table(spark, sf_dir, "events", ["event_id"]).count())
            _STORES[k] = SNAP.create(enriched(spark, sf_dir), scratch_path(spark, "snapshots"), buckets=buckets)
        else:
            base = stored_version(spark, sf_dir, version - 1)
            _STORES[k] = SNAP.commit(base, _change(spark, sf_dir, base, stored=True))
    return _STORES[k]


def _change(spark: SparkSession, sf_dir: str, base: SNAP.Snapshot, stored: bool = False) -> DataFrame:
    """The rows after ``base``'s next change, not yet stored."""
    if base.version == 0:
        return base.put(bench_puts(spark, sf_dir), stored=stored)
    updates = bench_updates(spark, sf_dir)
    return base.update(updates, "pct_change", stored=stored) if base.version == 1 else base.delete(updates, stored=stored)


def stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_version(spark, sf_dir, 0).frame()


def bench_puts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick as a full-record put on a synthetic benchmark key
    (symbol = event type, date = BENCH key of the event id, seq = event id):
    a one-tick bar. Keys collide, so the latest seq must win."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value"])
    return ev.select(F.col("event_type").alias("symbol"), bench_date_key("event_id").alias("date"),
                     *[F.col("value").alias(c) for c in ("open", "high", "low", "close")],
                     F.lit(1).cast("long").alias("volume"), F.lit(0.0).alias("pct_change"),
                     F.lit(None).cast("double").alias("moving_avg_7"),
                     F.lit(False).alias("is_anomaly"), F.lit(False).alias("volume_spike"),
                     F.col("event_id").alias("seq"))


def bench_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick as SET pct_change on the BENCH key of its user id: some keys
    exist after the puts, some do not (created)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "user_id", "value"])
    return ev.select(F.col("event_type").alias("symbol"), bench_date_key("user_id").alias("date"),
                     round_half_even("value", 2).alias("pct_change"), F.col("event_id").alias("seq"))


@query("full_scan")
def q_full_scan(spark, sf_dir):
    return stored_table(spark, sf_dir)


@query("decimal_sink")
def q_decimal_sink(spark, sf_dir):
    # The exact decimal text the store holds for every numeric attribute.
    d = KS.to_sink_types(enriched(spark, sf_dir))
    return d.select("symbol", "date", *[F.col(c).cast("string").alias(c)
                                        for c in KS.PRICE_COLUMNS + KS.COMPUTED_COLUMNS])


@query("upsert_latest")
def q_upsert_latest(spark, sf_dir):
    return _change(spark, sf_dir, stored_version(spark, sf_dir, 0))


@query("partial_update")
def q_partial_update(spark, sf_dir):
    return _change(spark, sf_dir, stored_version(spark, sf_dir, 1))


@query("delete_by_key")
def q_delete_by_key(spark, sf_dir):
    return _change(spark, sf_dir, stored_version(spark, sf_dir, 2))


@query("delete_by_prefix")
def q_delete_by_prefix(spark, sf_dir):
    # The cleanup covers every symbol of the table (symbols=None), so no
    # symbol list has to be gathered on the driver.
    return stored_version(spark, sf_dir, 3).delete_prefix(BENCH_PREFIX)


@query("symbol_scan")
def q_symbol_scan(spark, sf_dir):
    return stored_version(spark, sf_dir, 1).symbol(SCAN_SYMBOL)


@query("symbol_date_range")
def q_symbol_date_range(spark, sf_dir):
    return stored_version(spark, sf_dir, 1).between(SCAN_SYMBOL, RANGE_START, RANGE_END)


@query("prefix_scan")
def q_prefix_scan(spark, sf_dir):
    return stored_version(spark, sf_dir, 1).prefix(SCAN_SYMBOL, BENCH_PREFIX)


@query("point_lookup")
def q_point_lookup(spark, sf_dir):
    return stored_version(spark, sf_dir, 1).point(SCAN_SYMBOL, POINT_DATE)


@query("snapshot_history")
def q_snapshot_history(spark, sf_dir):
    # Rows and symbols of every stored version, each read as of itself.
    last = stored_version(spark, sf_dir, 3)
    return SNAP.history(spark, last.root).where(F.col("version") <= 3)


# --- ingest: raw files, messages, rejects ----------------------------------------


def _cached_path(spark: SparkSession, sf_dir: str, name: str, writer) -> str:
    k = (spark.sparkContext.applicationId, sf_dir, name)
    if k not in _STORES:
        path = scratch_path(spark, name)
        writer(path)
        _STORES[k] = path
    return _STORES[k]


def bar_files_path(spark: SparkSession, sf_dir: str) -> str:
    """Hourly bars landed as raw text files, one directory per symbol."""
    return _cached_path(spark, sf_dir, "bar-files", lambda p: BF.write_bar_files(bars(spark, sf_dir), p))


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BF.scan_bar_files(spark, bar_files_path(spark, sf_dir)).select(*RAW_BAR_COLUMNS)


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed rows (ticker rows included) as JSON messages."""
    return MSG.encode(raw_rows(spark, sf_dir))


@query("csv_scan_clean")
def q_csv_scan_clean(spark, sf_dir):
    return BF.clean_bars(BF.scan_bar_files(spark, bar_files_path(spark, sf_dir)))


@query("multi_file_scan")
def q_multi_file_scan(spark, sf_dir):
    # One path per symbol file (listed from storage metadata, no job), checked
    # for existence, then all read by a single scan.
    root = bar_files_path(spark, sf_dir)
    paths = BF.existing_paths(spark, [f"{root}/{d}" for d in sorted(child_dirs(spark, root, BF.FILE_SYMBOL + "="))])
    return BF.clean_bars(BF.scan_bar_files(spark, paths))


@query("partitioned_roundtrip")
def q_partitioned_roundtrip(spark, sf_dir):
    path = _cached_path(spark, sf_dir, "bars-by-symbol",
                        lambda p: bars(spark, sf_dir).repartitionByRange("symbol", "date")
                        .write.mode("overwrite").partitionBy("symbol").parquet(p))
    return KS.read_by_symbol(spark, path).select(*BAR_COLUMNS)


@query("numeric_row_filter")
def q_numeric_row_filter(spark, sf_dir):
    return BF.numeric_rows(raw_rows(spark, sf_dir))


@query("numeric_coerce")
def q_numeric_coerce(spark, sf_dir):
    return BF.coerce_numeric(raw_rows(spark, sf_dir))


@query("json_encode")
def q_json_encode(spark, sf_dir):
    # Published messages read back field by field as text.
    m = published(spark, sf_dir).select(F.from_json("value", "map<string,string>").alias("m"))
    return m.select(*[F.col("m")[c].alias(c) for c in RAW_BAR_COLUMNS])


@query("json_decode")
def q_json_decode(spark, sf_dir):
    valid, _ = VAL.validate_split(published(spark, sf_dir))
    return valid


@query("validate_split")
def q_validate_split(spark, sf_dir):
    _, rejects = VAL.validate_split(published(spark, sf_dir))
    return rejects


@query("date_parse")
def q_date_parse(spark, sf_dir):
    # Strict parse (ANSI: a malformed date fails the query, like the analysis
    # step); shown as days since the epoch and the re-rendered ISO date.
    b = bars(spark, sf_dir, grain="day")
    d = F.to_date("date", "yyyy-MM-dd")
    return b.select("symbol", "date", F.datediff(d, F.lit("1970-01-01").cast("date")).cast("long").alias("epoch_day"),
                    F.date_format(d, "yyyy-MM-dd").alias("iso_date"))


# --- streaming --------------------------------------------------------------------

ROWS_PER_BATCH = 4096
RESTART_AT = "2024-01-16"  # messages before it are there when the stream first runs


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published messages in arrival order (``at``): the ticker rows, then the bars by date."""
    raw = BF.with_ticker_rows(BF.raw_bar_rows(bars(spark, sf_dir)))
    return raw.select(F.to_json(F.struct(*RAW_BAR_COLUMNS), {"ignoreNullFields": "false"}).alias("value"), F.coalesce("Date", F.lit("")).alias("at"))


def message_log_path(spark: SparkSession, sf_dir: str) -> str:
    return _cached_path(spark, sf_dir, "messages", lambda p: ML.append(_arrivals(spark, sf_dir), p, ["at"]))


def _classified(spark: SparkSession, log: str, checkpoint: str) -> DataFrame:
    return VAL.classify(ML.stream(spark, log, ROWS_PER_BATCH, checkpoint))


def _valid_stream(spark: SparkSession, log: str, checkpoint: str) -> DataFrame:
    return VAL.valid_part(_classified(spark, log, checkpoint), ["seq"])


def _to_files(stream: DataFrame, out: str, checkpoint: str) -> str:
    ML.drain(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append"))
    return out


def _run_to_files(spark: SparkSession, sf_dir: str, name: str, make) -> str:
    """Run ``make(log, checkpoint)`` over the whole log into files of its own."""
    out, ckpt = scratch_path(spark, name), scratch_path(spark, name + "-ckpt")
    return _to_files(make(spark, message_log_path(spark, sf_dir), ckpt), out, ckpt)


@query("stream_decode")
def q_stream_decode(spark, sf_dir):
    out = _run_to_files(spark, sf_dir, "stream-decode", _valid_stream)
    return spark.read.parquet(out).select(*BAR_COLUMNS)


@query("stream_rejects")
def q_stream_rejects(spark, sf_dir):
    out = _run_to_files(spark, sf_dir, "stream-rejects", lambda *a: VAL.reject_part(_classified(*a)))
    return spark.read.parquet(out).select("raw", "reason")


@query("stream_enrich")
def q_stream_enrich(spark, sf_dir):
    out = _run_to_files(spark, sf_dir, "stream-enrich", lambda *a: ST.stream_enrich(_valid_stream(*a)))
    return spark.read.parquet(out).select(*ENRICHED_COLUMNS)


def _restarted(spark: SparkSession, sf_dir: str) -> str:
    """Enrichment stopped after the first part of the messages and started again when the rest had come; its folder."""
    def run(path):
        log, out, ckpt = f"{path}/log", f"{path}/out", f"{path}/ckpt"
        early = F.col("at") < RESTART_AT
        for part in (early, ~early):
            ML.append(_arrivals(spark, sf_dir).where(part), log, ["at"])
            _to_files(ST.stream_enrich(_valid_stream(spark, log, ckpt)), out, ckpt)
    return _cached_path(spark, sf_dir, "restart", run)


@query("stream_restart")
def q_stream_restart(spark, sf_dir):
    return spark.read.parquet(f"{_restarted(spark, sf_dir)}/out").select(*ENRICHED_COLUMNS)


@query("stream_state")
def q_stream_state(spark, sf_dir):
    # What the stopped stream would go on from, read from its state store: the last 7 bars of a symbol.
    return ST.stored_state(spark, f"{_restarted(spark, sf_dir)}/ckpt").select("symbol", F.col("place").cast("long").alias("place"), "close", "volume")


@query("stream_upsert")
def q_stream_upsert(spark, sf_dir):
    root, ckpt = scratch_path(spark, "live-table"), scratch_path(spark, "live-table-ckpt")
    valid = _valid_stream(spark, message_log_path(spark, sf_dir), ckpt)
    ML.drain(ST.stream_enrich(valid).writeStream.foreachBatch(SK.upsert_sink(root)).option("checkpointLocation", ckpt))
    return SK.read_live_table(spark, root)


# --- rollups ----------------------------------------------------------------------


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick table read as a timing table: op = event type, elapsed_ms = value."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    return ev.select(F.col("event_type").alias("op"), F.col("value").alias("elapsed_ms"), "ts", "event_id")


@query("latency_summary")
def q_latency_summary(spark, sf_dir):
    return R.latency_summary(timings(spark, sf_dir))


@query("batch_assign")
def q_batch_assign(spark, sf_dir):
    # The enriched table written in per-symbol batches of 25 rows, date order.
    e = enriched(spark, sf_dir).select("symbol", "date")
    return R.batch_summary(e, ["symbol"], ["date"], bucket=F.substring("date", 1, 7))


@query("batch_throughput")
def q_batch_throughput(spark, sf_dir):
    # Ticks of one op can be a large share of all rows: rank them inside
    # nested (hour, second) buckets so no window spans a whole op or day.
    return R.batch_throughput(timings(spark, sf_dir), ["ts", "event_id"],
                              buckets=[bar_date("ts", "hour"), F.substring(F.col("ts").cast("string"), 1, 19)])


@query("stream_enrich_bucketed")
def q_stream_enrich_bucketed(spark, sf_dir):
    # Same rows as stream_enrich; each micro-batch runs the skew-safe window
    # plan over (saved tails + batch) instead of a per-symbol state fold.
    state, out, ckpt = (scratch_path(spark, n) for n in ("enrich-state", "enrich-out", "enrich-ckpt"))
    valid = _valid_stream(spark, message_log_path(spark, sf_dir), ckpt)
    ML.drain(valid.writeStream.foreachBatch(SB.bucketed_sink(state, out)).option("checkpointLocation", ckpt))
    return SB.read_output(spark, out)


@query("latency_floored_mean")
def q_latency_floored_mean(spark, sf_dir):
    # The mean over the ops' average times, floored.
    return R.floored_mean(R.latency_summary(timings(spark, sf_dir)), "avg_ms")


@query("batch_record_time")
def q_batch_record_time(spark, sf_dir):
    return R.record_time(timings(spark, sf_dir))


@query("stored_summary")
def q_stored_summary(spark, sf_dir):
    # The analysis as the reference runs it: over the table read back from the store.
    return A.summary_totals(stored_table(spark, sf_dir))


@query("stored_anomaly_counts")
def q_stored_anomaly_counts(spark, sf_dir):
    return A.anomaly_counts(stored_table(spark, sf_dir))


@query("profile_csv")
def q_profile_csv(spark, sf_dir):
    # Scan, clean and profile of the landed text files, together.
    c = BF.clean_bars(BF.scan_bar_files(spark, bar_files_path(spark, sf_dir)))
    df = c.select(c.date.alias("Date"), c.close.alias("Close"), c.high.alias("High"), c.low.alias("Low"),
                  c.open.alias("Open"), c.volume.cast("double").alias("Volume"), "symbol")
    return P.rounded(P.profile_describe(P.profile_wide(df, "symbol"), "symbol", P.numeric_columns(df, ("symbol",))))
