"""DuckDB SQL that states each catalog query independently of Spark.

The tables ``events``, ``orders``, ``lineitem``, ... are views over the same
Parquet files. Column names and types follow the Spark results exactly.
"""

from __future__ import annotations

GRAIN_SQL = {"day": "%Y-%m-%d", "hour": "%Y-%m-%d %H", "minute": "%Y-%m-%d %H:%M"}
SYMBOL_SQL = {"event_type": "event_type", "user_id": "CAST(user_id AS VARCHAR)"}


def bars_sql(symbol: str = "event_type", grain: str = "hour") -> str:
    return f"""SELECT {SYMBOL_SQL[symbol]} AS symbol, strftime(ts, '{GRAIN_SQL[grain]}') AS date,
  arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, (ts, event_id)) AS close, count(*) AS volume
FROM events GROUP BY 1, 2"""


def valid_sql(src: str) -> str:
    return f"""SELECT * FROM ({src}) WHERE isfinite(open) AND isfinite(high) AND isfinite(low)
  AND isfinite(close) AND open <> 0 AND volume IS NOT NULL"""


def enriched_sql(symbol: str = "event_type", grain: str = "hour") -> str:
    return f"""SELECT symbol, date, open, high, low, close, volume,
  round_even((close - open) / open * 100, 2) AS pct_change,
  CASE WHEN count(*) OVER w = 7 THEN round_even(avg(close) OVER w, 2) END AS moving_avg_7,
  abs(round_even((close - open) / open * 100, 2)) > 3 AS is_anomaly,
  volume > 2 * avg(volume) OVER w AS volume_spike
FROM ({valid_sql(bars_sql(symbol, grain))})
WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""


B = bars_sql()
E = enriched_sql()
B_ORDERS = """SELECT o_orderpriority AS symbol, strftime(o_orderdate, '%Y-%m-%d') AS date,
  arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS open, max(o_totalprice) AS high,
  min(o_totalprice) AS low, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS close, count(*) AS volume
FROM orders GROUP BY 1, 2"""


def enrich_over(bars_q: str) -> str:
    return f"""SELECT symbol, date, open, high, low, close, volume,
  round_even((close - open) / open * 100, 2) AS pct_change,
  CASE WHEN count(*) OVER w = 7 THEN round_even(avg(close) OVER w, 2) END AS moving_avg_7,
  abs(round_even((close - open) / open * 100, 2)) > 3 AS is_anomaly,
  volume > 2 * avg(volume) OVER w AS volume_spike
FROM ({valid_sql(bars_q)})
WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""


def with_e(body: str, e: str = E) -> str:
    return f"WITH E AS ({e})\n{body}"


ORACLE: dict[str, str] = {}

# --- bars and indicators ------------------------------------------------------
ORACLE["ohlcv_bars"] = B
ORACLE["ohlcv_bars_daily"] = bars_sql(grain="day")
ORACLE["pct_change"] = f"""SELECT symbol, date, open, close,
  round_even((close - open) / nullif(open, 0) * 100, 2) AS pct_change FROM ({B})"""
ORACLE["price_anomaly"] = with_e("SELECT symbol, date, pct_change, is_anomaly FROM E")
ORACLE["moving_avg_7"] = with_e("SELECT symbol, date, close, moving_avg_7 FROM E")
ORACLE["volume_spike"] = with_e("SELECT symbol, date, volume, volume_spike FROM E")
ORACLE["enrich"] = E
ORACLE["enrich_day_buckets"] = E
ORACLE["enrich_users"] = enriched_sql(symbol="user_id")
ORACLE["enrich_rejects"] = f"""SELECT symbol, date, open, volume, CASE WHEN open = 0 THEN 'zero_open' ELSE 'bad_number' END AS reason
FROM ({bars_sql(symbol="user_id")}) WHERE NOT (isfinite(open) AND isfinite(high) AND isfinite(low) AND isfinite(close) AND open <> 0)"""
ORACLE["ohlcv_bars_range"] = bars_sql().replace("FROM events", "FROM events WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'")
ORACLE["enrich_daily"] = enriched_sql(grain="day")
ORACLE["ohlcv_bars_orders"] = B_ORDERS
ORACLE["enrich_orders"] = enrich_over(B_ORDERS)

# --- analysis result sets -----------------------------------------------------
ORACLE["series_close"] = with_e("SELECT symbol, date, close FROM E")
ORACLE["series_close_vs_ma"] = with_e("SELECT date, close, moving_avg_7 FROM E WHERE symbol = 'click'")
ORACLE["anomaly_points"] = with_e("SELECT symbol, date, close FROM E WHERE is_anomaly")
ORACLE["spike_points"] = with_e("SELECT symbol, date, volume FROM E WHERE volume_spike")
ORACLE["anomaly_counts"] = with_e(
    "SELECT symbol, count(*) AS anomalies FROM E WHERE is_anomaly GROUP BY symbol ORDER BY anomalies DESC, symbol")
ORACLE["most_volatile"] = with_e(
    "SELECT symbol, count(*) AS anomalies FROM E WHERE is_anomaly GROUP BY symbol "
    "ORDER BY anomalies DESC, symbol LIMIT 1")
ORACLE["summary_totals"] = with_e(
    "SELECT count(*) AS total_records, CAST(count(*) FILTER (WHERE is_anomaly) AS BIGINT) AS total_anomalies, "
    "CAST(count(*) FILTER (WHERE volume_spike) AS BIGINT) AS total_spikes FROM E")
ORACLE["distinct_symbols"] = with_e("SELECT DISTINCT symbol FROM E")
ORACLE["sort_symbol_date"] = with_e(
    "SELECT row_number() OVER (ORDER BY symbol, date) AS pos, symbol, date, close FROM E")


# --- profile ------------------------------------------------------------------
PROFILE_INPUT = f"""SELECT date AS "Date", close AS "Close", high AS "High", low AS "Low", open AS "Open",
  CAST(volume AS DOUBLE) AS "Volume", symbol FROM ({B})"""
PROFILE_COLUMNS = [("Date", "str"), ("Close", "dbl"), ("High", "dbl"), ("Low", "dbl"), ("Open", "dbl"),
                   ("Volume", "dbl"), ("symbol", "str")]

LINEITEM_COLUMNS = [("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"), ("l_linenumber", "int"),
                    ("l_quantity", "dbl"), ("l_extendedprice", "dbl"), ("l_discount", "dbl"), ("l_tax", "dbl"),
                    ("l_returnflag", "str"), ("l_linestatus", "str"), ("l_shipdate", "ts")]


def _q(c: str) -> str:
    return f'"{c}"'


def _exact_sum(c: str, k: str) -> str:
    """Sum as whole part + millionths, both exact integer sums, in double."""
    if k != "dbl":
        return f"CAST(sum({_q(c)}) AS DOUBLE)"
    return (f"(CAST(sum(CAST(floor({_q(c)}) AS BIGINT)) AS DOUBLE) + "
            f"CAST(sum(CAST(round(({_q(c)} - floor({_q(c)})) * 1000000) AS BIGINT)) AS DOUBLE) / 1000000.0)")


def profile_wide_sql(src: str, cols: list[tuple[str, str]], group: str, date_col: str) -> str:
    parts = ["count(*) AS row_count"]
    nulls = []
    for c, k in cols:
        pred = f"({_q(c)} IS NULL OR isnan({_q(c)}))" if k == "dbl" else f"{_q(c)} IS NULL"
        parts.append(f"CAST(sum(CASE WHEN {pred} THEN 1 ELSE 0 END) AS BIGINT) AS {_q('nulls__' + c)}")
        nulls.append(f"CAST(sum(CASE WHEN {pred} THEN 1 ELSE 0 END) AS BIGINT)")
    for c, k in cols:
        if k in ("dbl", "int") and c != group:
            parts += [f"count({_q(c)}) AS {_q('count__' + c)}",
                      f"CAST(round_even(CAST({_exact_sum(c, k)} / count({_q(c)}) AS DECIMAL(38,12)), 6) AS DOUBLE)"
                      f" AS {_q('mean__' + c)}",
                      f"round_even(stddev_samp({_q(c)}), 6) AS {_q('stddev__' + c)}",
                      f"CAST(min({_q(c)}) AS DOUBLE) AS {_q('min__' + c)}",
                      f"CAST(max({_q(c)}) AS DOUBLE) AS {_q('max__' + c)}"]
    parts += [f"CAST(min({_q(date_col)}) AS VARCHAR) AS date_min",
              f"CAST(max({_q(date_col)}) AS VARCHAR) AS date_max",
              f"CAST(grouping({_q(group)}) AS INT) AS is_total",
              "CAST(" + " + ".join(nulls) + " AS BIGINT) AS total_nulls"]
    return (f"SELECT {_q(group)}, " + ",\n  ".join(parts) +
            f"\nFROM ({src}) GROUP BY GROUPING SETS (({_q(group)}), ())")


def profile_nulls_sql(wide: str, cols: list[tuple[str, str]], group: str) -> str:
    sel = [f"SELECT {_q(group)}, is_total, '{c}' AS \"column\", {_q('nulls__' + c)} AS nulls FROM W"
           for c, _ in cols]
    return f"WITH W AS ({wide})\n" + "\nUNION ALL ".join(sel)


def profile_describe_sql(wide: str, cols: list[tuple[str, str]], group: str) -> str:
    sel = [f"SELECT {_q(group)}, is_total, '{c}' AS \"column\", {_q('count__' + c)} AS count, "
           f"CAST({_q('mean__' + c)} AS DOUBLE) AS mean, CAST({_q('stddev__' + c)} AS DOUBLE) AS stddev, "
           f"{_q('min__' + c)} AS min, {_q('max__' + c)} AS max FROM W"
           for c, k in cols if k in ("dbl", "int") and c != group]
    return f"WITH W AS ({wide})\n" + "\nUNION ALL ".join(sel)


PW = profile_wide_sql(PROFILE_INPUT, PROFILE_COLUMNS, "symbol", "Date")
ORACLE["profile_combined"] = PW
ORACLE["profile_counts"] = f"SELECT symbol, is_total, row_count, total_nulls FROM ({PW})"
ORACLE["profile_nulls"] = profile_nulls_sql(PW, PROFILE_COLUMNS, "symbol")
ORACLE["profile_describe"] = profile_describe_sql(PW, PROFILE_COLUMNS, "symbol")
ORACLE["profile_date_range"] = f"SELECT symbol, is_total, date_min, date_max FROM ({PW})"
ORACLE["quality_verdict"] = (f"SELECT row_count, total_nulls, CASE WHEN row_count > 0 AND total_nulls = 0 "
                             f"THEN 'PASS' ELSE 'FAIL' END AS verdict FROM ({PW}) WHERE is_total = 1")
_SPARK_TYPE = {"str": "string", "dbl": "double", "int": "bigint"}
ORACLE["profile_schema"] = "\nUNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS \"column\", '{_SPARK_TYPE[k]}' AS type FROM (SELECT 1 FROM ({B}) LIMIT 1)"
    for i, (c, k) in enumerate(PROFILE_COLUMNS))
LW = profile_wide_sql("SELECT * FROM lineitem", LINEITEM_COLUMNS, "l_returnflag", "l_shipdate")
ORACLE["profile_lineitem"] = profile_describe_sql(LW, LINEITEM_COLUMNS, "l_returnflag")
ORACLE["profile_lineitem_nulls"] = profile_nulls_sql(LW, LINEITEM_COLUMNS, "l_returnflag")


# --- keyed table ----------------------------------------------------------------
def bench_key_sql(col: str) -> str:
    return f"printf('BENCH-2019-%02d-%02d', {col} // 30 + 1, {col} % 28 + 1)"


ECOLS = "symbol, date, open, high, low, close, volume, pct_change, moving_avg_7, is_anomaly, volume_spike"
PUTS = f"""SELECT event_type AS symbol, {bench_key_sql('event_id')} AS date,
  arg_max(value, event_id) AS open, arg_max(value, event_id) AS high, arg_max(value, event_id) AS low,
  arg_max(value, event_id) AS close, CAST(1 AS BIGINT) AS volume, 0.0::DOUBLE AS pct_change,
  CAST(NULL AS DOUBLE) AS moving_avg_7, false AS is_anomaly, false AS volume_spike
FROM events GROUP BY 1, 2"""
T1 = f"SELECT {ECOLS} FROM E WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM P) UNION ALL SELECT * FROM P"
UPD = f"""SELECT event_type AS symbol, {bench_key_sql('user_id')} AS date,
  arg_max(round_even(value, 2), event_id) AS pct_change FROM events GROUP BY 1, 2"""
T2 = f"""SELECT coalesce(t.symbol, u.symbol) AS symbol, coalesce(t.date, u.date) AS date,
  t.open, t.high, t.low, t.close, t.volume,
  CASE WHEN u.symbol IS NOT NULL THEN u.pct_change ELSE t.pct_change END AS pct_change,
  t.moving_avg_7, t.is_anomaly, t.volume_spike
FROM T1 t FULL OUTER JOIN U u ON t.symbol = u.symbol AND t.date = u.date"""
T3 = "SELECT * FROM T2 t WHERE NOT EXISTS (SELECT 1 FROM U u WHERE u.symbol = t.symbol AND u.date = t.date)"
KEYED = f"WITH E AS ({E}), P AS ({PUTS}), T1 AS ({T1}), U AS ({UPD}), T2 AS ({T2}), T3 AS ({T3})\n"

ORACLE["full_scan"] = E
ORACLE["decimal_sink"] = with_e(
    "SELECT symbol, date, " + ", ".join(
        f"CAST(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,18)) AS VARCHAR) AS {c}" for c in ("open", "high", "low", "close"))
    + ", " + ", ".join(f"CAST(CAST(CAST({c} AS VARCHAR) AS DECIMAL(18,2)) AS VARCHAR) AS {c}"
                       for c in ("pct_change", "moving_avg_7")) + " FROM E")
ORACLE["upsert_latest"] = KEYED + "SELECT * FROM T1"
ORACLE["partial_update"] = KEYED + "SELECT * FROM T2"
ORACLE["delete_by_key"] = KEYED + "SELECT * FROM T3"
ORACLE["delete_by_prefix"] = KEYED + "SELECT * FROM T3 WHERE NOT starts_with(date, 'BENCH-')"
ORACLE["symbol_scan"] = KEYED + "SELECT * FROM T1 WHERE symbol = 'click'"
ORACLE["symbol_date_range"] = KEYED + "SELECT * FROM T1 WHERE symbol = 'click' AND date BETWEEN '2024-01-10' AND '2024-01-20'"
ORACLE["prefix_scan"] = KEYED + "SELECT * FROM T1 WHERE symbol = 'click' AND starts_with(date, 'BENCH-')"
_LATER = {0: "E", 1: "T1", 2: "T2", 3: "T3"}
ORACLE["snapshot_history"] = KEYED + " UNION ALL ".join(
    f"SELECT CAST({v} AS BIGINT) AS version, count(*) AS rows, count(DISTINCT symbol) AS symbols FROM {t}" for v, t in _LATER.items())
ORACLE["point_lookup"] = KEYED + "SELECT * FROM T1 WHERE symbol = 'click' AND date = '2024-01-15 10'"


# --- ingest ---------------------------------------------------------------------
RAW = f"""SELECT date AS "Date", CAST(close AS VARCHAR) AS "Close", CAST(high AS VARCHAR) AS "High",
  CAST(low AS VARCHAR) AS "Low", CAST(open AS VARCHAR) AS "Open", CAST(volume AS VARCHAR) AS "Volume", symbol
FROM ({B})"""
TICKER = f"""SELECT CAST(NULL AS VARCHAR) AS "Date", symbol AS "Close", symbol AS "High", symbol AS "Low",
  symbol AS "Open", symbol AS "Volume", CAST(NULL AS VARCHAR) AS symbol FROM (SELECT DISTINCT symbol FROM ({B}))"""
RAW_ALL = f"{RAW} UNION ALL {TICKER}"
BAR_COLS_SQL = "symbol, date, open, high, low, close, volume"

ORACLE["csv_scan_clean"] = f"SELECT {BAR_COLS_SQL} FROM ({B})"
ORACLE["multi_file_scan"] = ORACLE["csv_scan_clean"]
ORACLE["partitioned_roundtrip"] = ORACLE["csv_scan_clean"]
ORACLE["numeric_row_filter"] = f"SELECT * FROM ({RAW_ALL}) WHERE regexp_matches(\"Close\", '^-?\\d+(\\.\\d+)?$')"
ORACLE["numeric_coerce"] = f"""SELECT "Date", TRY_CAST("Close" AS DOUBLE) AS "Close", TRY_CAST("High" AS DOUBLE) AS "High",
  TRY_CAST("Low" AS DOUBLE) AS "Low", TRY_CAST("Open" AS DOUBLE) AS "Open", TRY_CAST("Volume" AS DOUBLE) AS "Volume",
  symbol FROM ({RAW_ALL})"""
ORACLE["json_encode"] = RAW_ALL
ORACLE["json_decode"] = f"SELECT {BAR_COLS_SQL} FROM ({valid_sql(B)})"
_JSON_TEXT = ("'{\"Date\":' || coalesce('\"' || \"Date\" || '\"', 'null') || ',\"Close\":\"' || \"Close\" || "
              "'\",\"High\":\"' || \"High\" || '\",\"Low\":\"' || \"Low\" || '\",\"Open\":\"' || \"Open\" || "
              "'\",\"Volume\":\"' || \"Volume\" || '\",\"symbol\":' || coalesce('\"' || symbol || '\"', 'null') || '}'")
ORACLE["validate_split"] = f"""SELECT {_JSON_TEXT} AS raw,
  CASE WHEN TRY_CAST("Open" AS DOUBLE) IS NULL THEN 'bad_number' ELSE 'zero_open' END AS reason
FROM ({RAW_ALL}) WHERE TRY_CAST("Open" AS DOUBLE) IS NULL OR TRY_CAST("Open" AS DOUBLE) = 0"""
ORACLE["date_parse"] = (f"SELECT symbol, date, CAST(date_diff('day', DATE '1970-01-01', CAST(strptime(date, '%Y-%m-%d') AS DATE)) AS BIGINT) AS epoch_day, "
                        f"strftime(CAST(strptime(date, '%Y-%m-%d') AS DATE), '%Y-%m-%d') AS iso_date FROM ({bars_sql(grain='day')})")


# --- streaming ------------------------------------------------------------------
ORACLE["stream_decode"] = ORACLE["json_decode"]
ORACLE["stream_rejects"] = ORACLE["validate_split"]
ORACLE["stream_enrich"] = E
ORACLE["stream_upsert"] = E
ORACLE["stream_restart"] = E
ORACLE["stream_state"] = f"""SELECT symbol, CAST(least(7, n) - r AS BIGINT) AS place, close, volume
FROM (SELECT symbol, close, volume, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS r, count(*) OVER (PARTITION BY symbol) AS n FROM ({valid_sql(B)}))
WHERE r <= 7"""


# --- rollups ----------------------------------------------------------------------
def _r(x: str, scale: int) -> str:
    return f"CAST(round_even(CAST({x} AS DECIMAL(38,12)), {scale}) AS DOUBLE)"


_MEAN = "(CAST(sum(CAST(value AS DECIMAL(38,10))) AS DOUBLE) / count(value))"
ORACLE["latency_summary"] = f"""SELECT event_type AS op, count(*) AS calls, {_r(_MEAN, 1)} AS avg_ms,
  {_r('min(value)', 1)} AS min_ms, {_r('max(value)', 1)} AS max_ms, {_r('1000.0 / ' + _MEAN, 1)} AS throughput,
  CAST(floor({_MEAN}) AS BIGINT) AS floor_mean_ms FROM events GROUP BY 1"""
ORACLE["batch_assign"] = with_e("""SELECT symbol, CAST((rn - 1) // 25 AS BIGINT) AS batch, count(*) AS records,
  min(date) AS first_date, max(date) AS last_date
FROM (SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM E) GROUP BY 1, 2""")
_TOT = "CAST(sum(ms) AS DOUBLE)"
ORACLE["batch_throughput"] = f"""WITH Rr AS (SELECT event_type AS op, value,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events),
  Bt AS (SELECT op, (rn - 1) // 25 AS batch, count(*) AS n, sum(CAST(value AS DECIMAL(38,10))) AS ms
    FROM Rr GROUP BY 1, 2)
SELECT op, CAST(sum(n) AS BIGINT) AS records, count(*) AS batches, {_r(_TOT, 0)} AS total_ms,
  {_r(_TOT + ' / count(*)', 0)} AS avg_batch_ms, {_r('min(ms)', 1)} AS min_batch_ms, {_r('max(ms)', 1)} AS max_batch_ms,
  {_r('sum(n) / (' + _TOT + ' / 1000.0)', 1)} AS records_per_sec
FROM Bt GROUP BY op"""

_DESC = profile_describe_sql(PW, PROFILE_COLUMNS, "symbol")
ORACLE["profile_describe_text"] = f"WITH D AS ({_DESC})\n" + "\nUNION ALL ".join(
    f"SELECT symbol, is_total, \"column\", '{st}' AS stat, coalesce(CAST({st} AS VARCHAR), 'N/A') AS value FROM D"
    for st in ("count", "mean", "stddev", "min", "max"))
ORACLE["stream_enrich_bucketed"] = E

# --- over the stored table and the landed files; further rollups --------------
ORACLE["stored_summary"] = ORACLE["summary_totals"]
ORACLE["stored_anomaly_counts"] = ORACLE["anomaly_counts"]
ORACLE["profile_csv"] = ORACLE["profile_describe"]
ORACLE["latency_floored_mean"] = f"""SELECT CAST(floor(avg(avg_ms)) AS BIGINT) AS floor_mean
FROM (SELECT event_type AS op, {_r(_MEAN, 1)} AS avg_ms FROM events GROUP BY 1)"""
ORACLE["batch_record_time"] = f"""SELECT event_type AS op, count(*) AS records, {_r(_MEAN, 1)} AS avg_record_ms FROM events GROUP BY 1"""

ORACLE["profile_by_parts"] = ORACLE["profile_combined"]


def profile_report_sql() -> str:
    """The lines of the profile report, section by section."""
    def line(section, item, stat, number="NULL", text="NULL", grp="symbol", where=""):
        item = f"'{item}'" if item else "CAST(NULL AS VARCHAR)"
        return (f"SELECT '{section}' AS section, {grp} AS grp, is_total, {item} AS item, '{stat}' AS stat, "
                f"CAST({number} AS DOUBLE) AS number, CAST({text} AS VARCHAR) AS text FROM W{where}")
    rounded = lambda s, c: f"round_even(CAST({_q(s + '__' + c)} AS DECIMAL(38,12)), 6)"
    out = [line("counts", None, s, s) for s in ("row_count", "total_nulls")]
    out += [line("nulls", c, "nulls", _q("nulls__" + c)) for c, _ in PROFILE_COLUMNS]
    out += [line("describe", c, s, rounded(s, c)) for c, k in PROFILE_COLUMNS if k == "dbl" for s in ("count", "mean", "stddev", "min", "max")]
    out += [line("dates", None, s, text=s) for s in ("date_min", "date_max")]
    none, total = "CAST(NULL AS VARCHAR)", " WHERE is_total = 1"
    out += [line("verdict", None, "verdict", text="CASE WHEN row_count > 0 AND total_nulls = 0 THEN 'PASS' ELSE 'FAIL' END", grp=none, where=total)]
    out += [line("schema", c, "schema", str(i), f"'{_SPARK_TYPE[k]}'", none, total) for i, (c, k) in enumerate(PROFILE_COLUMNS, 1)]
    return f"WITH W AS ({PW})\n" + "\nUNION ALL ".join(out)


ORACLE["profile_report"] = profile_report_sql()
