"""Physical-plan shape: one shuffle of the bars for the enrichment, hash
aggregation for bars, pushed filters and partition pruning on reads."""

from tidemark.plans.catalog import QUERIES, bars, enriched

from paths import SF_SMOKE


def _plan(df):
    """The executed (AQE final) plan, without the initial-plan section."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_bars_use_hash_aggregation(spark):
    p = bars(spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_enrich_shuffles_bars_once(spark):
    p = _plan(enriched(spark, SF_SMOKE, bucket_chars=10))
    # the tick aggregate and the bars exchange each run once; the other
    # branches reuse them
    assert p.count("Exchange hashpartitioning(symbol") >= 1
    assert "ReusedExchange" in p
    assert p.count("Scan parquet") == 1 or p.count("FileScan parquet") == 1


def test_range_read_prunes_partitions_and_pushes_filters(spark):
    df = QUERIES["symbol_date_range"](spark, SF_SMOKE)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in p and "isnotnull(symbol" in p
    assert "PushedFilters" in p and "GreaterThanOrEqual(date" in p


def test_profile_single_scan(spark):
    p = QUERIES["profile_combined"](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in p and "profile-groups" in p


ROW_LOCAL = ["price_anomaly", "anomaly_points", "anomaly_counts", "most_volatile", "series_close", "distinct_symbols"]


def test_row_local_analysis_has_no_window(spark):
    for name in ROW_LOCAL:
        p = _plan(QUERIES[name](spark, SF_SMOKE))
        assert "Window" not in p, name
        assert p.count("FileScan parquet") == 1, name


def test_bounded_acquisition_pushes_its_range(spark):
    p = QUERIES["ohlcv_bars_range"](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in p and "LessThan(ts" in p


def test_no_module_is_read_from_conftest():
    # two folders have a conftest, so its names depend on which was imported first; a module that reads it may not collect
    import pathlib
    here = pathlib.Path(__file__).parent
    assert not [p.name for p in here.rglob("test_*.py") if "from conf" + "test import" in p.read_text()]
