"""Analysis result sets: cross-query properties and ordering positions."""

from pyspark.sql import functions as F

from tidemark.operators import analysis as A
from tidemark.plans.catalog import enriched

from paths import SF_SMALL


def test_anomaly_counts_sum_to_summary(spark):
    e = enriched(spark, SF_SMALL)
    total = A.summary_totals(e).collect()[0]
    counts = A.anomaly_counts(e).collect()
    assert sum(r.anomalies for r in counts) == total.total_anomalies
    assert [r.anomalies for r in counts] == sorted((r.anomalies for r in counts), reverse=True)
    top = A.most_volatile(e).collect()
    assert top[0].anomalies == counts[0].anomalies
    assert total.total_records == e.count()


def test_positions_are_gap_free_in_order(spark):
    e = enriched(spark, SF_SMALL).select("symbol", "date", "close")
    rows = A.sort_symbol_date(e).collect()
    assert [r.pos for r in rows] == list(range(1, len(rows) + 1))
    assert [(r.symbol, r.date) for r in rows] == sorted((r.symbol, r.date) for r in rows)
    per = A.positions(e, ["date"], within=["symbol"], bucket=F.substring("date", 1, 10)).collect()
    by = {}
    for r in per:
        by.setdefault(r.symbol, []).append((r.date, r.pos))
    for lst in by.values():
        lst.sort()
        assert [p for _, p in lst] == list(range(1, len(lst) + 1))


def test_nested_bucket_positions_on_ticks(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_type", "ts", "event_id")
    text = F.col("ts").cast("string")
    got = A.positions(ev, ["ts", "event_id"], within=["event_type"],
                      buckets=[F.substring(text, 1, 10), F.substring(text, 1, 13), F.substring(text, 1, 19)]).collect()
    by = {}
    for r in got:
        by.setdefault(r.event_type, []).append((r.ts, r.event_id, r.pos))
    for lst in by.values():
        lst.sort()
        assert [p for *_, p in lst] == list(range(1, len(lst) + 1))
