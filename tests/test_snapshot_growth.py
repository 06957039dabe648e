"""The stored table grows by buckets of a bounded size, and a commit converts no row that it does not change."""

from pyspark.sql import functions as F

from tidemark.plans import catalog as C
from tidemark.sources import snapshots as S
from tidemark.sources.keyed_store import from_sink_types

from paths import SF_SMOKE


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_buckets_grow_with_the_table(spark, monkeypatch):
    C._STORES.clear()
    want = {n: _rows(C.QUERIES[n](spark, SF_SMOKE)) for n in ("full_scan", "delete_by_key", "delete_by_prefix")}
    assert C.stored_version(spark, SF_SMOKE, 3).buckets == S.BUCKETS
    C._STORES.clear()
    ticks = spark.read.parquet(f"{SF_SMOKE}/events.parquet").count()
    monkeypatch.setattr(S, "BUCKET_ROWS", ticks // 10)
    assert C.stored_version(spark, SF_SMOKE, 3).buckets >= 10
    assert want == {n: _rows(C.QUERIES[n](spark, SF_SMOKE)) for n in want}
    C._STORES.clear()


def test_a_change_in_stored_types_has_the_same_rows(spark):
    C._STORES.clear()
    for version in range(3):
        base = C.stored_version(spark, SF_SMOKE, version)
        plain, stored = (C._change(spark, SF_SMOKE, base, stored=s) for s in (False, True))
        assert dict(stored.dtypes)["open"] == "decimal(38,18)" and dict(plain.dtypes)["open"] == "double"
        assert _rows(from_sink_types(stored)) == _rows(plain)
        plan = stored._jdf.queryExecution().optimizedPlan().toString()
        assert "as double" not in plan
        assert _rows(C.stored_version(spark, SF_SMOKE, version + 1).frame()) == _rows(plain)
    C._STORES.clear()
