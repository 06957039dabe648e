"""Single-pass profile: null predicate by type, describe, grouping-sets total."""

from pyspark.sql import functions as F

from tidemark.operators import profile as P


def test_profile_groups_and_total(spark):
    df = spark.createDataFrame(
        [("A", "2024-01-01", 1.0, 10), ("A", "2024-01-03", float("nan"), None), ("B", None, 2.0, 7),
         ("B", "2024-01-02", None, 3)], "symbol string, Date string, Close double, Volume long")
    wide = P.profile_wide(df, "symbol")
    rows = {(r.symbol, r.is_total): r for r in wide.collect()}
    a, b, tot = rows[("A", 0)], rows[("B", 0)], rows[(None, 1)]
    assert (a.row_count, a.total_nulls) == (2, 2)          # NaN counts as null for doubles
    assert (b.row_count, b.total_nulls) == (2, 2)          # null Date, null Close
    assert tot.row_count == a.row_count + b.row_count
    assert tot.total_nulls == a.total_nulls + b.total_nulls
    assert (tot.date_min, tot.date_max) == ("2024-01-01", "2024-01-03")
    assert str(a["mean__Close"]) == "nan"                  # describe with NaN gives NaN
    assert b["mean__Volume"] == 5.0 and b["count__Close"] == 1
    desc = P.profile_describe(wide, "symbol", ["Close", "Volume"]).collect()
    assert len(desc) == 6
    assert P.quality_verdict(wide).collect()[0].verdict == "FAIL"


def test_profile_is_one_scan(spark):
    """The source is aggregated once (into the per-group table); the profile
    itself only reads that small table, for the group rows and the total."""
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = P.profile_wide(df, "l_returnflag", "l_shipdate")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan
    assert "profile-groups" in plan
    assert "Expand" not in plan


def test_date_fallback_and_nonzero_nulls(spark):
    df = spark.createDataFrame([("2024-01-02", "A", 1.0), ("2024-01-01", "A", None), ("2024-01-05", "B", 2.0)],
                               "day string, symbol string, Close double")
    assert P.resolve_date_column(df) == "day"           # no 'Date' column: the first column
    wide = P.profile_wide(df, "symbol")
    tot = [r for r in wide.collect() if r.is_total == 1][0]
    assert (tot.date_min, tot.date_max) == ("2024-01-01", "2024-01-05")
    nz = {(r.symbol, r.column): r.nulls for r in P.profile_nulls(wide, "symbol", df.columns, only_nonzero=True)
          .collect()}
    assert nz == {("A", "Close"): 1, (None, "Close"): 1}
    schema = {r.column: r.type for r in P.profile_schema(df).collect()}
    assert schema == {"day": "string", "symbol": "string", "Close": "double"}


def _parts_table(spark, rows):
    return spark.createDataFrame(rows, "symbol string, Date string, Close double, Volume long, day string")


ROWS = [("A", "2024-01-01", 1.0, 10, "1"), ("A", "2024-01-01", 4.5, None, "1"), ("B", None, 2.0, 7, "1"), ("A", "2024-01-02", -3.0, 5, "2"),
        ("C", "2024-01-02", None, None, "2"), (None, "2024-01-02", 8.0, 1, "2"), ("B", "2024-01-03", 1e6, 3, "3"), ("A", "2024-01-03", 2.5, 3, "3")]


def _close(a, b):
    assert len(a) == len(b)
    for x, y in zip(sorted(a, key=lambda r: (r["is_total"], r["symbol"] or "")), sorted(b, key=lambda r: (r["is_total"], r["symbol"] or ""))):
        for k in x.asDict():
            if isinstance(x[k], float) and isinstance(y[k], float):
                assert abs(x[k] - y[k]) <= 1e-9 * max(1, abs(y[k])), k
            else:
                assert x[k] == y[k], k


def test_parts_merge_to_the_profile_of_the_whole(spark):
    from tidemark.operators import profile_parts as PP
    from tidemark.session import scratch_path
    root, df = scratch_path(spark, "test-parts"), _parts_table(spark, ROWS)
    for day in ("2", "1", "3"):
        PP.write_parts(df.where(F.col("day") == day), root, "symbol", "day", "Date")
    want = P.profile_wide(df.drop("day"), "symbol").collect()
    _close(PP.profile(PP.read_parts(spark, root), "symbol").select(*want[0].asDict()).collect(), want)
    # a part written again replaces that part and no other
    again = _parts_table(spark, [("A", "2024-01-02", 100.0, 1, "2")])
    PP.write_parts(again, root, "symbol", "day", "Date")
    want = P.profile_wide(df.where("day <> '2'").unionByName(again).drop("day"), "symbol").collect()
    _close(PP.profile(PP.read_parts(spark, root), "symbol").select(*want[0].asDict()).collect(), want)


def test_no_window_over_all_groups(spark):
    from tidemark.operators import profile_parts as PP
    df = _parts_table(spark, ROWS)
    parts = PP.moments(df, ["symbol", "day"], "Date").withColumnRenamed("day", "part")
    for plan in (PP.profile(parts, "symbol"), P.profile_wide(df.drop("day"), "symbol")):
        assert "Window" not in plan._jdf.queryExecution().executedPlan().toString()


def test_report_is_written_and_read_back(spark):
    from tidemark.operators import profile_parts as PP
    from tidemark.session import scratch_path
    df, path = _parts_table(spark, ROWS).drop("day"), scratch_path(spark, "test-report")
    rows = PP.report(P.profile_wide(df, "symbol"), "symbol", df.dtypes)
    PP.write_report(rows, path)
    got = PP.read_report(spark, path)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, rows.collect()))
    by = {(r["section"], r["grp"], r["is_total"], r["item"], r["stat"]): (r["number"], r["text"]) for r in got.collect()}
    assert by[("counts", None, 1, None, "row_count")] == (8.0, None) and by[("nulls", "A", 0, "Volume", "nulls")] == (1.0, None)
    assert by[("verdict", None, 1, None, "verdict")] == (None, "FAIL") and by[("schema", None, 1, "Close", "schema")] == (3.0, "double")
    assert by[("dates", "A", 0, None, "date_max")] == (None, "2024-01-03")
