"""First start per device and day (FIXTURES §4 dau-*), latest per key, seen set."""

from hypothesis import given, settings
from hypothesis import strategies as st

from shopstream import schemas as S
from shopstream.operators import dedupe

from .conftest import rows

DAY = 86_400_000
T0 = 1704067200000  # 2024-01-01 00:00:00 UTC


def _dau(spark, recs):
    """recs: (mid, uid, ts) -> DAU-shaped rows."""
    from shopstream.functions import columns as X
    df = spark.createDataFrame(recs, "mid string, uid string, ts long")
    return df.selectExpr("mid", "uid", "'shop' as appid", "'x' as area", "'ios' as os",
                         "'c' as channel", "'startup' as logtype", "'1' as version", "ts") \
             .withColumn("logdate", X.log_date("ts")).withColumn("loghour", X.log_hour("ts"))


def test_dau_basic_earliest(spark):
    d = _dau(spark, [("m", "1", T0 + 500), ("m", "2", T0 + 100), ("m", "3", T0 + 900)])
    out = dedupe.first_per_key(d, dedupe.DAU_KEY, dedupe.DAU_ORDER)
    assert rows(out, "mid", "uid", "ts") == [("m", "2", T0 + 100)]


def test_dau_midnight_two_rows(spark):
    d = _dau(spark, [("m", "1", T0 - 1000), ("m", "1", T0 + 1000)])
    out = dedupe.first_per_key(d, dedupe.DAU_KEY, dedupe.DAU_ORDER)
    assert rows(out, "logdate", "ts") == [("2023-12-31", T0 - 1000), ("2024-01-01", T0 + 1000)]


def test_dau_tie_broken_by_uid(spark):
    d = _dau(spark, [("m", "9", T0), ("m", "3", T0), ("m", "5", T0)])
    out = dedupe.first_per_key(d, dedupe.DAU_KEY, dedupe.DAU_ORDER)
    assert rows(out, "uid") == [("3",)]


def test_dau_late_exact_form(spark):
    first = dedupe.first_per_key(_dau(spark, [("m", "1", T0 + 5000)]), dedupe.DAU_KEY, dedupe.DAU_ORDER)
    late = _dau(spark, [("m", "2", T0 + 10)])
    merged = dedupe.first_per_key(first.unionByName(late), dedupe.DAU_KEY, dedupe.DAU_ORDER)
    assert rows(merged, "uid", "ts") == [("2", T0 + 10)]


def test_new_devices_anti_join(spark):
    seen = _dau(spark, [("a", "1", T0 + 1)])
    batch = _dau(spark, [("a", "1", T0 + 50), ("b", "2", T0 + 60), ("b", "2", T0 + 40),
                         ("a", "1", T0 + DAY + 5)])
    from pyspark.sql import functions as F
    startup = batch.select(F.col("mid"), F.col("uid"), F.col("appid").alias("appId"), "area", "os",
                           "channel", F.col("logtype").alias("logType"), "version", "ts",
                           F.col("logdate").alias("log_date"), F.col("loghour").alias("log_hour"))
    out = dedupe.new_devices(startup, seen)
    assert rows(out, "mid", "logdate", "ts") == [("a", "2024-01-02", T0 + DAY + 5),
                                                 ("b", "2024-01-01", T0 + 40)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, "b"), ("k", 2, "c"), ("j", 1, "d")],
                               "key string, ts int, v string")
    out = dedupe.latest_per_key(df, ["key"], ["ts"])
    assert rows(out) == [("j", 1, "d"), ("k", 3, "b")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["m1", "m2", "m3"]), st.sampled_from(["1", "2"]),
                          st.integers(min_value=0, max_value=3 * DAY)), min_size=1, max_size=30))
def test_first_per_key_idempotent_and_minimal(spark, recs):
    recs = [(m, u, T0 + t) for m, u, t in recs]
    d = _dau(spark, recs)
    once = dedupe.first_per_key(d, dedupe.DAU_KEY, dedupe.DAU_ORDER)
    twice = dedupe.first_per_key(once, dedupe.DAU_KEY, dedupe.DAU_ORDER)
    assert rows(once) == rows(twice)
    got = {(r.mid, r.logdate): (r.ts, r.uid) for r in once.collect()}
    import datetime as dt
    want = {}
    for m, u, t in recs:
        day = dt.datetime.fromtimestamp(t / 1000, dt.timezone.utc).strftime("%Y-%m-%d")
        want[(m, day)] = min(want.get((m, day), (t, u)), (t, u))
    assert got == want
    assert len(S.DAU_COLUMNS) == 11


def test_kpi_filters_reach_the_partitions(spark):
    """The date filter of a KPI prunes the stored tables at the scan."""
    from shopstream.operators import kpi
    from shopstream.plans import queries as Q
    sf = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for frame, col in ((kpi.dau_total(Q.stored_dau(spark, sf), "2024-01-15"), "logdate"),
                       (kpi.amount_total(Q.stored_orders(spark, sf), "1996-06-15"), "create_month")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [isnotnull({col}" in plan, plan


def test_kpis_of_several_days_scan_each_table_once(spark):
    """Two days' KPI lists read each stored table in one pruned scan."""
    from shopstream.plans import queries as Q
    plan = Q.q_kpi_total(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    pruned = [line.split("PartitionFilters: [")[1] for line in plan.split("\n") if "FileScan" in line]
    assert len(pruned) == 2 and pruned[0].startswith("logdate") and pruned[1].startswith("create_month"), plan
