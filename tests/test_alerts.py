"""Coupon alerts over sliding windows (FIXTURES §4 alert-*), reference parameters."""

from pyspark.sql import functions as F

from shopstream.operators import alerts
from shopstream.functions import columns as X

T0 = 1704067200000  # aligned to 5 s and to minutes
SEC = 1000


def _events(spark, recs):
    """recs: (mid, uid, eventId, itemId, ts_ms)."""
    df = spark.createDataFrame(recs, "mid string, uid string, eventId string, itemId string, ts long")
    return df.withColumn("event_time", X.event_time("ts"))


def _hits(spark, recs, **kw):
    return alerts.alert_windows(_events(spark, recs), **kw)


def test_alert_hit(spark):
    recs = [("m", str(u), "coupon", "7", T0 + u * SEC) for u in (1, 2, 3)]
    assert _hits(spark, recs).count() > 0


def test_two_uids_many_coupons_no_alert(spark):
    recs = [("m", str(1 + i % 2), "coupon", "7", T0 + i * SEC) for i in range(20)]
    assert _hits(spark, recs).count() == 0


def test_click_blocks_while_in_window(spark):
    recs = [("m", "9", "clickItem", "1", T0)] + \
           [("m", str(u), "coupon", "7", T0 + 10 * SEC + u * SEC) for u in (1, 2, 3)] + \
           [("m", "4", "addCart", "1", T0 + 6 * 60 * SEC)]
    hits = _hits(spark, recs)
    # windows containing the click never alert; later windows with 3 uids do
    click_windows = hits.filter((F.col("window_start_ms") <= T0) & (F.col("window_end_ms") > T0))
    assert click_windows.count() == 0
    assert hits.count() > 0
    assert hits.agg(F.min("window_start_ms")).first()[0] > T0


def test_null_uid_not_counted_unless_compat(spark):
    recs = [("m", "1", "coupon", "7", T0), ("m", "2", "coupon", "7", T0 + SEC),
            ("m", None, "coupon", "7", T0 + 2 * SEC)]
    assert _hits(spark, recs).count() == 0
    assert _hits(spark, recs, count_null_uid=True).count() > 0


def test_other_events_only_listed(spark):
    recs = [("m", str(u), "addCart", "7", T0 + u * SEC) for u in (1, 2, 3)]
    assert _hits(spark, recs).count() == 0
    recs2 = recs + [("m", str(u), "coupon", "8", T0 + (10 + u) * SEC) for u in (4, 5, 6)]
    d = alerts.alert_details(_events(spark, recs2))
    r = d.orderBy("window_start_ms").first()
    assert "addCart" in r.events and r.item_ids == ["8"] and r.uids == ["4", "5", "6"]


def test_one_document_per_minute_last_window_wins(spark):
    recs = [("m", str(u), "coupon", str(u), T0 + u * SEC) for u in (1, 2, 3)]
    d = alerts.alert_details(_events(spark, recs))
    docs = alerts.alert_documents(d)
    # windows ending in the same minute collapse to one document
    n_minutes = d.select(F.floor(F.col("window_end_ms") / 60000)).distinct().count()
    assert docs.count() == n_minutes
    per_doc = d.groupBy(F.floor(F.col("window_end_ms") / 60000).alias("b")).agg(
        F.max("window_end_ms").alias("mx"))
    assert sorted(r.ts for r in docs.collect()) == sorted(r.mx for r in per_doc.collect())


def test_window_counts_match_generate(spark):
    recs = [("m", "1", "coupon", "1", T0 + 7 * SEC)]
    c = alerts.window_counts(_events(spark, recs))
    assert c.count() == 60  # 5 min / 5 s
    assert c.agg(F.min("window_start_ms"), F.max("window_start_ms")).first() == \
        (T0 + 5 * SEC - 295 * SEC, T0 + 5 * SEC)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["1", "2", "3", "4", None]),
                          st.sampled_from(["coupon", "coupon", "clickItem", "addCart"]),
                          st.integers(min_value=0, max_value=900)), min_size=1, max_size=40))
def test_pane_form_equals_direct(spark, recs):
    ev = _events(spark, [(m, u, e, "1", T0 + t * SEC) for m, u, e, t in recs])
    for null_uid in (False, True):
        direct = alerts.window_stats(ev, count_null_uid=null_uid)
        pane = alerts.window_stats_panes(ev, count_null_uid=null_uid)
        cols = ["mid", "window_start_ms", "window_end_ms", "n_uids", "clicked"]
        assert sorted(map(tuple, direct.select(*cols).collect())) == \
            sorted(map(tuple, pane.select(*cols).collect()))
