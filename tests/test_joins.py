"""Header x line joins (FIXTURES §4 join-*) with the reference's 30 min."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from shopstream.operators import joins

from .conftest import rows

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
M = dt.timedelta(minutes=1)


def _info(spark, recs):
    """(id, user_id, arrival)"""
    return spark.createDataFrame(
        [(i, "1001", "2024-01-01 12:00:00", u, t) for i, u, t in recs],
        "id string, order_status string, create_time string, user_id string, timestamp timestamp")


def _detail(spark, recs):
    """(id, order_id, arrival)"""
    return spark.createDataFrame(
        [(i, o, "sku", "s1", "9.5", t) for i, o, t in recs],
        "id string, order_id string, sku_id string, sku_name string, order_price string, timestamp timestamp")


def _join(spark, info, detail):
    return joins.interval_join(_info(spark, info), _detail(spark, detail))


def test_same_batch_pair_kept(spark):
    out = _join(spark, [("o1", "u1", T0)], [("d1", "o1", T0)])
    assert rows(out, "order_detail_id", "order_id", "sku_price", "dt") == [("d1", "o1", 9.5, "2024-01-01")]


def test_header_first_and_line_first(spark):
    assert _join(spark, [("o1", "u1", T0)], [("d1", "o1", T0 + 10 * M)]).count() == 1
    assert _join(spark, [("o1", "u1", T0 + 10 * M)], [("d1", "o1", T0)]).count() == 1


def test_edges(spark):
    assert _join(spark, [("o1", "u1", T0)], [("d1", "o1", T0 + 30 * M)]).count() == 1
    s = dt.timedelta(seconds=1)
    assert _join(spark, [("o1", "u1", T0)], [("d1", "o1", T0 + 30 * M + s)]).count() == 0
    assert _join(spark, [("o1", "u1", T0 + 30 * M + s)], [("d1", "o1", T0)]).count() == 0


def test_many_lines(spark):
    out = _join(spark, [("o1", "u1", T0)], [("d1", "o1", T0 + M), ("d2", "o1", T0 + 5 * M),
                                             ("d3", "o1", T0 + 9 * M)])
    assert rows(out, "order_detail_id") == [("d1",), ("d2",), ("d3",)]


def test_orphans(spark):
    info = _info(spark, [("o1", "u1", T0), ("o2", "u1", T0)])
    detail = _detail(spark, [("d1", "o1", T0), ("d9", "o9", T0)])
    assert joins.interval_join(info, detail).count() == 1
    assert rows(joins.orphans(info, detail)) == [("order_detail", "d9", "o9"), ("order_info", "o2", "o2")]


def test_full_outer_by_batch(spark):
    info = _info(spark, [("o1", "u1", T0), ("o2", "u1", T0)]).selectExpr("*", "1 as batch")
    detail = _detail(spark, [("d1", "o1", T0), ("d2", "o2", T0)]).selectExpr("*", "if(id='d2', 2, 1) as batch")
    out = joins.full_outer_by_batch(info, detail)
    assert rows(out) == [("o1", "d1", 1, True, True), ("o2", "d2", 2, False, True),
                         ("o2", None, 1, True, False)]


def test_unknown_user_dropped(spark):
    sale = _join(spark, [("o1", "u1", T0), ("o2", "u2", T0)], [("d1", "o1", T0), ("d2", "o2", T0)])
    users = spark.createDataFrame([("u1", "n", "3", "2000-01-01", "F")],
                                  "id string, login_name string, user_level string, birthday string, gender string")
    out = joins.with_user(sale, users, as_of="2024-01-01 00:00:00")
    assert rows(out, "order_detail_id", "user_gender", "user_age", "user_level") == [("d1", "F", 24, "3")]
    assert rows(joins.users_for(users, sale), "id") == [("u1",)]


@settings(max_examples=10, deadline=None)
@given(st.integers(min_value=-40, max_value=40))
def test_interval_symmetric(spark, minutes):
    a = _join(spark, [("o", "u", T0)], [("d", "o", T0 + minutes * M)]).count()
    b = _join(spark, [("o", "u", T0 + minutes * M)], [("d", "o", T0)]).count()
    assert a == b == (1 if abs(minutes) <= 30 else 0)
