"""Change feed (FIXTURES §4 cdc), log routing and stamping (route, stamp), KPIs (kpi-empty)."""

import json

from pyspark.sql import functions as F

from shopstream import constants as C
from shopstream import schemas as S
from shopstream.operators import cdc, ingest, kpi

from .conftest import rows


def test_cdc_filters_and_explodes(spark):
    recs = [
        ("shop", "order_info", "INSERT", "ROWDATA", [{"id": "1", "user_id": "5"}]),
        ("shop", "order_info", "UPDATE", "ROWDATA", [{"id": "1", "user_id": "6"}]),
        ("shop", "order_detail", "DELETE", "ROWDATA", [{"id": "1-1", "order_id": "1"}]),
        ("shop", "user_info", "INSERT", "ROWDATA", [{"id": "5"}]),
        ("shop", "order_info", "INSERT", "ROWDATA", []),
        ("shop", "order_detail", "INSERT", "ROWDATA",
         [{"id": "2-1", "order_id": "2"}, {"id": "2-2", "order_id": "2"}]),
        ("otherdb", "order_info", "INSERT", "ROWDATA", [{"id": "7"}]),
        ("shop", "order_info", "INSERT", "TRANSACTIONBEGIN", [{"id": "8"}]),
    ]
    df = spark.createDataFrame(recs, S.CHANGE_SCHEMA)
    out = cdc.to_topics(df)
    got = rows(out, "topic", "key", "value")
    assert [(t, k) for t, k, _ in got] == [(C.ORDER_DETAIL_TOPIC, "2"), (C.ORDER_DETAIL_TOPIC, "2"),
                                          (C.ORDER_INFO_TOPIC, "1")]
    assert json.loads(got[2][2]) == {"id": "1", "user_id": "5"}


def test_cdc_empty_string_option(spark):
    df = spark.createDataFrame([("shop", "order_info", "INSERT", "ROWDATA",
                                 [{"id": "1", "operate_time": ""}])], S.CHANGE_SCHEMA)
    assert json.loads(cdc.to_topics(df).first().value) == {"id": "1", "operate_time": ""}
    assert json.loads(cdc.to_topics(df, null_empty=True).first().value) == {"id": "1"}


def test_route_on_log_type_and_compat(spark):
    ev = '{"logType":"event","mid":"m1","eventId":"coupon","note":"startup screen"}'
    su = '{"logType":"startup","mid":"m2"}'
    df = spark.createDataFrame([(ev,), (su,)], "value string")
    assert rows(ingest.route(df), "key", "topic") == [("m1", C.EVENT_TOPIC), ("m2", C.STARTUP_TOPIC)]
    assert rows(ingest.route(df, compat=True), "key", "topic") == [("m1", C.STARTUP_TOPIC),
                                                                   ("m2", C.STARTUP_TOPIC)]


def test_stamp_replaces_ts(spark):
    df = spark.createDataFrame([('{"mid":"m","ts":1}', "2024-01-01 00:00:01")], "value string, t string")
    df = df.withColumn("t", F.to_timestamp("t"))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    out = json.loads(ingest.stamp(df, now=F.col("t")).first().value)
    assert out == {"mid": "m", "ts": 1704067201000}


def test_kpi_empty_date(spark):
    dau = spark.createDataFrame([], "mid string, logdate string, loghour string")
    orders = spark.createDataFrame([("a", 1.5, "2024-01-01", "10", "2024-01")],
                                   "id string, total_amount double, create_date string, create_hour string, create_month string")
    assert kpi.dau_total(dau, "2024-01-02").first().dau == 0
    assert kpi.amount_total(orders, "2024-01-02").first().order_amount == 0.0
    assert kpi.amount_by_hour(orders, "2024-01-02").count() == 0
    lst = kpi.kpi_list(dau, orders, "2024-01-01").orderBy("pos").collect()
    assert [(r.id, r.value) for r in lst] == [("dau", "0"), ("new_mid", "233"), ("order_amount", "1.5")]
    doc = json.loads(kpi.kpi_json(kpi.kpi_list(dau, orders, "2024-01-01")).first().json)
    assert [d["id"] for d in doc] == ["dau", "new_mid", "order_amount"]
    m = kpi.as_map(kpi.amount_by_hour(orders, "2024-01-01"), "create_hour", "order_amount")
    assert m.select(kpi.map_text()).first()[0] == "10:1.5"
    both = kpi.kpi_lists(dau, orders, ["2024-01-01", "2024-01-02"])
    assert [r[1:] for r in both.where("date = '2024-01-01'").orderBy("pos").collect()] == [tuple(r) for r in lst]
    assert [r.value for r in both.where("date = '2024-01-02'").orderBy("pos").collect()] == ["0", "233", "0.0"]
    assert {r.date for r in kpi.kpi_json(both, "date").collect()} == {"2024-01-01", "2024-01-02"}
