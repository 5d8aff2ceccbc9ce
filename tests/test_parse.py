"""JSON parsing (FIXTURES §4 json) and round trip."""

from pyspark.sql import functions as F

from shopstream import schemas as S
from shopstream.operators import parse


def test_json_cases(spark):
    lines = [
        '{"id":"1","total_amount":"12.50","create_time":"2020-06-01 07:41:29"}',  # quoted number
        '{"id":"2","total_amount":13.25,"create_time":"2020-06-01 08:00:00"}',    # bare number
        '{"id":"3","create_time":"2020-06-01 09:00:00"}',                          # missing field
        '{"id":"4","total_amount":"1","zzz":5,"create_time":"2020-06-01 10:00:00"}',  # extra field
        'not json at all', '', '   ', None,                          # malformed, blank, null
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    parsed = parse.parse_json(df, S.ORDER_INFO_FIELDS, S.ORDER_INFO_CASTS)
    good = parse.valid(parsed).orderBy("id").select("id", "total_amount").collect()
    assert [tuple(r) for r in good] == [("1", 12.5), ("2", 13.25), ("3", None), ("4", 1.0)]
    bad = parse.quarantine(parsed).collect()
    assert sorted(r.value for r in bad) == ["", "", "   ", "not json at all"]


def test_order_info_masked_once(spark):
    line = ('{"id":"9","consignee":"张三","consignee_tel":"13812345678",'
            '"total_amount":"5","create_time":"2020-06-01 07:41:29"}')
    df = spark.createDataFrame([(line,)], "value string")
    r = parse.parse_order_info(df).first()
    assert (r.consignee, r.consignee_tel, r.create_date, r.create_hour) == \
        ("张**", "138****5678", "2020-06-01", "07")


def test_event_numbers_as_strings(spark):
    line = '{"mid":"mid_1","uid":"7","eventId":"coupon","itemId":12,"pageId":3,"ts":1000}'
    df = spark.createDataFrame([(line,)], "value string")
    r = parse.parse_event(df).first()
    assert (r.itemId, r.pageId, r.ts) == ("12", "3", 1000)


def test_roundtrip(spark):
    line = '{"mid":"m","uid":"u","appId":"a","area":"x","os":"ios","channel":"c","logType":"startup","version":"1","ts":5}'
    df = spark.createDataFrame([(line,)], "value string")
    typed = parse.parse_startup(df)
    back = parse.parse_startup(parse.to_json_value(typed, S.STARTUP_FIELDS))
    cols = S.STARTUP_FIELDS
    assert typed.select(*cols).first() == back.select(*cols).first()
    assert F is not None
