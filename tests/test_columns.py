"""Masks, age, time parts and document ids (FIXTURES §4: mask, mask-twice, age)."""

from pyspark.sql import functions as F

from shopstream.functions import columns as X


def _one(spark, expr_fn, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


def test_mask_name(spark):
    assert _one(spark, X.mask_name, ["张三", "", None, "Bob"]) == ["张**", "**", None, "B**"]


def test_mask_phone(spark):
    got = _one(spark, X.mask_phone, ["13812345678", "x13812345678y", "1381234567",
                                     "13812345678,13900001111", None])
    assert got == ["138****5678", "x138****5678y", "1381234567", "138****5678,139****1111", None]


def test_masks_not_idempotent(spark):
    assert _one(spark, X.mask_name, ["张**", "**"]) == ["张**", "***"]
    assert _one(spark, X.mask_phone, ["138****5678"]) == ["138****5678"]
    eighteen = "123456789012345678"
    once = _one(spark, X.mask_phone, [eighteen])[0]
    twice = _one(spark, X.mask_phone, [once])[0]
    assert once != eighteen and twice != once


def test_user_age(spark):
    as_of = "2024-01-01 00:00:00"
    df = spark.createDataFrame([("2022-11-27",), ("2025-02-04",), ("1990-13-40",), (None,),
                                ("1990-01-01",)], "b string")
    got = [r[0] for r in df.select(X.user_age("b", as_of)).collect()]
    # 400 days before -> 1; 400 days after -> -1 (toward zero); bad/null -> null
    assert got == [1, -1, None, None, 34]


def test_time_parts_midnight(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ms = [1704067199000, 1704067201000]  # 2023-12-31 23:59:59, 2024-01-01 00:00:01
    df = spark.createDataFrame([(m,) for m in ms], "ts long")
    got = df.select(X.log_date("ts"), X.log_hour("ts")).collect()
    assert [tuple(r) for r in got] == [("2023-12-31", "23"), ("2024-01-01", "00")]


def test_create_parts_null_safe(spark):
    df = spark.createDataFrame([("2020-06-01 07:41:29",), ("2020",), (None,)], "c string")
    got = [tuple(r) for r in df.select(X.create_date("c"), X.create_hour("c")).collect()]
    assert got == [("2020-06-01", "07"), ("2020", ""), (None, None)]


def test_doc_id(spark):
    df = spark.createDataFrame([("mid_1", 1704067201000)], "mid string, ts long")
    assert df.select(X.doc_id("mid", "ts")).first()[0] == "mid_1_28401120"


def test_div_trunc_of_large_longs(spark):
    """Beyond the 53 bits of a double, toward zero on both sides."""
    values = [2**63 - 1, -(2**63) + 1, 2**53 + 1, -7, 7, 0, None]
    got = spark.createDataFrame([(v,) for v in values], "v long").select(X.div_trunc(F.col("v"), 3).alias("q")).collect()
    assert [r.q for r in got] == [None if v is None else (abs(v) // 3) * (1 if v >= 0 else -1) for v in values]
