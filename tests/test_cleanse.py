"""Micro-fixtures from FIXTURES.md section 3 (expected values worked out by hand)."""
import datetime as dt

from pyspark.sql import functions as F

from tripkit.functions import cleanse as C
from tripkit.functions import timeparts as tp


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn("v")).collect()]


def test_vendor(spark):
    assert one_col(spark, ["1", " 2 ", "cmt", "VTS", "dds", "X", None], C.vendor_code) == [1, 2, 1, 2, 3, None, None]


def test_rate_code(spark):
    assert one_col(spark, ["6", "7", "99"], C.rate_code) == [6, None, None]


def test_store_flag(spark):
    assert one_col(spark, ["y", "1.0", "0", "*"], C.store_flag) == [True, True, False, None]


def test_payment(spark):
    assert one_col(spark, ['"CRD"', "Cash", "No Charge", "DIS", "5", "UNK"], C.payment_code) == [1, 2, 3, 4, 5, None]


def test_zero_coordinate(spark):
    assert one_col(spark, [0.0, -73.98], C.zero_to_null, "double") == [None, -73.98]


def test_fhv_flags_rowstore(spark):
    assert one_col(spark, [""], lambda c: C.fhv_flag_rowstore(c, empty_is_false=True)) == [False]
    assert one_col(spark, ["", " y "], C.fhv_flag_rowstore) == [None, True]


def test_fhv_flags_columnstore(spark):
    assert one_col(spark, [" "], C.fhv_flag_columnstore) == [False]
    assert one_col(spark, [" ", "y", "N"], lambda c: C.fhv_flag_columnstore(c, blank_is_false=False)) == [None, None, False]


def test_company(spark):
    assert one_col(spark, ["b02510", "B02800", "B99999"], C.base_company) == ["lyft", "via", "other"]
    assert one_col(spark, ["HV0003", "HV9999"], C.licence_company) == ["uber", None]


def test_bounded_duration(spark):
    df = spark.createDataFrame([(6.0,), (5.0,), (240 * 60.0,), (241 * 60.0,)], "s double")
    got = [r[0] for r in df.select(C.bounded(F.col("s") / 60, 0.1, 240)).collect()]
    assert got == [0.1, None, 240.0, None]


def test_time_bucket(spark):
    got = one_col(spark, [7, 8, 11, 15, 16, 19, 22], C.time_bucket, "int")
    assert got == ["other", "morning", "midday", "midday", "afternoon", "evening", "other"]


def test_break_points(spark):
    got = one_col(spark, [0.0, 0.0001, 0.2, 6.0], lambda c: C.cut_left_closed(c, [0, 0.0001, 0.2, 0.4, 0.6, 6]),
                  "double")
    assert got[:3] == ["[0,0.0001)", "[0.0001,0.2)", "[0.2,0.4)"] and got[3] is None


def test_cash_tip(spark):
    df = spark.createDataFrame([(2, 0.0, 10.0), (1, 0.0, 10.0)], "p int, tip double, total double")
    cost, tip = C.impute_cash_tip("total", "tip", "p")
    got = [tuple(round(x, 6) for x in r) for r in df.select(cost, tip).collect()]
    assert got == [(11.5, 1.5), (10.0, 0.0)]


def test_replace_first(spark):
    got = one_col(spark, ["Jill Stein (Green)", "A (x) (y)"], lambda c: F.trim(tp.replace_first(c, r"\(.+?\)")))
    assert got == ["Jill Stein", "A  (y)"]


def test_month_end(spark):
    df = spark.createDataFrame([(2016, 2, "2017-02")], "y int, m int, s string")
    r = df.select(tp.month_end("y", "m"), C.month_string_end("s")).first()
    assert r[0] == dt.date(2016, 2, 29) and r[1] == dt.date(2017, 2, 28)


def test_parse_number(spark):
    assert one_col(spark, [" 1,234 ", "45%", "-"], C.parse_number) == [1234.0, 45.0, None]


def test_dow_sunday_zero(spark):
    df = spark.createDataFrame([("2024-01-07 12:00:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    assert df.select(tp.dow0("t")).first()[0] == 0


def test_seconds_between_whole_and_fraction(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 10:00:00.9' a, timestamp_ntz'2024-01-01 10:00:02.1' b")
    r = df.select(tp.seconds_between("a", "b"), tp.seconds_between("a", "b", whole=True)).first()
    assert abs(r[0] - 1.2) < 1e-9 and r[1] == 2


def test_three_valued_flags(spark):
    df = spark.createDataFrame([(False, None, False), (False, True, None), (False, False, False)], "a boolean, b boolean, c boolean")
    assert [r[0] for r in df.select(C.all_false("a", "b", "c")).collect()] == [None, False, True]
