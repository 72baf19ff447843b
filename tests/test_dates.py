import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates

DAYS = [
    ("1726239466", "2024-09-13"), ("1726239466000", "2024-09-13"), ("2024-09-13 14:57:46", "2024-09-13"),
    ("2024-09-13 14:57", "2024-09-13"), ("2024-09-13 14", "2024-09-13"), ("2024-09-13", "2024-09-13"),
    ("20240913", "2024-09-13"), ("2024-09-13T23:30:00.123Z", "2024-09-13"), ("2024-09-13 14:57:46,123", "2024-09-13"),
    ("2024-13-45", "2025-02-14"), ("20240230", "2024-03-01"), ("2024-02-28 25:61:61", "2024-02-29"),
    ("2024-09-13 24", "2024-09-14"), ("2024-02-29", "2024-02-29"), ("2023-02-29", "2023-03-01"),
    ("20240229", "2024-02-29"), ("2024-04-31 00:00", "2024-05-01"), ("2024-12-31 23:59:60", "2025-01-01"),
    (None, "1970-01-01"), ("", "1970-01-01"), ("garbage", "1970-01-01"), ("2024-09-13\t10:00:00", "1970-01-01"),
    ("2022-12-29 11:07:49.000000", "1970-01-01"), ("2024-09-13T23:30:00x123Z", "1970-01-01"),
    ("2024-09-13\n", "1970-01-01"), ("172623946L", "1970-01-01"), ("12.4567890", "1970-01-01"),
    ("-100000000", "1966-10-31"), ("0000-00-00", "0002-11-30"), ("0000-00-00 00:00:00", "0002-11-30"),
    ("2024-00-10", "2023-12-10"), ("2024-01-00", "2023-12-31"),
]


def test_day_bucket_goldens(spark):
    df = spark.createDataFrame([(i, t, d) for i, (t, d) in enumerate(DAYS)], "i int, t string, want string")
    got = df.select("t", "want", dates.day_bucket("t").alias("got")).where("got is distinct from want").collect()
    assert got == []


def test_day_bucket_takes_fractions_when_extended(spark):
    df = spark.createDataFrame([("2022-12-29 11:07:49.000000",), ("2022-12-29 11:07:49.5",)], "t string")
    assert {r[0] for r in df.select(dates.day_bucket("t", extended=True)).collect()} == {"2022-12-29"}


def test_day_of_epoch_follows_the_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        df = spark.createDataFrame([("1726239466",), ("1726250000",)], "t string")
        assert [r[0] for r in df.select(dates.day_bucket("t")).collect()] == ["2024-09-13", "2024-09-14"]
        assert df.limit(1).select(dates.epoch_ms_text(F.lit(0))).first()[0] == "1970-01-01 08:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("text, want", [
    ("2024-09-13 14:57:46,123", dt.datetime(2024, 9, 13, 14, 57, 46, 123000)),
    ("2024-09-13T23:30:00.123Z", dt.datetime(2024, 9, 13, 23, 30, 0, 123000)),
    ("2024-02-28 25:61:61", dt.datetime(2024, 2, 29, 2, 2, 1)),
    ("2024-09-13 14", dt.datetime(2024, 9, 13, 14)), ("2024-09-13 14:57", dt.datetime(2024, 9, 13, 14, 57)),
    ("20240230", dt.datetime(2024, 3, 1)), ("20240913", dt.datetime(2024, 9, 13)), ("2024-02-29", dt.datetime(2024, 2, 29)),
    ("2024-02-30 24:00:00,5", None), ("junk", None), (None, None),
])
def test_parse_loose(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string").select(dates.parse_loose("t").cast("timestamp_ntz"))
    assert df.first()[0] == want


def test_format_with_literal_t(spark):
    df = spark.createDataFrame([("2024-09-13 14:57:46",)], "t string")
    assert df.select(dates.format_loose("t", "yyyyMMdd`T`HHmm")).first()[0] == "20240913T1457"


def test_small_date_functions(spark):
    one = spark.range(1)

    def value(c):
        return one.select(c).first()[0]

    assert value(dates.offset_day(F.lit("2024-02-28"), 2)) == "2024-03-01"
    assert value(dates.diff_days(F.lit("2024-01-01"), F.lit("2024-01-03"))) == -2
    assert value(dates.diff_ms(F.lit("2024-01-02"), F.lit("2024-01-01"))) == 86_400_000
    assert value(dates.weekday(F.lit("2024-09-15").cast("date"))) == 0
    assert value(dates.local_to_epoch_ms(F.lit("1970-01-01 08:00:00"))) == 0
    assert value(dates.reformat(F.lit("20240913"), "yyyyMMdd", "yyyy/MM/dd")) == "2024/09/13"
    assert value(dates.can_parse_loose(F.lit("2024-13-45"))) is True
    assert value(dates.can_parse_loose(F.lit("x"))) is False
    assert value(dates.fits_format(F.lit("2024-13-45"), "yyyy-MM-dd")) is False
    assert value(dates.ms_since_midnight(F.lit("2024-01-01 00:01:00"))) == 60_000
