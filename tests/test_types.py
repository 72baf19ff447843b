import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import present, spark_type, typed_value, widens, widest

# Source types of the all-types fixture and what they become.
KINDS = [
    ("BIT(1)", "boolean"), ("BIT(64)", "binary"), ("TINYINT(1)", "boolean"), ("BOOLEAN", "boolean"), ("BOOL", "boolean"),
    ("TINYINT(2)", "tinyint"), ("TINYINT(2) UNSIGNED", "smallint"), ("TINYINT(2) UNSIGNED ZEROFILL", "smallint"),
    ("SMALLINT", "smallint"), ("SMALLINT UNSIGNED", "int"), ("MEDIUMINT", "int"), ("MEDIUMINT UNSIGNED", "int"),
    ("INT", "int"), ("INT UNSIGNED ZEROFILL", "bigint"), ("BIGINT", "bigint"), ("BIGINT UNSIGNED", "bigint"),
    ("SERIAL", "bigint"), ("FLOAT", "float"), ("FLOAT UNSIGNED", "float"), ("REAL", "double"), ("DOUBLE", "double"),
    ("DOUBLE PRECISION UNSIGNED ZEROFILL", "double"), ("NUMERIC(8,3)", "decimal(8,3)"), ("DECIMAL(8)", "decimal(8,0)"),
    ("DECIMAL(38,10)", "decimal(38,10)"), ("DECIMAL", "decimal(10,0)"), ("FIXED(40,3)", "string"), ("DATE", "date"),
    ("TIME", "string"), ("YEAR", "int"), ("DATETIME", "timestamp_ntz"), ("DATETIME(6)", "timestamp_ntz"),
    ("TIMESTAMP(3)", "timestamp"), ("CHAR(10)", "char(10)"), ("VARCHAR(20)", "varchar(20)"), ("TINYTEXT", "string"),
    ("LONGTEXT", "string"), ("BINARY(10)", "binary"), ("VARBINARY(10)", "binary"), ("LONGBLOB", "binary"),
    ("JSON", "string"), ("ENUM('a','b')", "string"), ("SET('a','b')", "array<string>"), ("POINT", "string"),
    ("GEOMETRYCOLLECTION", "string"),
]


@pytest.mark.parametrize("text, want", KINDS)
def test_source_types(text, want):
    assert spark_type(text).simpleString() == want


def test_type_modes():
    assert spark_type("TINYINT(1)", tinyint1_not_bool=True) == T.ByteType()
    assert spark_type("BIGINT UNSIGNED", unsigned_bigint_as_bigint=False) == T.DecimalType(20, 0)
    assert spark_type("VARCHAR", 7) == T.VarcharType(7)
    with pytest.raises(ValueError):
        spark_type("WIDGET(3)")


def _image(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(F.parse_json("t").alias("i"))


@pytest.mark.parametrize("value, kind, want", [
    ("2222222222222222300000001111.1234567890", "DECIMAL(38,10)", Decimal("2222222222222222300000001111.1234567890")),
    ("1.10", "DECIMAL(8,3)", Decimal("1.100")), ("19440", "DATE", dt.date(2023, 3, 24)),
    ('"2023-03-24"', "DATE", dt.date(2023, 3, 24)), ("1679616000123", "DATETIME(3)", dt.datetime(2023, 3, 24, 0, 0, 0, 123000)),
    ("1679616000123456", "DATETIME(6)", dt.datetime(2023, 3, 24, 0, 0, 0, 123456)), ("-1", "DATETIME", dt.datetime(1969, 12, 31, 23, 59, 59, 999000)),
    ("1", "TINYINT(1)", True), ("0", "BIT(1)", False), ("true", "BOOLEAN", True), ('"a,b"', "SET('a','b')", ["a", "b"]), ('""', "SET('a')", []),
    ("36610000000", "TIME", "10:10:10"), ('"AQI="', "BLOB", bytearray(b"\x01\x02")), ('"x"', "VARCHAR(10)", "x"),
    ('"2023-03-23T07:00:10Z"', "TIMESTAMP", dt.datetime(2023, 3, 23, 7, 0, 10)), ("-36610000000", "TIME", "-10:10:10"), ("null", "INT", None), ("2023", "YEAR", 2023),
])
def test_log_encodings(spark, value, kind, want):
    df = _image(spark, f'{{"c": {value}}}')
    assert df.select(typed_value("i", "c", spark_type(kind), kind)).first()[0] == want


def test_strict_and_lenient_casts(spark):
    df = _image(spark, '{"c": "abc"}')
    assert df.select(typed_value("i", "c", T.IntegerType(), strict=False)).first()[0] is None
    with pytest.raises(Exception):
        df.select(typed_value("i", "c", T.IntegerType())).collect()


def test_null_images_are_absent(spark):
    df = spark.createDataFrame([("null",), ('{"a":1}',), (None,)], "t string").select(F.parse_json("t").alias("i"))
    assert [r[0] for r in df.select(present("i")).collect()] == [False, True, False]


def test_widening():
    assert widens(T.IntegerType(), T.LongType()) and not widens(T.LongType(), T.IntegerType())
    assert widens(T.VarcharType(10), T.VarcharType(20)) and widens(T.VarcharType(10), T.StringType())
    assert widens(T.FloatType(), T.DoubleType()) and not widens(T.IntegerType(), T.StringType())
    assert widest(T.DecimalType(8, 3), T.DecimalType(10, 0)) == T.DecimalType(13, 3)
    assert widest(T.IntegerType(), T.StringType()) is None


def test_clock_keeps_the_fraction_of_its_type(spark):
    from tidemark.functions.types import decode_text, spark_type

    text = spark.createDataFrame([("36803012345",), ("-1000001",)], "t string")
    for kind, want in [("time", ["10:13:23", "-00:00:01"]), ("time(3)", ["10:13:23.012", "-00:00:01.000"]), ("time(6)", ["10:13:23.012345", "-00:00:01.000001"])]:
        got = text.select(decode_text(F.col("t"), spark_type(kind), kind).alias("c"))
        assert [r.c for r in got.collect()] == want


def test_common_types_across_families():
    i8, i16, i32, i64, f, d, dec = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType
    for a, b, c in [
        (i32, d, d), (i16, f, f), (i32, f, d), (i8, dec(4, 2), dec(5, 2)), (i32, dec(5, 2), dec(12, 2)), (i64, dec(5, 2), dec(22, 2)),
        (i64, dec(20, 0), dec(20, 0)), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.DateType(), T.TimestampType(), T.TimestampType()),
        (i64, d, None), (i64, f, None), (dec(5, 2), d, None), (i32, T.BooleanType(), None), (i64, dec(38, 30), None), (T.DateType(), T.StringType(), None),
        (T.TimestampType(), T.TimestampNTZType(), None),
    ]:
        assert widest(a, b) == c == widest(b, a), (a, b)
    every = [i8, i16, i32, i64, f, d, dec(4, 2), dec(20, 0), dec(30, 10), T.DateType(), T.TimestampNTZType(), T.StringType(), T.VarcharType(5)]
    for a in every:  # a lattice: the common type keeps both, in whatever order more come
        for b in every:
            ab = widest(a, b)
            assert ab is None or (widens(a, ab) and widens(b, ab))
