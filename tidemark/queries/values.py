"""Scalar functions: day buckets, loose times, metadata columns, casts, date arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates
from tidemark.functions.metadata import metadata_columns
from tidemark.functions.names import fold_columns, spellings
from tidemark.functions.types import spark_type, typed_value
from tidemark.operators.row_kinds import DayColumn, Projection, project_image, to_row_kinds
from tidemark.operators.schema import Field, TableSchema
from tidemark.queries.eventlog import LOG, loose_events, projection
from tidemark.queries.log import changes
from tidemark.queries.registry import query, table


@query("s01_day_bucket", f"""WITH {LOG} SELECT event_id, dt FROM log""")
def s01_day_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loose_events(spark, sf_dir).select("event_id", dates.day_bucket("add_time").alias("dt"))


@query("s02_lenient_days", """WITH f AS (SELECT event_id, CAST(year(ts) AS BIGINT) AS y, event_id % 20 AS m,
      event_id % 47 AS d, event_id % 30 AS h, event_id % 75 AS mi, event_id % 80 AS s FROM events)
    SELECT event_id, strftime(make_date(y, 1, 1) + to_months(CAST(m - 1 AS INTEGER)) + to_days(CAST(d - 1 AS INTEGER))
      + to_seconds(h * 3600 + mi * 60 + s), '%Y-%m-%d') AS dt,
      strftime(make_date(y, 1, 1) + to_months(CAST(m - 1 AS INTEGER)) + to_days(CAST(d - 1 AS INTEGER))
      + to_seconds(h * 3600 + mi * 60 + s), '%Y-%m-%d %H:%M:%S') AS full_text FROM f""")
def s02_lenient_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months, days and clock fields out of range roll over into the next unit."""
    ev = table(spark, sf_dir, "events")
    e = F.col("event_id")
    text = F.format_string(
        "%04d-%02d-%02d %02d:%02d:%02d", F.year("ts"), e % 20, e % 47, e % 30, e % 75, e % 80
    )
    return ev.select("event_id", text.alias("t")).select(
        "event_id", dates.day_bucket("t").alias("dt"),
        dates.format_loose("t", dates.SECOND_FORMAT).alias("full_text"),
    )


@query("s01_typed_days", """SELECT o_orderkey, kind, strftime(o_orderdate, '%Y-%m-%d') AS dt
    FROM orders, (VALUES ('date'), ('datetime'), ('datetime(6)'), ('timestamp')) t(kind)""")
def s01_typed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day of a typed source column, late in the evening: its own day, whatever form the log gives it."""
    o = table(spark, sf_dir, "orders")
    evening = F.col("o_orderdate").cast("date").cast("timestamp") + F.expr("interval 23 hours 30 minutes")
    image = F.struct(
        F.unix_date(F.col("o_orderdate").cast("date")).alias("c0"), F.unix_millis(evening).alias("c1"),
        F.unix_micros(evening).alias("c2"), F.date_format(evening, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("c3"))
    c = o.select("o_orderkey", F.inline(F.array(F.struct(F.parse_json(F.to_json(image)).alias("after")))))
    out = None
    for i, kind in enumerate(("date", "datetime", "datetime(6)", "timestamp")):
        fields = [Field(f"c{i}", spark_type(kind), True, kind), Field("dt", T.StringType())]
        rows = project_image(c, Projection(TableSchema(fields), DayColumn(f"c{i}")), "after", ["o_orderkey"])
        rows = rows.select("o_orderkey", F.lit(kind).alias("kind"), "dt")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("s16_fractional_clock", """SELECT l_orderkey, l_linenumber,
      printf('%02d:00:00.%06d', CAST(l_linenumber AS INTEGER), CAST(l_orderkey % 1000000 AS INTEGER)) AS clock FROM lineitem""")
def s16_fractional_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TIME(6) with its microseconds."""
    micros = F.col("l_linenumber").cast("bigint") * 3_600_000_000 + F.col("l_orderkey") % 1_000_000
    li = table(spark, sf_dir, "lineitem")
    c = li.select("l_orderkey", "l_linenumber", F.parse_json(F.to_json(F.struct(micros.alias("t")))).alias("after"))
    value = typed_value("after", "t", spark_type("time(6)"), "time(6)")
    return c.select("l_orderkey", "l_linenumber", value.alias("clock"))


@query("s02_loose_timestamp", """SELECT event_id, CASE
      WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN NULL
      WHEN event_id % 9 IN (0, 2) THEN epoch_us(date_trunc('second', ts))
      WHEN event_id % 9 = 3 THEN epoch_us(date_trunc('minute', ts))
      WHEN event_id % 9 = 4 THEN epoch_us(date_trunc('hour', ts))
      WHEN event_id % 9 IN (5, 6) THEN epoch_us(date_trunc('day', ts))
      ELSE epoch_us(ts) // 1000 * 1000 END AS at_us FROM events""")
def s02_loose_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = loose_events(spark, sf_dir)
    return ev.select("event_id", F.unix_micros(dates.parse_loose("add_time")).alias("at_us"))


@query("s03_format_loose", """SELECT event_id, CASE
      WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN NULL
      WHEN event_id % 9 IN (5, 6) THEN strftime(ts, '%Y/%m/%dT00')
      ELSE strftime(ts, '%Y/%m/%dT%H') END AS hour_text FROM events""")
def s03_format_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = dates.format_loose("add_time", "yyyy/MM/dd`T`HH")
    return loose_events(spark, sf_dir).select("event_id", text.alias("hour_text"))


@query("s04_parseable", """SELECT user_id, count(*) AS total,
      CAST(sum(CASE WHEN event_id % 101 <> 0 AND event_id % 103 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS parseable
    FROM events GROUP BY user_id""")
def s04_parseable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loose_events(spark, sf_dir).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(dates.can_parse_loose("add_time")).alias("parseable")
    )


@query("s05_computed_on_every_kind", f"""WITH {LOG},
      p AS (SELECT *, lag(event_id) OVER w AS pe, lag(gone) OVER w AS pg, lag(dt) OVER w AS pdt
            FROM log WINDOW w AS (PARTITION BY k ORDER BY event_id)),
      halves AS (
        SELECT 'U' AS kind, dt FROM p WHERE NOT gone
        UNION ALL SELECT 'D', pdt FROM p WHERE pe IS NOT NULL AND NOT pg)
    SELECT kind, dt, count(*) AS rows FROM halves GROUP BY 1, 2""")
def s05_computed_on_every_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on both halves of each change, the old row's and the new one's."""
    rows = to_row_kinds(_distinct_times(changes(spark, sf_dir, "full")), projection(day=True))
    return rows.groupBy(F.col("_kind").alias("kind"), "dt").agg(F.count(F.lit(1)).alias("rows"))


def _distinct_times(c: DataFrame) -> DataFrame:
    """Add a delete for updates whose time text did not change, since their delete half is left out by design."""
    same = F.col("op").eqNullSafe("u") & typed_value("before", "add_time", T.StringType()).eqNullSafe(
        typed_value("after", "add_time", T.StringType())
    )
    stays = c.where(same).withColumn("op", F.lit("d"))
    return c.unionByName(stays)


@query("s07_fold_columns", """SELECT l_orderkey, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, count(*) AS lines
    FROM lineitem GROUP BY l_orderkey""")
def s07_fold_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = table(spark, sf_dir, "lineitem")
    upper = fold_columns(upper.toDF(*[c.upper() for c in upper.columns]), table="lineitem")
    return upper.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("sum_qty"), F.count(F.lit(1)).alias("lines"))


@query("s08_fold_image_keys", """SELECT CASE event_id % 3 WHEN 0 THEN 'userId' WHEN 1 THEN 'USERID' ELSE 'UserId' END AS spelling,
      'userid' AS folded, bool_or(event_id % 7 = 0) AS clash, count(*) AS images
    FROM events GROUP BY 1""")
def s08_fold_image_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images spell a field in several ways; some hold it twice, which is a clash."""
    ev = table(spark, sf_dir, "events")
    e, value = F.col("event_id"), F.to_json(F.struct("user_id"))
    body = F.regexp_extract(value, r":(\d+)", 1)
    name = F.when(e % 3 == 0, "userId").when(e % 3 == 1, "USERID").otherwise("UserId")
    extra = F.when(e % 7 == 0, F.concat(F.lit(',"useriD":'), body)).otherwise("")
    image = F.parse_json(F.concat(F.lit('{"'), name, F.lit('":'), body, extra, F.lit("}")))
    c = ev.select(F.lit("d").alias("db"), name.alias("tbl"), image.alias("after"))
    images = c.groupBy(F.col("tbl").alias("spelling")).agg(F.count(F.lit(1)).alias("images"))
    found = spellings(c).where("spelling = tbl").select("spelling", "folded", "clash")
    return found.join(images, "spelling")


@query("s09_metadata_columns", f"""WITH {LOG} SELECT k, 'ods_test' AS src_db, tbl AS src_tbl, 'ods_test.' || tbl AS src_full,
      NULL::VARCHAR AS src_schema, strftime(ts, '%Y-%m-%d %H:%M:%S') AS changed_at FROM log""")
def s09_metadata_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {
        "DATABASE": "src_db", "TABLE": "src_tbl", "FULL_TABLE_NAME": "src_full", "SCHEMA": "src_schema",
        "BINLOG_TIME": "changed_at",
    }
    key = F.coalesce(*[typed_value(image, "k", T.LongType()) for image in ("after", "before")])
    return changes(spark, sf_dir).select(key.alias("k"), *metadata_columns(kinds))


@query("s15_target_rows", f"""WITH {LOG} SELECT k, v1, val, dt FROM log WHERE NOT gone""")
def s15_target_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images in target column order: source columns, then the computed day."""
    rows = project_image(changes(spark, sf_dir).where("op <> 'd'"), projection(day=True), "after")
    return rows.select("k", "v1", "val", "dt")


@query("s16_typed_cast", """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line,
      CAST(CAST(l_extendedprice AS DECIMAL(20,2)) AS DOUBLE) AS price, strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
      epoch_us(l_shipdate) AS shipped_us, l_returnflag = 'R' AS returned, l_linestatus AS first_status,
      CAST(l_linenumber AS BIGINT) * 3600 AS clock_seconds
    FROM lineitem""")
def s16_typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log encodings of each type and back: exact decimals, days, milliseconds, bits, sets, clock times."""
    li = table(spark, sf_dir, "lineitem")
    image = F.struct(
        F.col("l_linenumber").alias("i"),
        F.col("l_extendedprice").cast("decimal(20,2)").alias("d"),
        F.unix_date(F.col("l_shipdate").cast("date")).alias("day"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("at"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("bit"),
        F.concat_ws(",", "l_linestatus", "l_returnflag").alias("set"),
        (F.col("l_linenumber").cast("bigint") * 3_600_000_000).alias("clock"),
    )
    types = {
        "i": "int", "d": "decimal(20,2)", "day": "date", "at": "datetime(3)", "bit": "bit(1)", "set": "set('F','O','R')",
        "clock": "time",
    }
    fields = [Field(name, spark_type(kind), True, kind) for name, kind in types.items()]
    c = li.select("l_orderkey", F.inline(F.array(F.struct(F.parse_json(F.to_json(image)).alias("after")))))
    typed = project_image(c, Projection(TableSchema(fields)), "after", ["l_orderkey"])
    clock = typed.withColumn("hms", F.split("clock", ":"))
    part = [F.col("hms")[i].cast("bigint") for i in range(3)]
    return clock.select(
        "l_orderkey", F.col("i").cast("bigint").alias("line"), F.col("d").cast("double").alias("price"),
        F.col("day").cast("string").alias("ship_day"), F.unix_micros(F.col("at").cast("timestamp")).alias("shipped_us"),
        F.col("bit").alias("returned"), F.col("set")[0].alias("first_status"),
        (part[0] * 3600 + part[1] * 60 + part[2]).alias("clock_seconds"),
    )


@query("s17_unsigned_bigint", """SELECT o_custkey, max(o_orderkey + 2147483648) AS biggest,
      bool_and(o_orderkey % 2 = 1) AS all_odd, max(CAST(o_orderkey % 2 AS BIGINT)) AS tiny FROM orders GROUP BY o_custkey""")
def s17_unsigned_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unsigned bigint as BIGINT; tinyint(1) as BOOLEAN, or as TINYINT in the other mode."""
    o = table(spark, sf_dir, "orders")
    image = F.struct((F.col("o_orderkey") + 2147483648).alias("u"), (F.col("o_orderkey") % 2).alias("t"))
    c = o.select("o_custkey", F.parse_json(F.to_json(image)).alias("after"))
    unsigned = typed_value("after", "u", spark_type("bigint(20) unsigned"))
    flag = typed_value("after", "t", spark_type("tinyint(1)"))
    tiny = typed_value("after", "t", spark_type("tinyint(1)", tinyint1_not_bool=True))
    return c.groupBy("o_custkey").agg(
        F.max(unsigned).alias("biggest"), F.bool_and(flag).alias("all_odd"), F.max(tiny).cast("bigint").alias("tiny")
    )


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))


@query("s19_reformat_day", """SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS text FROM orders""")
def s19_reformat_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_days(spark, sf_dir).select("o_orderkey", dates.reformat("d", "yyyy-MM-dd", "dd.MM.yyyy").alias("text"))


@query("s20_epoch_text", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text, strftime(ts, '%Y%m%d') AS day_text FROM events""")
def s20_epoch_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return ev.select(
        "event_id", dates.epoch_ms_text("ms").alias("text"), dates.epoch_ms_text("ms", "yyyyMMdd").alias("day_text")
    )


@query("s21_offset_day", """SELECT o_orderkey,
      strftime(o_orderdate + to_days(CAST(o_orderkey % 90 - 45 AS INTEGER)), '%Y-%m-%d') AS moved,
      strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d') || ' 08:30:00' AS day_before FROM orders""")
def s21_offset_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = (F.col("o_orderkey") % 90 - 45).cast("int")
    return _order_days(spark, sf_dir).select(
        "o_orderkey", dates.offset_day("d", days).alias("moved"),
        dates.offset_day_at("o_orderdate", -1, 8, 30).alias("day_before"),
    )


@query("s22_day_difference", """SELECT o_orderkey, (epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1998-01-01')) // 1000 AS ms,
      date_diff('day', DATE '1998-01-01', CAST(o_orderdate AS DATE)) AS days FROM orders""")
def s22_day_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.lit("1998-01-01")
    return _order_days(spark, sf_dir).select(
        "o_orderkey", dates.diff_ms("d", base).alias("ms"), dates.diff_days("d", base).cast("bigint").alias("days")
    )


@query("s23_weekday", """SELECT o_orderkey, CAST(dayofweek(o_orderdate) AS BIGINT) AS weekday FROM orders""")
def s23_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_days(spark, sf_dir).select("o_orderkey", dates.weekday("o_orderdate").cast("bigint").alias("weekday"))


@query("s24_fits_format", """SELECT user_id, CAST(sum(CASE WHEN event_id % 101 <> 0 AND event_id % 103 <> 0
      AND event_id % 9 = 5 THEN 1 ELSE 0 END) AS BIGINT) AS dashed_days FROM events GROUP BY user_id""")
def s24_fits_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loose_events(spark, sf_dir).groupBy("user_id").agg(
        F.count_if(dates.fits_format("add_time", "yyyy-MM-dd")).alias("dashed_days")
    )


@query("s25_ms_since_midnight", """SELECT event_id,
      epoch_us(ts) // 1000 - epoch_us(date_trunc('day', ts)) // 1000 AS ms FROM events""")
def s25_ms_since_midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", dates.ms_since_midnight("ts").alias("ms"))


@query("s26_epoch_and_local", """SELECT event_id, epoch_us(ts) // 1000 - 28800000 + 5000 AS ms,
      strftime(ts, '%Y-%m-%d %H:%M') AS minute_text FROM events""")
def s26_epoch_and_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    back = dates.epoch_ms_to_local(F.unix_millis(F.col("ts").cast("timestamp")))
    return ev.select(
        "event_id", dates.local_to_epoch_ms("ts", plus_ms=5000).alias("ms"),
        F.date_format(back, "yyyy-MM-dd HH:mm").alias("minute_text"),
    )
