"""Reading the log: decode, source filter, start modes, snapshots, discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import raw_value, typed_value
from tidemark.operators.row_kinds import Projection, current_state, to_row_kinds
from tidemark.operators.schema import Field, TableSchema
from tidemark.queries.eventlog import LOG, ROUTES, SERVER, ddl_log, event_log
from tidemark.queries.registry import query, table
from tidemark.sources.changelog import decode, row_changes, schema_changes, source_filter
from tidemark.sources.chunks import beyond_high, chunk_bounds, chunk_counts, key_sketch, stitch, up_to_high, with_chunk
from tidemark.sources.discovery import discover, from_server_zone, snapshot_changes, snapshot_chunks
from tidemark.sources.offsets import Start, snapshot_then_log


def changes(spark: SparkSession, sf_dir: str, before: str = "key") -> DataFrame:
    return row_changes(decode(event_log(spark, sf_dir, before)))


def _per_table(df: DataFrame) -> DataFrame:
    return df.groupBy("tbl").agg(
        F.count(F.lit(1)).alias("changes"),
        F.min(F.struct("file_no", "pos", "row")).alias("first"),
        F.max("ts_ms").alias("last_ms"),
    ).select(
        "tbl", "changes", F.col("first.file_no").alias("first_file"), F.col("first.pos").alias("first_pos"),
        F.col("first.row").cast("bigint").alias("first_row"), "last_ms",
    )


def _per_table_sql(where: str) -> str:
    return f"""WITH {LOG}, picked AS (SELECT * FROM log WHERE {where}),
      firsts AS (SELECT tbl, count(*) AS changes, min(event_id) AS e, max(ts_ms) AS last_ms FROM picked GROUP BY tbl)
    SELECT f.tbl, f.changes, l.file_no AS first_file, l.pos AS first_pos, l.row AS first_row, f.last_ms
    FROM firsts f JOIN log l ON l.event_id = f.e"""


@query("r04_decode_rows", f"""WITH {LOG}
    SELECT db, tbl, CASE WHEN gone THEN 'd' ELSE 'u' END AS op, k,
      CASE WHEN gone THEN NULL ELSE v1 END AS v1, CASE WHEN gone THEN NULL ELSE val END AS val,
      ts_ms, file_no, pos, row FROM log""")
def r04_decode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = changes(spark, sf_dir)
    key = F.coalesce(typed_value("after", "k", T.LongType()), typed_value("before", "k", T.LongType()))
    return c.select(
        "db", "tbl", "op", key.alias("k"),
        typed_value("after", "v1", T.StringType()).alias("v1"),
        typed_value("after", "val", T.DoubleType()).alias("val"),
        "ts_ms", "file_no", "pos", F.col("row").cast("bigint").alias("row"),
    )


@query("r04_before_images", f"""WITH {LOG},
    p AS (SELECT *, lag(event_id) OVER w AS pe, lag(gone) OVER w AS pg, lag(v1) OVER w AS pv1, lag(val) OVER w AS pval
          FROM log WINDOW w AS (PARTITION BY k ORDER BY event_id))
    SELECT CASE WHEN gone AND (pe IS NULL OR pg) THEN NULL ELSE k END AS k, file_no, pos, row,
      CASE WHEN gone THEN 'd' WHEN pe IS NULL OR pg THEN 'c' ELSE 'u' END AS op,
      CASE WHEN pe IS NULL OR pg THEN NULL ELSE pv1 END AS old_v1,
      CASE WHEN pe IS NULL OR pg THEN NULL ELSE pval END AS old_val
    FROM p""")
def r04_before_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before images of updates and deletes. A delete of a row that is not there has no image at all."""
    c = changes(spark, sf_dir, "full")
    key = F.coalesce(*[typed_value(image, "k", T.LongType()) for image in ("after", "before")])
    return c.select(
        key.alias("k"), "file_no", "pos", F.col("row").cast("bigint").alias("row"),
        "op", raw_value("before", "v1").alias("old_v1"),
        typed_value("before", "val", T.DoubleType()).alias("old_val"),
    )


@query("r05_schema_changes", f"""WITH {LOG},
    alters AS (SELECT * FROM log WHERE v1 = 'signup'),
    cols AS (
      SELECT tbl, event_id, 'k' AS "column", 'BIGINT' AS type, NULL AS length, 1 AS position, false AS nullable FROM alters
      UNION ALL SELECT tbl, event_id, 'v1', 'VARCHAR', 10 + (event_id // 50) % 20, 2, true FROM alters
      UNION ALL SELECT tbl, event_id, 'val', 'DOUBLE', NULL, 3, true FROM alters
      UNION ALL SELECT tbl, event_id, 'add_time', 'VARCHAR', 30, 4, true FROM alters
      UNION ALL SELECT tbl, event_id, 'extra_' || (event_id % 7), 'INT', NULL, 5, true FROM alters)
    SELECT tbl, "column", type, CAST(max(length) AS BIGINT) AS length, CAST(min(position) AS BIGINT) AS position,
      bool_and(nullable) AS nullable, count(*) AS alters
    FROM cols GROUP BY tbl, "column", type""")
def r05_schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = event_log(spark, sf_dir).unionByName(ddl_log(spark, sf_dir))
    return schema_changes(decode(mixed)).groupBy("tbl", "column", "type").agg(
        F.max("length").cast("bigint").alias("length"), F.min("position").cast("bigint").alias("position"),
        F.bool_and("nullable").alias("nullable"), F.count(F.lit(1)).alias("alters"),
    )


@query("r06_source_filter", _per_table_sql("db = 'ods_test' AND (tbl = 'test_d_1' OR regexp_full_match(tbl, 'other_[12]'))"))
def r06_source_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_table(source_filter(changes(spark, sf_dir), "ods_.+", ["test_d_1", "other_[12]"]))


ORDER_FIELDS = [
    Field("k", T.LongType(), False, "bigint"), Field("label", T.StringType(), True, "text"),
    Field("amount", T.DoubleType(), True, "double"),
]


ORDERS_AS_ROWS = Projection(TableSchema(ORDER_FIELDS, ["k"]))


def _order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes of the customer rows: each order updates its customer, some delete it."""
    o = table(spark, sf_dir, "orders")
    image = F.struct(
        F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("label"), F.col("o_totalprice").alias("amount")
    )
    deletes = F.col("o_orderkey") % 11 == 0
    payload = F.struct(
        F.when(deletes, "d").otherwise("u").alias("op"),
        F.struct(F.col("o_custkey").alias("k")).alias("before"),
        F.when(~deletes, image).alias("after"),
        F.struct(
            F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"), F.lit("shop").alias("db"),
            F.lit("customer").alias("table"), F.lit("bin.000001").alias("file"),
            (F.col("o_orderkey") + 1).alias("pos"), F.lit(0).alias("row"),
        ).alias("source"),
    )
    text = F.to_json(F.struct(payload.alias("payload")), {"ignoreNullFields": "false"})
    return row_changes(decode(o.select(text.alias("value"))))


@query("r07_snapshot_plus_log", """WITH c AS (
      SELECT c_custkey AS k, c_mktsegment AS label, c_acctbal AS amount, -1 AS o, false AS gone FROM customer
      UNION ALL SELECT o_custkey, o_orderpriority, o_totalprice, o_orderkey, o_orderkey % 11 = 0 FROM orders)
    SELECT k, label, amount FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o DESC) AS rn FROM c)
    WHERE rn = 1 AND NOT gone""")
def r07_snapshot_plus_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("label"), F.col("c_acctbal").alias("amount")
    )
    both = snapshot_then_log(snapshot_changes(customers, "shop", "customer"), _order_changes(spark, sf_dir))
    return current_state(to_row_kinds(both, Projection(TableSchema(ORDER_FIELDS, ["k"]))), ["k"])


@query("r08_from_earliest", _per_table_sql("true"))
def r08_from_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_table(changes(spark, sf_dir).where(Start("earliest-offset").condition()))


@query("r09_from_latest", _per_table_sql("event_id > (SELECT max(event_id) FROM log WHERE ts < TIMESTAMP '2024-01-15')"))
def r09_from_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log up to a day is what the job sees at its start; only later changes count."""
    c = changes(spark, sf_dir)
    day = 1705276800000
    start = Start("latest-offset").resolve(c.where(F.col("ts_ms") < day))
    return _per_table(c.where(start.condition()))


@query("r10_from_offset", _per_table_sql("file_no > 2 OR (file_no = 2 AND (pos > 104 OR (pos = 104 AND row >= 1)))"))
def r10_from_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File and position, then four more events and one row skipped."""
    c = changes(spark, sf_dir)
    start = Start("specific-offset", file_no=2, pos=100, skip_events=4, skip_rows=1)
    return _per_table(c.where(start.resolve(c).condition()))


@query("r10_from_gtid_set", _per_table_sql("NOT (txn BETWEEN 1 AND 1200 OR txn BETWEEN 1500 AND 1600 OR txn = 2000)"))
def r10_from_gtid_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = Start("specific-offset", gtid_set=f"{SERVER}:1-1200:1500-1600:2000,another:1-9999999")
    return _per_table(changes(spark, sf_dir).where(start.condition()))


@query("r11_from_timestamp", _per_table_sql("ts_ms >= 1705708800000"))
def r11_from_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = {"scan.startup.mode": "timestamp", "scan.startup.timestamp-millis": "1705708800000"}
    return _per_table(changes(spark, sf_dir).where(Start.from_options(options).condition()))


@query("r13_snapshot_chunks", """SELECT (o_orderkey - m) // 4096 AS chunk, min(o_orderkey) AS first_key,
      max(o_orderkey) AS last_key, count(*) AS rows
    FROM orders, (SELECT min(o_orderkey) AS m FROM orders) GROUP BY 1""")
def r13_snapshot_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_chunks(table(spark, sf_dir, "orders"), "o_orderkey", 4096)


# Keys that are dense, sparse with ever wider gaps, and text.
KEYS = {"dense": "o_orderkey", "sparse": "o_orderkey * o_orderkey * 1000 + 7", "text": "o_orderpriority || '/' || o_orderkey"}


def _chunks_sql(kind: str, key: str) -> str:
    return f"""SELECT '{kind}' AS kind, chunk, CAST(min(key) AS VARCHAR) AS first_key, CAST(max(key) AS VARCHAR) AS last_key, count(*) AS rows
      FROM (SELECT k.key, (SELECT count(*) FROM (SELECT DISTINCT key FROM (
          SELECT key, row_number() OVER (ORDER BY key) - 1 AS place FROM (SELECT {key} AS key FROM orders)
          WHERE CAST('0x' || substr(md5(CAST(key AS VARCHAR)), 1, 8) AS BIGINT) % 1000 < 64) WHERE place % 64 = 0 AND place > 0) cuts
        WHERE cuts.key <= k.key) AS chunk FROM (SELECT {key} AS key FROM orders) k) GROUP BY chunk"""


@query("r13_quantile_chunks", " UNION ALL ".join(_chunks_sql(*k) for k in KEYS.items()))
def r13_quantile_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of about equal row counts by a sketch of the key, for keys of any spread and type."""
    out = None
    for kind, key in KEYS.items():
        orders = table(spark, sf_dir, "orders").select(F.expr(key).alias("key"))
        one = chunk_counts(orders, "key", 1000).select(
            F.lit(kind).alias("kind"), "chunk", F.col("first_key").cast("string"), F.col("last_key").cast("string"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


# Chunks of 50 customers, one begun after the other while orders come in; a row is read at some moment between the marks.
CHUNK = 50
MARKS = f"""ranked AS (SELECT c_custkey AS k, (row_number() OVER (ORDER BY c_custkey) - 1) // {CHUNK} AS chunk FROM customer),
    span AS (SELECT max(chunk) + 1 AS chunks, (SELECT max(o_orderkey) FROM orders) AS last FROM ranked),
    cuts AS (SELECT chunk, CASE WHEN chunk > 0 THEN min(k) ELSE -1 END AS first FROM ranked GROUP BY chunk),
    marks AS (SELECT chunk, first, 1 + last * chunk // (chunks + 2) AS low, 1 + last * (chunk + 2) // (chunks + 2) AS high FROM cuts, span)"""


def _marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    bounds = chunk_bounds(key_sketch(customers, "c_custkey", CHUNK), CHUNK)
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("newest"), F.lit(bounds.count()).alias("chunks"))

    def mark(pos: str) -> Column:
        return F.struct(F.lit(1).cast("bigint").alias("file_no"), F.expr(pos).cast("bigint").alias("pos"), F.lit(0).alias("row"))

    low, high = "1 + newest * chunk div (chunks + 2)", "1 + newest * (chunk + 2) div (chunks + 2)"
    return bounds.join(F.broadcast(last), F.lit(True)).select("chunk", "first", "last", mark(low).alias("low"), mark(high).alias("high"))


def _stitched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers read in chunks, each row as it was at some moment between the marks of its chunk, and the orders as the
    log, which begins at the least mark."""
    marks = _marks(spark, sf_dir)
    log = _order_changes(spark, sf_dir)
    key = F.coalesce(*[typed_value(image, "k", T.LongType()) for image in ("after", "before")])
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("label"), F.col("c_acctbal").alias("amount"))
    dated = with_chunk(log.withColumn("k", key), F.col("k"), marks, "low", "high")
    read_at = F.col("low.pos") + F.col("k") * 7919 % (F.col("high.pos") - F.col("low.pos") + 1)
    before = dated.where(F.col("pos") <= read_at).drop("k", "chunk", "low", "high")
    seen = current_state(to_row_kinds(snapshot_changes(customers, "shop", "customer").unionByName(before), ORDERS_AS_ROWS), ["k"])
    least = marks.agg(F.min("low").alias("least")).first()["least"]
    tail = log.where(F.col("pos") > least["pos"])
    return stitch(snapshot_changes(seen, "shop", "customer"), tail, typed_value("after", "k", T.LongType()), key, marks)


@query("r07_chunks_at_high", f"""WITH {MARKS}, c AS (
      SELECT c_custkey AS k, c_mktsegment AS label, c_acctbal AS amount, -1 AS o, false AS gone FROM customer
      UNION ALL SELECT o_custkey, o_orderpriority, o_totalprice, o_orderkey, o_orderkey % 11 = 0 FROM orders),
    upto AS (SELECT c.* FROM c JOIN marks m ON m.chunk = (SELECT count(*) - 1 FROM cuts WHERE cuts.first <= c.k) WHERE c.o + 1 <= m.high)
    SELECT k, label, amount FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o DESC) AS rn FROM upto) WHERE rn = 1 AND NOT gone""")
def r07_chunks_at_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk as the source was at the chunk's own high mark."""
    rows = to_row_kinds(up_to_high(_stitched(spark, sf_dir)), ORDERS_AS_ROWS)
    return current_state(rows, ["k"])


@query("r07_stitched_chunks", """WITH c AS (
      SELECT c_custkey AS k, c_mktsegment AS label, c_acctbal AS amount, -1 AS o, false AS gone FROM customer
      UNION ALL SELECT o_custkey, o_orderpriority, o_totalprice, o_orderkey, o_orderkey % 11 = 0 FROM orders)
    SELECT k, label, amount FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o DESC) AS rn FROM c)
    WHERE rn = 1 AND NOT gone""")
def r07_stitched_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks at their high marks first, then for each chunk the log behind its mark: the state of the source now."""
    stitched = _stitched(spark, sf_dir)
    chunks = current_state(to_row_kinds(up_to_high(stitched), ORDERS_AS_ROWS), ["k"])
    both = snapshot_then_log(snapshot_changes(chunks, "shop", "customer"), beyond_high(stitched).drop("chunk", "low", "high"))
    return current_state(to_row_kinds(both, ORDERS_AS_ROWS), ["k"])


@query("r15_discover_tables", f"""WITH {LOG}, names AS (SELECT DISTINCT db, tbl FROM log)
    SELECT db, tbl,
      (CASE WHEN regexp_full_match(tbl, 'test_d_(\\d+)$') THEN 1 ELSE 0 END)
        + (CASE WHEN tbl = 'test_d_1' THEN 1 ELSE 0 END) AS patterns,
      CASE WHEN regexp_full_match(tbl, 'test_d_(\\d+)$') THEN 'matched' ELSE 'excluded' END AS status
    FROM names""")
def r15_discover_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discover(changes(spark, sf_dir), "ods_test", ROUTES)
    return found.select("db", "tbl", F.size("patterns").alias("patterns"), "status")


@query("r16_server_zone", """SELECT event_id, epoch_us(ts - INTERVAL 8 HOUR) AS at_us,
      strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%d') AS utc_day FROM events""")
def r16_server_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    at = from_server_zone("ts", "Asia/Shanghai")
    return ev.select("event_id", F.unix_micros(at).alias("at_us"), at.cast("date").cast("string").alias("utc_day"))
