import pytest
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.operators import schema as S
from tidemark.operators.schema import Field, IncompatibleSchema, TableSchema
from tidemark.sources.changelog import decode, row_changes, schema_changes
from tidemark.sources.discovery import jdbc_properties, snapshot_options, source_schemas, strip_prefix

INT, LONG = T.IntegerType(), T.LongType()


def table(*fields, key=("k",)):
    return TableSchema([Field(n, t, n not in key) for n, t in fields], list(key))


SHARDS = {
    ("s1", "t1"): table(("k", INT), ("v1", T.VarcharType(10))),
    ("s2", "t1"): table(("k", INT), ("v1", T.VarcharType(20)), ("v2", LONG)),
    ("s1", "t2"): table(("k", LONG), ("v1", T.DoubleType())),
    ("s2", "t3"): table(("k", INT), key=()),
}


def test_shards_of_one_name_merge():
    merged = S.merge_shards(SHARDS)
    assert set(merged) == {"t1", "t2"}
    assert [(f.name, f.dtype.simpleString()) for f in merged["t1"].fields] == [
        ("k", "int"), ("v1", "varchar(20)"), ("v2", "bigint")]
    assert merged["t1"].primary_key == ["k"]


def test_differing_keys_drop_the_key():
    merged = S.merge(table(("a", INT), ("b", INT), key=("a", "b")), table(("a", INT), key=("a",)))
    assert merged.primary_key == []
    with pytest.raises(ValueError, match="no primary key"):
        S.build_target(merged)


def test_incompatible_sources_and_targets():
    source = table(("k", INT), ("v1", T.VarcharType(10)))
    target = table(("k", T.StringType()), ("v1", T.StringType()))
    assert not S.accept(source.fields, target, ignore_incompatible=True)
    with pytest.raises(IncompatibleSchema, match="column k: int does not fit string"):
        S.accept(source.fields, target)
    assert S.problems([Field("new", INT)], target) == ["no column new in the target"]
    with pytest.raises(IncompatibleSchema):
        S.merge(table(("v1", T.TimestampNTZType())), table(("v1", INT)))
    with pytest.raises(IncompatibleSchema):
        S.merge_all([])


def test_target_schema_order_and_key():
    source = table(("k", INT), ("V1", T.VarcharType(10)))
    built = S.build_target(source, [("dt", T.StringType())], {"TABLE": "src", "BINLOG_TIME": "at"}, ["dt", "k"], case_sensitive=False)
    assert built.names == ["k", "v1", "dt", "src", "at"]
    assert built.primary_key == ["dt", "k"] and built.get("v1").names == ("V1",)
    assert not built.get("src").nullable and built.get("at").nullable
    with pytest.raises(ValueError, match="primary key"):
        S.build_target(source, primary_key=["nope"])
    with pytest.raises(ValueError, match="clash"):
        S.build_target(table(("k", INT), ("K", INT)), case_sensitive=False)
    # metadata columns do not count for the key
    with pytest.raises(ValueError):
        S.build_target(source, metadata={"TABLE": "src"}, primary_key=["src"])


def test_evolution_is_idempotent_and_widens_only():
    start = table(("k", INT), ("v1", T.VarcharType(10)))
    once = S.evolve(start, [Field("v2", INT), Field("v1", T.VarcharType(20))])
    assert once == S.evolve(once, [Field("v2", INT), Field("v1", T.VarcharType(10))])
    assert S.evolve(once, [Field("v2", LONG)]).get("v2").dtype == LONG
    with pytest.raises(IncompatibleSchema):
        S.evolve(once, [Field("v2", T.StringType())])


def test_options_and_comments_carry_over():
    s = TableSchema([Field("k", INT, False, comment="the key"), Field("v", T.VarcharType(9))], ["k"], {"a": "1"}, "note")
    built = S.build_target(s, options={"bucket": "3"})
    assert built.options == {"bucket": "3", "a": "1"} and built.comment == "note"
    struct = built.struct()
    assert struct["k"].metadata == {"comment": "the key"} and struct["v"].metadata == {"length": 9}
    assert struct["v"].dataType == T.StringType()


def test_schema_change_entries(spark, log):
    log.alter("t1", [("k", "INT", None), ("_new", "TINYINT", 1)])
    got = schema_changes(decode(log.frame())).sort("position").collect()
    assert [(r.db, r.tbl, r.column, r.type, r.length, r.nullable) for r in got] == [
        ("ods", "t1", "k", "INT", None, False), ("ods", "t1", "_new", "TINYINT", 1, True)]
    assert [f.dtype for f in S.changed_fields(got)] == [INT, T.BooleanType()]
    assert [f.dtype for f in S.changed_fields(got, tinyint1_not_bool=True)] == [INT, T.ByteType()]


def test_inferred_fields(spark, log):
    log.insert("t1", k=1, v="a").insert("t1", k=2, w=1.5)
    got = rows(S.infer_fields(row_changes(decode(log.frame()))), "column", "type")
    assert got == [("k", "BIGINT"), ("v", "STRING"), ("w", "DECIMAL(2,1)")]


def test_source_schemas_from_a_column_list(spark):
    columns = spark.createDataFrame(
        [("d", "t", "v", "varchar(10)", 2, True, False, "c"), ("d", "t", "k", "int(11)", 1, False, True, None)],
        "db string, tbl string, column string, type string, position int, nullable boolean, is_key boolean, comment string")
    found = source_schemas(columns)[("d", "t")]
    assert found.names == ["k", "v"] and found.primary_key == ["k"] and found.get("v").comment == "c"


def test_source_options():
    assert strip_prefix({"debezium.a": "1", "b": "2"}, "debezium.") == {"a": "1"}
    assert jdbc_properties({"jdbc.properties.x": "1"}, True) == {"x": "1", "tinyInt1isBit": "false"}
    with pytest.raises(ValueError):
        jdbc_properties({"jdbc.properties.tinyInt1isBit": "true"}, True)
    assert snapshot_options(1, 100, 30, "id")["numPartitions"] == "4"


def test_types_gathered_batch_by_batch(spark, tmp_path):
    from pyspark.sql import functions as F
    from tidemark.operators.schema import TypeRegistry, infer_fields, inferred_dtype

    images = ['{"a":1,"b":null}', '{"a":2.5,"c":"x"}', '{"a":123456,"b":[1]}', '{"c":7}', '{"a":0.125,"d":{"e":1}}', '{"b":true}']
    rows = spark.createDataFrame([("s1" if k % 2 else "s2", "t", v) for k, v in enumerate(images * 3)], "db string, tbl string, v string")
    rows = rows.select("db", "tbl", F.parse_json("v").alias("after")).cache()
    registry = TypeRegistry(spark, str(tmp_path / "types"))
    assert registry.types().count() == 0
    parts = [rows.where(F.to_json("after") == v) for v in images]
    told = [sorted((r.db, r.column, r.old_type, r.type) for r in registry.add(p).collect()) for p in parts + parts]
    once = sorted(map(tuple, infer_fields(rows).collect()))
    assert sorted(map(tuple, registry.types().collect())) == once
    assert told[0] == [("s2", "a", None, "BIGINT"), ("s2", "b", None, "VOID")] and told[len(parts):] == [[]] * len(parts)
    assert [inferred_dtype(t) and inferred_dtype(t).simpleString() for t in ("VOID", "BIGINT", "DECIMAL(9,3)", "ARRAY<BIGINT>", "VARIANT", "STRING")] == [
        None, "bigint", "decimal(9,3)", "string", "string", "string"]
