import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Log:
    """Builds a small change log; positions count up."""

    def __init__(self, spark, db="ods"):
        self.spark, self.db, self.pos, self.entries = spark, db, 0, []

    def _source(self, tbl, db=None):
        self.pos += 1
        return {"db": db or self.db, "table": tbl, "ts_ms": 1726239466000 + self.pos, "file": "bin.000001",
                "pos": self.pos, "row": 0, "snapshot": "false"}

    def row(self, tbl, op, before=None, after=None, db=None):
        self.entries.append(json.dumps(
            {"payload": {"op": op, "before": before, "after": after, "source": self._source(tbl, db)}}))
        return self

    def insert(self, tbl, db=None, **after):
        return self.row(tbl, "c", None, after, db)

    def update(self, tbl, before, after, db=None):
        return self.row(tbl, "u", before, after, db)

    def delete(self, tbl, db=None, **before):
        return self.row(tbl, "d", before, None, db)

    def alter(self, tbl, columns, db=None, key=("k",)):
        cols = [{"name": n, "typeName": t, "typeExpression": t, "length": length, "position": i + 1, "optional": n not in key}
                for i, (n, t, length) in enumerate(columns)]
        history = {"databaseName": db or self.db, "ddl": f"ALTER TABLE {tbl}", "tableChanges": [
            {"type": "ALTER", "id": f'"{db or self.db}"."{tbl}"',
             "table": {"primaryKeyColumnNames": list(key), "columns": cols}}]}
        self.entries.append(json.dumps({"payload": {"source": self._source(tbl, db), "historyRecord": json.dumps(history)}}))
        return self

    def frame(self):
        df = self.spark.createDataFrame([(e,) for e in self.entries], "value string")
        self.entries = []
        return df


@pytest.fixture
def log(spark):
    return Log(spark)


@pytest.fixture
def new_log(spark):
    return lambda **kw: Log(spark, **kw)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)
