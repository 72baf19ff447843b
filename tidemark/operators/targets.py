"""Stored targets: keyed Parquet tables with upserts, deletes, evolution and atomic commits.

Layout of a target folder::

    data/__version=<n>-<attempt>/<day>=<value>/__cell=<bucket>/*.parquet    rows that a writer of commit n wrote
    commits/<n>.json                                  schema, live cells, last batch of each stream

Every write has a folder of its own, which only its commit names. Of two writers of one version the second to
commit fails, and the rows of the first are untouched.

A cell is one hash bucket of one day. Commit files hold one short entry per live cell, never per row or file. Readers see
a commit once its file has its final name. The option ``merge`` says when a batch meets the rows that are there:

- ``on-read``: a batch writes its own latest row per key, deletes included, beside the others, and reads nothing. Readers
  take the latest row of each key. ``fold`` merges on demand the cells that have gathered several writes.
- ``on-write``: a commit rewrites the cells its keys fall in and keeps the others by reference, so reading needs no merge.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import same_family, same_text, storage_type
from tidemark.operators.row_kinds import DELETE, KIND, ORDER, UPSERT, latest_per_key
from tidemark.operators.schema import Field, IncompatibleSchema, TableSchema, evolve

VERSION, CELL = "__version", "__cell"
DELETED = "_deleted"
# Options of a target.
MERGE, ON_READ, ON_WRITE = "merge", "on-read", "on-write"
MERGE_KEY, BUSINESS = "merge-key", "business"  # rows of one key are merged across days
HORIZON = "horizon"  # file number and position below which changes are too old to be told apart
#: Text that Spark takes over into a folder name unchanged.
PLAIN_DAY = re.compile(r"""[^\x00-\x1f\x7f"#%'*/:=?\\{\[\]^]+""")
ORDER_TYPES = {"_file_no": T.LongType(), "_pos": T.LongType(), "_row": T.IntegerType(), "_seq": T.IntegerType()}


@dataclass
class Commit:
    """One state of a target."""

    version: int
    schema: TableSchema
    day: str | None
    buckets: int
    keep_positions: bool = False
    # write -> live cells of it, as [day, bucket]; and how many cells that write had at first
    cells: dict[str, list[tuple[str | None, int]]] = field(default_factory=dict)
    written: dict[str, int] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    # column -> [last version, type] of every type that it was written under before the present one
    types: dict[str, list[tuple[int, str]]] = field(default_factory=dict)

    def stored_types(self, write: str) -> dict[str, str]:
        """C-10: columns that a write holds under another type than they have now."""
        version = int(write.partition("-")[0])
        found = {}
        for column, known in self.types.items():
            for until, kind in reversed(known):
                if version <= until:
                    found[column] = kind
        return found

    @property
    def on_read(self) -> bool:
        return self.schema.options.get(MERGE) == ON_READ

    @property
    def business_key(self) -> list[str]:
        return [k for k in self.schema.primary_key if k != self.day]

    @property
    def merge_key(self) -> list[str]:
        return self.business_key if self.schema.options.get(MERGE_KEY) == BUSINESS else list(self.schema.primary_key)

    @property
    def horizon(self) -> tuple[int, int] | None:
        text = self.schema.options.get(HORIZON)
        return tuple(int(n) for n in text.split(":")) if text else None

    def with_options(self, **options: str) -> Commit:
        named = {k.replace("_", "-"): v for k, v in options.items()}
        return replace(self, schema=replace(self.schema, options={**self.schema.options, **named}))

    def to_json(self) -> str:
        fields = [{**asdict(f), "dtype": f.dtype.simpleString()} for f in self.schema.fields]
        body = {**self.__dict__, "schema": {**self.schema.__dict__, "fields": fields}}
        return json.dumps(body)

    @classmethod
    def from_json(cls, text: str) -> Commit:
        body = json.loads(text)
        s = body.pop("schema")
        fields = [
            Field(**{**f, "dtype": T.DataType.fromDDL(f["dtype"]), "spellings": tuple(f["spellings"])})
            for f in s.pop("fields")
        ]
        cells = {v: [(d, b) for d, b in c] for v, c in body.pop("cells").items()}
        body["types"] = {c: [(v, t) for v, t in known] for c, known in body.get("types", {}).items()}
        return cls(schema=TableSchema(fields, **s), cells=cells, **body)


class Target:
    """A stored target table. One writer at a time; a second one fails at its commit and changes nothing."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    # --- commits --------------------------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def exists(self) -> bool:
        fs, path = self._fs(f"{self.path}/commits")
        return fs.exists(path)

    def _latest(self) -> str:
        fs, path = self._fs(f"{self.path}/commits/*.json")
        found = fs.globStatus(path)
        if not found:
            raise FileNotFoundError(f"no target at {self.path}; create it first")
        return max(s.getPath().toString() for s in found)

    def current(self) -> Commit:
        fs, path = self._fs(self._latest())
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Commit.from_json(text)

    def _commit(self, commit: Commit) -> None:
        final = f"{self.path}/commits/{commit.version:012d}.json"
        fs, draft = self._fs(f"{self.path}/commits/.{commit.version:012d}-{uuid.uuid4().hex}.draft")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(commit.to_json().encode()))
        finally:
            out.close()
        place = self._fs(final)[1]
        if fs.exists(place) or not fs.rename(draft, place):
            fs.delete(draft, False)
            raise RuntimeError(f"commit {commit.version} of {self.path} was taken by another writer")

    def create(
        self, schema: TableSchema, buckets: int, day: str | None = None, keep_positions: bool = False, merge: str | None = None
    ) -> Target:
        """C-14, C-15: a new empty target. The bucket count is fixed and must be positive. ``merge`` is the option of that
        name; without either, batches are merged on writing."""
        merge = merge or schema.options.get(MERGE, ON_WRITE)
        if merge not in (ON_READ, ON_WRITE):
            raise ValueError(f"unknown way to merge: {merge}")
        schema = replace(schema, options={**schema.options, MERGE: merge})
        if buckets is None or int(buckets) <= 0:
            raise ValueError(f"only targets with a fixed number of buckets are supported: {self.path}")
        taken = {VERSION, CELL, DELETED, KIND, *ORDER} & set(schema.names)
        if taken:
            raise ValueError(f"column names {sorted(taken)} are reserved")
        if not schema.primary_key:
            raise ValueError(f"a target needs a primary key: {self.path}")
        if day is not None and day not in schema.primary_key:
            raise ValueError(f"the day column {day} must be part of the primary key")
        if not (set(schema.primary_key) - {day}):
            raise ValueError("the primary key needs a column besides the day")
        if self.exists():
            raise FileExistsError(f"there is a target at {self.path}")
        self._commit(Commit(0, schema, day, int(buckets), keep_positions))
        return self

    # --- reading --------------------------------------------------------------------------------

    def read(self) -> DataFrame:
        """W-12: the current rows under the current schema; columns newer than a file read as NULL."""
        commit = self.current()
        rows = self._rows(commit, commit.cells, whole=True, versions=commit.on_read)
        if commit.on_read:
            rows = _latest_written(commit, rows)
        if commit.on_read or commit.keep_positions:
            rows = rows.where(~F.col(DELETED))
        return rows.select(*commit.schema.names)

    def deletes(self) -> DataFrame:
        """T-05: keys of deleted rows that are still remembered, with their positions where these are kept."""
        commit = self.current()
        if not (commit.on_read or commit.keep_positions):
            raise ValueError("this target remembers no deletes")
        rows = self._rows(commit, commit.cells, whole=True, versions=commit.on_read)
        rows = _latest_written(commit, rows) if commit.on_read else rows
        return rows.where(DELETED).select(*commit.merge_key, *(ORDER if commit.keep_positions else ()))

    def placement(self) -> DataFrame:
        """W-04: stored rows with their cell, and whether it is the bucket of their key."""
        commit = self.current()
        rows = self._rows(commit, commit.cells, whole=True)
        return rows.withColumn("in_place", F.col(CELL) == bucket_of(commit.business_key, commit.buckets))

    def _struct(self, commit: Commit) -> T.StructType:
        struct = T.StructType(list(commit.schema.struct().fields))
        if commit.keep_positions:
            for name, dtype in ORDER_TYPES.items():
                struct = struct.add(name, dtype)
        if commit.keep_positions or commit.on_read:
            struct = struct.add(DELETED, T.BooleanType())
        return struct.add(CELL, T.IntegerType())

    def _rows(
        self, commit: Commit, cells: dict[str, list[tuple[str | None, int]]], whole: bool, versions: bool = False
    ) -> DataFrame:
        """Rows of the given cells, with the write they are from if ``versions``. A write that is wholly live is read as
        one folder."""
        paths: dict[tuple, list[str]] = {}  # by the types that writes hold
        for write, live in cells.items():
            folder = f"{self.path}/data/{VERSION}={write}"
            mine = paths.setdefault(tuple(sorted(commit.stored_types(write).items())), [])
            if whole and len(live) == commit.written.get(write):
                mine.append(folder)
            else:
                mine += [folder + self._cell_path(commit.day, d, b) for d, b in live]
        struct = self._struct(commit).add(VERSION, T.StringType())
        found = None
        for kinds, mine in paths.items():
            old = {c: T.DataType.fromDDL(kind) for c, kind in kinds}
            stored = T.StructType([T.StructField(f.name, old.get(f.name, f.dataType), f.nullable, f.metadata) for f in struct.fields])
            part = self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*mine)
            part = part.withColumns({c: F.col(c).cast(struct[c].dataType) for c in old}) if old else part
            found = part if found is None else found.unionByName(part)
        if found is None:
            found = self.spark.createDataFrame([], struct)
        return found if versions else found.drop(VERSION)

    @staticmethod
    def _cell_path(day: str | None, value: str | None, bucket: int) -> str:
        return (f"/{day}={value}" if day else "") + f"/{CELL}={bucket}"

    # --- writing --------------------------------------------------------------------------------

    def evolve(self, fields: Sequence[Field]) -> bool:
        """C-08..C-10: take over new columns and wider types. No data is rewritten: where the file reader cannot read a
        column under its wider type, the commit keeps the types that older writes hold, and they are cast on reading."""
        commit = self.current()
        schema = evolve(commit.schema, fields)
        if schema.fields == commit.schema.fields:
            return False
        types = dict(commit.types)
        for old in commit.schema.fields:
            new = schema.get(old.name).dtype
            if old.name in commit.schema.primary_key and new != old.dtype and not same_text(old.dtype, new):
                raise IncompatibleSchema(f"key column {old.name}: rows are placed by the text of {old.dtype.simpleString()}, which {new.simpleString()} changes")
            if not same_family(old.dtype, new):
                types[old.name] = [*types.get(old.name, []), (commit.version, storage_type(old.dtype).simpleString())]
        self._commit(replace(commit, version=commit.version + 1, schema=schema, types=types))
        return True

    def upsert(
        self,
        rows: DataFrame,
        batch: tuple[str, int] | None = None,
        parallelism: int | None = None,
        locate_moves: bool = False,
    ) -> bool:
        """W-01: apply row changes. Rows carry the target's columns, a kind and the log position.

        ``batch`` is (stream, number): a batch of the stream that is already in does nothing (W-08); without it
        every call counts. ``locate_moves`` is for logs without usable before images: the old day of a key is
        looked up in the target. A day that is NULL or cannot name a folder is refused and nothing is committed.
        """
        commit = self.current()
        if batch and commit.batches.get(batch[0], -1) >= batch[1]:
            return False
        if locate_moves and commit.on_read:
            commit = commit.with_options(merge_key=BUSINESS)  # readers find the one day of a key themselves
        key = list(commit.schema.primary_key)
        business = commit.business_key
        unique = business if locate_moves else commit.merge_key
        columns = commit.schema.names
        rows = rows.select(*columns, KIND, *ORDER)
        if commit.horizon:
            rows = rows.where(_order("_file_no", "_pos") >= _literal(commit.horizon))
        latest = latest_per_key(rows, unique)
        latest = latest.withColumn(CELL, bucket_of(business, commit.buckets))
        if commit.on_read or not commit.cells:
            # Nothing to merge with now: the rows stream through once.
            self._write(commit, self._merge(commit, latest, {}, key), set(), parallelism, batch)
            return True
        cached = [latest.persist(StorageLevel.MEMORY_AND_DISK)]
        try:
            changes = latest
            if locate_moves and commit.day:
                old = self._old_keys(commit, latest, business)
                if commit.keep_positions:
                    changes = _not_older(latest, old, business)
                moved = self._old_places(commit, changes, old, business)
                cached.append(moved.persist(StorageLevel.MEMORY_AND_DISK))
                changes = changes.unionByName(moved)
            touched = self._touched(commit, changes)
            if not touched:
                self._commit(self._next(commit, touched, None, [], batch))
                return True
            old_cells = {
                v: hit for v, live in commit.cells.items() if (hit := [c for c in live if tuple(c) in touched])
            }
            if commit.keep_positions and old_cells:
                changes = _not_older(changes, self._rows(commit, old_cells, whole=False), key)
                cached.append(changes.persist(StorageLevel.MEMORY_AND_DISK))
            self._write(commit, self._merge(commit, changes, old_cells, key), touched, parallelism, batch)
        finally:
            for df in cached:
                df.unpersist()
        return True

    def _write(
        self, commit: Commit, merged: DataFrame, touched: set, parallelism: int | None, batch: tuple[str, int] | None
    ) -> None:
        """Write the next version's cells, then commit it."""
        write = f"{commit.version + 1}-{uuid.uuid4().hex}"
        by = [commit.day, CELL] if commit.day else [CELL]
        out = rebalance(merged.select(*[f.name for f in self._struct(commit).fields]), by, parallelism)
        out.write.partitionBy(*by).parquet(f"{self.path}/data/{VERSION}={write}")
        self._commit(self._next(commit, touched, write, self._written(commit, write), batch))

    def _touched(self, commit: Commit, changes: DataFrame) -> set[tuple[str | None, int]]:
        """Cells that the changes fall in: at most days times buckets entries."""
        day = F.col(commit.day) if commit.day else F.lit(None).cast("string")
        found = {(r[0], r[1]) for r in changes.select(day, CELL).distinct().collect()}
        if commit.day:
            self._check_days(d for d, _ in found)
        return found

    def _check_days(self, days: Iterable[str | None]) -> None:
        """A day names a folder as it is: what would be written in another form could not be found again."""
        bad = [d for d in days if not d or not PLAIN_DAY.fullmatch(d) or d == "__HIVE_DEFAULT_PARTITION__"]
        if bad:
            raise ValueError(f"{self.path} cannot store rows of the days {bad[:5]}; a day is plain text such as 2024-09-13")

    def _merge(
        self, commit: Commit, changes: DataFrame, old_cells: dict[int, list[tuple[str | None, int]]], key: list[str]
    ) -> DataFrame:
        """Old rows whose key did not change, and the changes. The change side is one row per key."""
        if commit.keep_positions or commit.on_read:
            changes = changes.withColumn(DELETED, F.col(KIND) == DELETE)
        if not old_cells:
            return changes if commit.keep_positions or commit.on_read else changes.where(F.col(KIND) == UPSERT)
        old = self._rows(commit, old_cells, whole=False)
        o, c = old.alias("o"), changes.alias("c")
        kept = o.join(c, _same(key), "left_anti")
        if commit.keep_positions:
            return kept.unionByName(changes.drop(KIND))
        upserts = changes.where(F.col(KIND) == UPSERT).drop(KIND, *ORDER)
        return kept.unionByName(upserts)

    def _old_keys(self, commit: Commit, latest: DataFrame, business: list[str]) -> DataFrame:
        """Keys, days and, where kept, positions of stored rows in the touched buckets of all days."""
        buckets = {r[0] for r in latest.select(CELL).distinct().collect()}
        cells = {
            v: hit for v, live in commit.cells.items() if (hit := [c for c in live if c[1] in buckets])
        }
        kept = ORDER if commit.keep_positions else ()
        return self._rows(commit, cells, whole=False).select(F.col(commit.day).alias("_old_day"), *business, *kept)

    def _old_places(self, commit: Commit, changes: DataFrame, old: DataFrame, business: list[str]) -> DataFrame:
        """Deletes for stored rows of the same business key in other days, at the position of the change."""
        elsewhere = (F.col(KIND) == DELETE) | ~F.col("_old_day").eqNullSafe(F.col(commit.day))
        found = changes.join(old.drop(*ORDER), business).where(elsewhere)
        return found.select(
            *[F.col("_old_day").alias(commit.day) if n == commit.day else F.col(n) for n in commit.schema.names],
            F.lit(DELETE).alias(KIND), *ORDER, CELL,
        )

    def _written(self, commit: Commit, write: str) -> list[tuple[str | None, int]]:
        depth = "/*=*/*=*" if commit.day else "/*=*"
        fs, path = self._fs(f"{self.path}/data/{VERSION}={write}{depth}")
        out = []
        for status in fs.globStatus(path) or []:
            at = status.getPath()
            day = at.getParent().getName().partition("=")[2] if commit.day else None
            out.append((day, int(at.getName().partition("=")[2])))
        if commit.day:
            self._check_days(d for d, _ in out)
        return out

    @staticmethod
    def _next(
        commit: Commit, touched: Iterable, write: str | None, written: list, batch: tuple[str, int] | None
    ) -> Commit:
        gone = set(touched)
        cells = {v: left for v, live in commit.cells.items() if (left := [c for c in live if tuple(c) not in gone])}
        sizes = {v: n for v, n in commit.written.items() if v in cells}
        if written:
            cells[write] = written
            sizes[write] = len(written)
        batches = {**commit.batches, batch[0]: batch[1]} if batch else commit.batches
        return replace(commit, version=commit.version + 1, cells=cells, written=sizes, batches=batches)

    def fold(self, horizon: tuple[int, int] | None = None, parallelism: int | None = None, writes: int = 2) -> int:
        """Merge the cells that hold ``writes`` writes or more into one each; gives the number of cells read.

        Deletes stay as long as an older change of their key may still come. With ``horizon``, a file number and
        position, none older than that is taken from now on, so older deletes go, and every cell is folded.
        """
        commit = self.current()
        if not commit.on_read and not (horizon and commit.keep_positions):
            raise ValueError("only targets that merge on reading, or keep positions, are folded")
        if horizon:
            if not commit.keep_positions:
                raise ValueError("a horizon needs positions")
            if commit.horizon and horizon < commit.horizon:
                raise ValueError(f"the horizon {commit.horizon} cannot go back to {horizon}")
            commit = commit.with_options(horizon=f"{horizon[0]}:{horizon[1]}")
        # Where keys are merged across days, what a bucket holds on any day belongs together.
        across = len(commit.merge_key) < len(commit.schema.primary_key)
        held: dict[object, set[str]] = {}
        for write, live in commit.cells.items():
            for c in live:
                held.setdefault(c[1] if across else tuple(c), set()).add(write)
        every = {tuple(c) for live in commit.cells.values() for c in live}
        gathered = every if horizon else {c for c in every if len(held[c[1] if across else c]) >= writes}
        if not gathered:
            return 0
        cells = {w: hit for w, live in commit.cells.items() if (hit := [c for c in live if tuple(c) in gathered])}
        rows = self._rows(commit, cells, whole=False, versions=commit.on_read)
        if commit.on_read:
            rows = _latest_written(commit, rows)
        if commit.horizon:
            rows = rows.where(~F.col(DELETED) | (_order("_file_no", "_pos") >= _literal(commit.horizon)))
        self._write(commit, rows, gathered, parallelism, None)
        return len(gathered)

    def drop_days(self, first_kept: str) -> list[str]:
        """D-04: forget all days before the first one to keep. Metadata only."""
        commit = self.current()
        if commit.day is None:
            raise ValueError("the target has no day column")
        old = {tuple(c) for live in commit.cells.values() for c in live if c[0] < first_kept}
        if old:
            self._commit(self._next(commit, old, None, [], None))
        return sorted({d for d, _ in old})

    def drop_unused_files(self) -> int:
        """Delete the data folders that the current commit no longer refers to. Run when no reader is on an
        older commit. Folders of the next version belong to a writer at work and stay."""
        commit = self.current()
        fs, path = self._fs(f"{self.path}/data/{VERSION}=*")
        dropped = 0
        for status in fs.globStatus(path) or []:
            write = status.getPath().getName().partition("=")[2]
            if int(write.partition("-")[0]) <= commit.version and write not in commit.cells:
                dropped += bool(fs.delete(status.getPath(), True))
        return dropped


def _same(key: Sequence[str]) -> Column:
    """Rows ``o`` and ``c`` have the same key."""
    same = F.lit(True)
    for k in key:
        same = same & F.col(f"o.{k}").eqNullSafe(F.col(f"c.{k}"))
    return same


def _latest_written(commit: Commit, rows: DataFrame) -> DataFrame:
    """The row that holds for each key: by log position where positions are kept, else by the order of commits."""
    written = F.substring_index(VERSION, "-", 1).cast("bigint")
    order = (*ORDER, "_written") if commit.keep_positions else ("_written",)
    return latest_per_key(rows.withColumn("_written", written), commit.merge_key, order).drop("_written", VERSION)


def _order(*names: str) -> Column:
    return F.struct(*[F.col(n).cast("bigint").alias(n) for n in names])


def _literal(position: tuple[int, int]) -> Column:
    return F.struct(*[F.lit(n).cast("bigint").alias(c) for c, n in zip(("_file_no", "_pos"), position)])


def _not_older(changes: DataFrame, old: DataFrame, key: Sequence[str]) -> DataFrame:
    """T-05: the changes that no stored row of their key is newer than.

    The stale ones are found from the stored side, so that the changes, the small side, can be broadcast.
    """
    later = F.struct(*[F.col(f"o.{n}") for n in ORDER]) > F.struct(*[F.col(f"c.{n}") for n in ORDER])
    c = changes.select(*key, *ORDER).alias("c")
    stale = old.select(*key, *ORDER).alias("o").join(c, _same(key) & later).select(*[F.col(f"c.{k}") for k in key])
    return changes.alias("c").join(stale.alias("o"), _same(key), "left_anti")


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """W-04: bucket of a key. Hashes text, so a key column that widens keeps its bucket."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(buckets)).cast("int")


def rebalance(df: DataFrame, by: Sequence[str], parallelism: int | None = None) -> DataFrame:
    """W-04, W-11: rows of one cell together, but Spark splits a cell that outgrows the advisory size and
    joins small ones, so neither one hot day nor many tiny ones decide the task sizes."""
    columns = [F.col(c) for c in by]
    return df.hint("rebalance", parallelism, *columns) if parallelism else df.hint("rebalance", *columns)
