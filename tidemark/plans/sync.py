"""A sync plan: the spec, checked against source and target schemas, and the steps of one batch.

Batch and streaming runs share every step here.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import routing
from tidemark.operators.row_kinds import Projection, current_state, to_row_kinds
from tidemark.operators.schema import Field, TableSchema, TypeRegistry, accept, build_target, changed_fields, inferred_dtype, merge_all
from tidemark.operators.targets import MERGE, ON_READ, Target
from tidemark.plans.spec import Pair, Pipeline
from tidemark.sources.changelog import decode, of_sources, row_changes, schema_changes, watched_filter
from tidemark.sources.discovery import normalise_zones, snapshot_changes
from tidemark.sources.offsets import Start
from tidemark.sources.seek import LogIndex

# Up to this many source tables, a target's rows are picked by exact name; beyond it by its regexes.
NAMED_TABLES = 1000
# Source type of columns that the rows told of.
INFERRED = "inferred"


@dataclass
class BatchReport:
    """What one batch did. Sizes follow the catalog, not the rows."""

    batch: int | None
    written: list[str] = field(default_factory=list)
    evolved: list[str] = field(default_factory=list)
    new_tables: list[tuple[str, str]] = field(default_factory=list)
    unrouted: list[tuple[str, str]] = field(default_factory=list)


@dataclass
class SyncPlan:
    spark: SparkSession
    pipeline: Pipeline
    targets: dict[str, Target]
    monitored: list[tuple[str, str, str]] = field(default_factory=list)
    excluded: list[tuple[str, str]] = field(default_factory=list)
    case_sensitive: bool = True
    tinyint1_not_bool: bool = False
    strict_types: bool = True
    strict_routes: bool = False
    locate_moves: bool = False
    parallelism: int | None = None
    cache_batch: bool = True
    writers: int = 4
    include: str | None = None
    exclude: str | None = None
    seen: set[tuple[str, str]] = field(default_factory=set)
    start: Start | None = None
    # C-12: where set, columns that no schema change has told of are taken over from the rows.
    registry: TypeRegistry | None = None

    @classmethod
    def prepare(
        cls,
        spark: SparkSession,
        pipeline: Pipeline,
        sources: Mapping[tuple[str, str], TableSchema],
        ignore_incompatible: bool = False,
        create_missing: bool = False,
        buckets: int | None = None,
        table_options: Mapping[str, str] | None = None,
        keep_positions: bool = False,
        **settings,
    ) -> SyncPlan:
        """Start-up checks (F-13, C-01, C-04, C-06, C-13..C-15): every pair needs a source, every target must
        exist and fit its merged sources, unless missing ones are to be created."""
        plan = cls(spark, pipeline, {}, **settings)
        if plan.parallelism is None and (tasks := pipeline.sink_options.get("sink.parallelism")):
            plan.parallelism = int(tasks)  # W-11
        routed: set[tuple[str, str]] = set()
        for pair, matched in zip(pipeline.pairs, plan.matching(sources)):
            routed |= set(matched)
            if not matched:
                raise ValueError(f"no source table matches {pair.source}")
            options = {MERGE: ON_READ, **pipeline.sink_options, **(table_options or {})}
            expected = plan.expected(pair, {k: sources[k] for k in matched}, options)
            target = Target(spark, f"{pipeline.warehouse}/{pair.target_database}/{pair.target_table}")
            if not target.exists():
                if not create_missing:
                    raise FileNotFoundError(f"target {pair.target} does not exist")
                day = pair.day.name if pair.day else None
                given = {**pipeline.sink_options, **(table_options or {})}.get("bucket", buckets)
                key = expected.primary_key
                if day and day not in key:
                    expected = replace(expected, primary_key=[day, *key])
                target.create(expected, given, day, keep_positions)
            have = target.current().schema
            if accept(expected.fields, have, ignore_incompatible):
                plan.targets[pair.target] = target
                plan.monitored += [(*k, pair.target) for k in matched]
            else:
                plan.excluded += matched
        plan.excluded += sorted(set(sources) - routed)
        if not plan.monitored:
            raise ValueError("no tables to sync: no source schema fits its target")
        plan.seen = {(d, t) for d, t, _ in plan.monitored}
        return plan

    def matching(self, sources: Iterable[tuple[str, str]]) -> list[list[tuple[str, str]]]:
        """Source tables of each pair. Spark matches the names, in the regex dialect of the row path."""
        pairs = self.pipeline.pairs
        names = self.spark.createDataFrame(sorted(sources), "db string, tbl string")
        hits = F.array(*[p.route.matches() for p in pairs]).alias("hits")
        found = sorted(names.select("db", "tbl", hits).collect())
        return [[(r.db, r.tbl) for r in found if r.hits[i]] for i in range(len(pairs))]

    def expected(
        self, pair: Pair, sources: Mapping[tuple[str, str], TableSchema], options: Mapping[str, str] | None = None
    ) -> TableSchema:
        merged = merge_all(sources.values(), pair.target)
        computed = [(pair.day.name, T.StringType())] if pair.day else []
        return build_target(
            merged, computed, self.pipeline.metadata, pair.primary_key, options, self.case_sensitive, pair.target
        )

    # --- one batch ------------------------------------------------------------------------------

    def select(self, log: DataFrame, start: Start | None = None, watch: Observation | None = None) -> DataFrame:
        """Decoded entries of the source tables that the spec names, from the start position on. ``watch`` gets the names
        of the tables that are left out (F-08).

        Without ``start`` the spec's own start mode holds (R-07 .. R-11). Modes that depend on the log as it is at
        the start, ``latest-offset`` and skipped events, have to be resolved first.
        """
        tables = [p.source_table for p in self.pipeline.pairs]
        keep = of_sources(self.pipeline.database, tables)
        decoded = decode(log).where((start or self.start or self.pipeline.start).condition())
        if self.include or self.exclude:  # tables that are left out on purpose
            decoded = routing.include_exclude(decoded, self.include, self.exclude)
        return decoded.where(keep) if watch is None else watched_filter(decoded, keep, watch)

    def resolve_start(self, log_at_start: DataFrame) -> Start:
        """Freeze the spec's start mode against the log as it is now; later batches use it."""
        self.start = self.pipeline.start.resolve(self.select(log_at_start, Start("earliest-offset")))
        return self.start

    def read_from(self, index: LogIndex) -> DataFrame:
        """The log from the plan's start on, out of the files that can hold it; the start is resolved by the index."""
        self.start = index.resolve(self.start or self.pipeline.start, lambda log: self.select(log, Start("earliest-offset")))
        return index.log(self.start)

    def projection(self, target: str) -> Projection:
        pair = self.pipeline.by_target()[target][0]
        schema = self.targets[target].current().schema
        metadata = {k: n for k, n in self.pipeline.metadata.items() if schema.get(n) is not None}
        return Projection(schema, pair.day, metadata, self.strict_types)

    def rows_for(self, changes: DataFrame, target: str, names: list[tuple[str, str]] | None = None) -> DataFrame:
        """Typed row kinds of one target, from all pairs that feed it (W-05)."""
        if names is not None and len(names) <= NAMED_TABLES:
            mine = routing.only_listed(changes, names)
        else:
            takes = F.lit(False)
            for pair in self.pipeline.by_target()[target]:
                takes = takes | pair.route.matches()
            mine = changes.where(takes)
        return to_row_kinds(mine, self.projection(target))

    def state(self, log: DataFrame, target: str, start: Start | None = None) -> DataFrame:
        """W-13: what the target holds after the whole log, computed without storing anything."""
        changes = row_changes(self.select(log, start))
        p = self.projection(target)
        return current_state(self.rows_for(changes, target), p.schema.primary_key)

    def run_batch(
        self, log: DataFrame, batch: int | None = None, job: str = "batch", start: Start | None = None
    ) -> BatchReport:
        """W-02: schema changes first, then the rows of every target, from one decoded and cached batch.

        With a ``batch`` number, one of ``job`` that a target already has is skipped there; without it the batch
        counts whatever came before. Writers are independent: if one fails, the others finish first.

        Turn ``cache_batch`` off for a bulk load whose decoded form would not fit the executors' disks; each
        target then decodes the log for itself.
        """
        report, watch = BatchReport(batch), Observation()
        decoded = self.select(log, start, watch)
        if self.cache_batch:
            decoded = decoded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            columns = self._changed_columns(decoded)  # the first pass, which also tells what was left out
            report.unrouted = sorted((r["db"], r["tbl"]) for r in watch.get["dropped"])
            if self.strict_routes and report.unrouted:
                raise ValueError(f"cannot find a target for the tables {report.unrouted}")
            report.evolved = self._evolve(columns)
            changes = row_changes(decoded)
            if self.registry:
                report.evolved = sorted({*report.evolved, *self._evolve_inferred(changes)})
            routed = self._names(changes, report)

            def write(item: tuple[str, list[tuple[str, str]]]) -> str | None:
                target, names = item
                rows = self.rows_for(changes, target, names)
                guard = None if batch is None else (job, batch)
                done = self.targets[target].upsert(rows, guard, self.parallelism, self.locate_moves)
                return target if done else None

            if self.writers > 1 and len(routed) > 1:
                with ThreadPoolExecutor(self.writers) as pool:
                    running = [pool.submit(write, item) for item in sorted(routed.items())]
                done = [r.result() for r in running]
            else:
                done = [write(item) for item in sorted(routed.items())]
            report.written = [t for t in done if t]
        finally:
            decoded.unpersist()
        return report

    def load_snapshot(
        self, table: DataFrame, db: str, tbl: str, job: str = "snapshot", zoned: Sequence[str] | None = None
    ) -> list[str]:
        """R-07: the snapshot half of start mode ``initial``. The log is synced after it, from its start on.

        Each target takes a table's snapshot once. With a ``server-time-zone`` in the spec, wall-clock columns of the
        snapshot are read as instants in that zone (R-16).
        """
        if zone := self.pipeline.source_options.get("server-time-zone"):
            table = normalise_zones(table, zone, zoned)
        rows = snapshot_changes(table, db, tbl)
        hits = zip(self.pipeline.pairs, self.matching([(db, tbl)]))
        done = []
        for target in dict.fromkeys(p.target for p, found in hits if found and p.target in self.targets):
            kinds = to_row_kinds(rows, self.projection(target))
            if self.targets[target].upsert(kinds, (f"{job}:{db}.{tbl}", 0), self.parallelism):
                done.append(target)
        return done

    def _names(self, changes: DataFrame, report: BatchReport) -> dict[str, list[tuple[str, str]]]:
        """Distinct source tables of the batch and their targets, so regexes run once per table (F-06, F-10)."""
        names = changes.select("db", "tbl").distinct()
        routed: dict[str, list[tuple[str, str]]] = {}
        found = names.select("db", "tbl", routing.matched_targets(self.pipeline.routes).alias("targets"))
        for db, tbl, targets in found.sort("db", "tbl").collect():
            if (db, tbl) not in self.seen:
                self.seen.add((db, tbl))
                report.new_tables.append((db, tbl))
            for t in targets:
                if t in self.targets:
                    routed.setdefault(t, []).append((db, tbl))
        return routed

    def _evolve_inferred(self, changes: DataFrame) -> list[str]:
        """C-12: merge the batch into the registry, and add the columns that are new to every target of their table. A
        column that a target has keeps the type it was given."""
        found = self.registry.add(changes).withColumn("targets", routing.matched_targets(self.pipeline.routes)).collect()
        by_target: dict[str, list[Field]] = {}
        for r in sorted(found, key=lambda r: (r["db"], r["tbl"], r["column"])):
            name = r["column"] if self.case_sensitive else r["column"].lower()
            dtype = inferred_dtype(r["type"])
            for t in r["targets"]:
                if t in self.targets and dtype is not None:
                    known = self.targets[t].current().schema.get(name)
                    if known is None or known.source_type == INFERRED:
                        by_target.setdefault(t, []).append(Field(name, dtype, True, INFERRED, None, (r["column"],)))
        return [t for t, fields in by_target.items() if self.targets[t].evolve(fields)]

    def _changed_columns(self, decoded: DataFrame) -> list[Row]:
        """Collected as distinct column definitions: schema changes are rare and bounded by the catalog."""
        return (
            schema_changes(decoded)
            .withColumn("targets", routing.matched_targets(self.pipeline.routes))
            .groupBy("targets", "column", "type", "length", "scale")
            .agg(F.min(F.struct("file_no", "pos", "position")).alias("at"), F.max("comment").alias("comment"))
            .sort("at")
            .collect()
        )

    def _evolve(self, columns: list[Row]) -> list[str]:
        """C-08: apply the batch's schema changes to every target of the changed table."""
        by_target: dict[str, list] = {}
        for r in columns:
            for t in r["targets"]:
                by_target.setdefault(t, []).append(r)
        evolved = []
        for target, rows in by_target.items():
            if target in self.targets:
                fields = changed_fields(rows, self.case_sensitive, self.tinyint1_not_bool)
                if self.targets[target].evolve(fields):
                    evolved.append(target)
        return sorted(evolved)
