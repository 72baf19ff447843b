"""The pipeline spec: load, check, and turn into routes."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidemark.functions.metadata import METADATA_KINDS
from tidemark.operators.row_kinds import DayColumn
from tidemark.operators.routing import Route
from tidemark.sources.offsets import Start

# Connection settings come from options at run time; a spec file that holds them is not kept.
SECRETS = ("ip", "port", "username", "pwd")


@dataclass(frozen=True)
class Pair:
    """One source pattern and its target."""

    source_database: str
    source_table: str
    target_database: str
    target_table: str
    primary_key: tuple[str, ...] = ()
    day: DayColumn | None = None

    @property
    def target(self) -> str:
        return f"{self.target_database}.{self.target_table}"

    @property
    def source(self) -> str:
        return rf"{self.source_database}\.{self.source_table}"

    @property
    def route(self) -> Route:
        return Route(self.source_database, self.source_table, self.target)


@dataclass(frozen=True)
class Pipeline:
    pairs: tuple[Pair, ...]
    metadata: Mapping[str, str] = field(default_factory=dict)
    source_options: Mapping[str, str] = field(default_factory=dict)
    catalog_options: Mapping[str, str] = field(default_factory=dict)
    sink_options: Mapping[str, str] = field(default_factory=dict)
    global_options: Mapping[str, str] = field(default_factory=dict)

    @property
    def routes(self) -> list[Route]:
        return [p.route for p in self.pairs]

    @property
    def database(self) -> str:
        return self.pairs[0].source_database

    @property
    def start(self) -> Start:
        return Start.from_options(self.source_options)

    @property
    def warehouse(self) -> str:
        return self.catalog_options["warehouse"].rstrip("/")

    def by_pattern(self) -> dict[tuple[str, str], list[str]]:
        """F-04: targets of each source pattern."""
        out: dict[tuple[str, str], list[str]] = {}
        for p in self.pairs:
            out.setdefault((p.source_database, p.source_table), []).append(p.target)
        return out

    def by_target(self) -> dict[str, list[Pair]]:
        """Pairs that feed each target."""
        out: dict[str, list[Pair]] = {}
        for p in self.pairs:
            out.setdefault(p.target, []).append(p)
        return out

    def check(self) -> Pipeline:
        """R-02: what can be refused before anything runs."""
        if not self.pairs:
            raise ValueError("the spec has no data pairs")
        sources = {p.source_database for p in self.pairs}
        if len(sources) != 1:
            raise ValueError(f"only one source database pattern is supported: {sorted(sources)}")
        targets = {p.target_database for p in self.pairs}
        if len(targets) != 1:
            raise ValueError(f"only one target database is supported: {sorted(targets)}")
        unknown = [k for k in self.metadata if k not in METADATA_KINDS]
        if unknown:
            raise ValueError(f"unknown metadata kinds: {unknown}")
        for target, pairs in self.by_target().items():
            if len({p.day for p in pairs}) != 1:
                raise ValueError(f"pairs of target {target} disagree about its day column")
        if self.start.mode == "initial" and len(self.pairs) != 1:
            raise ValueError(f"start mode 'initial' takes one data pair only, got {len(self.pairs)}")
        return self


def _pair(body: Mapping, extended: bool) -> Pair:
    sources = body.get("dtColumns") or []
    names = body.get("targetDtColumnNames") or ["dt"]
    where = f"{body['tgtDatabase']}.{body['tgtTable']}"
    if len(sources) > 1 or len(names) > 1:
        raise ValueError(f"more than one day column is not supported: {where}")
    return Pair(
        body["srcDatabasePattern"], body["srcTablePattern"], body["tgtDatabase"], body["tgtTable"],
        tuple(body.get("pkList") or ()),
        DayColumn(sources[0], names[0], extended=extended) if sources else None,
    )


def parse_spec(text: str) -> Pipeline:
    """R-01, R-02: a spec from its JSON text, checked."""
    body = json.loads(text)
    if body.get("sourceTypeCode", 0) != 0:
        raise ValueError(f"unknown source type code {body['sourceTypeCode']}")
    source = dict(body.get("sourceConfig") or {})
    # Fixed rule: tables that appear later are routed by pattern, never through the source's own option.
    source["scan.newly-added-table.enabled"] = "false"
    # With "day.extended": "true" the day rule also takes dotted fractions of a second.
    extended = str((body.get("globalConfig") or {}).get("day.extended", "false")).lower() == "true"
    pairs = tuple(_pair(p, extended) for p in body.get("dataPairList") or [])
    if pairs:
        source["database-name"] = pairs[0].source_database
    return Pipeline(
        pairs,
        dict(body.get("metaColumnTypeToTargetColName") or {}),
        source,
        dict(body.get("catalogConfig") or {}),
        dict(body.get("sinkConfig") or {}),
        dict(body.get("globalConfig") or {}),
    ).check()


def load_spec(spark: SparkSession, path: str) -> Pipeline:
    """R-01: a spec from any file system that Spark reads."""
    return parse_spec(spark.read.text(path, wholetext=True).first()[0])


def connection(options: Mapping[str, str], pipeline: Pipeline) -> dict[str, str]:
    """R-02: source options with the connection fields, which are given at run time."""
    named = {"ip": "hostname", "port": "port", "username": "username", "pwd": "password"}
    return {**pipeline.source_options, **{named[k]: options[k] for k in SECRETS if k in options}}
