"""Where in the log a job starts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

MODES = ("initial", "earliest-offset", "latest-offset", "specific-offset", "timestamp")


@dataclass(frozen=True)
class Start:
    """A start mode. ``resolve`` turns the relative parts into literals once, before the job runs."""

    mode: str = "initial"
    file_no: int | None = None
    pos: int | None = None
    row: int = 0
    gtid_set: str | None = None
    skip_events: int = 0
    skip_rows: int = 0
    timestamp_ms: int | None = None

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"unknown start mode {self.mode!r}; known: {', '.join(MODES)}")
        if self.mode == "timestamp" and self.timestamp_ms is None:
            raise ValueError("start mode 'timestamp' needs scan.startup.timestamp-millis")
        if self.mode == "specific-offset" and self.gtid_set is None and (self.file_no is None or self.pos is None):
            raise ValueError("start mode 'specific-offset' needs a log file and position, or a GTID set")

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> Start:
        """From the source options of a pipeline spec."""
        prefix = "scan.startup."
        number = {k: int(options[prefix + k]) for k in (
            "timestamp-millis", "specific-offset.pos", "specific-offset.skip-events", "specific-offset.skip-rows",
        ) if options.get(prefix + k) not in (None, "")}
        file = options.get(prefix + "specific-offset.file")
        digits = "" if not file else file[len(file.rstrip("0123456789")):]
        return cls(
            mode=options.get(prefix + "mode", "initial").lower(),
            file_no=int(digits) if digits else None,
            pos=number.get("specific-offset.pos"),
            gtid_set=options.get(prefix + "specific-offset.gtid-set"),
            skip_events=number.get("specific-offset.skip-events", 0),
            skip_rows=number.get("specific-offset.skip-rows", 0),
            timestamp_ms=number.get("timestamp-millis"),
        )

    def resolve(self, log_at_start: DataFrame) -> Start:
        """Freeze ``latest-offset`` and ``skip_events`` against the log as it is now.

        ``latest`` is one aggregate. Skipping n events looks up the n+1 smallest positions from the offset
        on, which Spark keeps as a bounded top-n per task.
        """
        if self.mode == "latest-offset":
            last = log_at_start.agg(F.max(F.struct("file_no", "pos", "row")).alias("p")).first()["p"]
            if last is None:
                return replace(self, mode="earliest-offset")
            return replace(self, file_no=last["file_no"], pos=last["pos"], row=last["row"])
        if self.mode == "specific-offset" and self.skip_events:
            if self.file_no is not None:
                # The events to skip mostly lie in the first log file, which keeps the search small.
                start, bound = self.skipped(log_at_start.where(F.col("file_no") == self.file_no))
                if bound is not None:
                    return start
            return self.skipped(log_at_start)[0]
        return self

    def skipped(self, log: DataFrame) -> tuple[Start, tuple[int, int] | None]:
        """The start behind the events to skip, and its position; no position if the log has too few events."""
        found = self._skip_in(log.where(self._from_offset()))
        if not found["n"]:
            return self, None
        enough = found["n"] > self.skip_events
        at = (found["p"]["file_no"], found["p"]["pos"] + (not enough))
        return replace(self, file_no=at[0], pos=at[1], skip_events=0), at if enough else None

    def _skip_in(self, ahead: DataFrame) -> Row:
        """The last of the ``skip_events + 1`` smallest positions, and how many there are."""
        first = ahead.select("file_no", "pos").distinct().orderBy("file_no", "pos").limit(self.skip_events + 1)
        return first.agg(F.max(F.struct("file_no", "pos")).alias("p"), F.count(F.lit(1)).alias("n")).first()

    def _from_offset(self) -> Column:
        keep = F.lit(True)
        if self.file_no is not None and self.pos is not None:
            file_no, pos = F.col("file_no"), F.col("pos")
            keep = (file_no > self.file_no) | ((file_no == self.file_no) & (pos >= self.pos))
        if self.gtid_set:
            keep = keep & ~in_gtid_set("gtid", self.gtid_set)
        return keep

    def condition(self) -> Column:
        """The filter over decoded changes. Pure literals, so batch and stream share it."""
        file_no, pos, row = F.col("file_no"), F.col("pos"), F.col("row")
        if self.mode == "timestamp":
            return F.col("ts_ms") >= self.timestamp_ms
        if self.mode == "latest-offset":
            if self.pos is None:
                raise ValueError("resolve the start against the log first")
            at = (file_no == self.file_no) & ((pos > self.pos) | ((pos == self.pos) & (row > self.row)))
            return (file_no > self.file_no) | at
        if self.mode == "specific-offset":
            if self.skip_events:
                raise ValueError("resolve the start against the log first")
            keep = self._from_offset()
            if self.skip_rows and self.pos is not None:
                first = (file_no == self.file_no) & (pos == self.pos)
                keep = keep & ~(first & (row < self.skip_rows))
            return keep
        return F.lit(True)

    def reaches(self) -> Column:
        """Can a log file hold an entry from the start on? A filter over the columns of a file index. Events to skip
        count from the offset, so files behind it are all in reach."""
        last = F.col("last")
        if self.mode == "timestamp":
            return F.col("last_ms") >= self.timestamp_ms
        if self.mode == "latest-offset":
            if self.pos is None:
                raise ValueError("resolve the start against the log first")
            return last > F.struct(F.lit(self.file_no).cast("bigint").alias("file_no"), F.lit(self.pos).cast("bigint").alias("pos"), F.lit(self.row).alias("row"))
        if self.mode == "specific-offset":
            reach = F.lit(True)
            if self.file_no is not None and self.pos is not None:
                reach = (last["file_no"] > self.file_no) | ((last["file_no"] == self.file_no) & (last["pos"] >= self.pos))
            if self.gtid_set:
                held = [(name, low, high) for name, low, high in gtid_intervals(self.gtid_set)]

                def outside(s: Column) -> Column:
                    inside = F.lit(False)
                    for name, low, high in held:
                        inside = inside | ((s["server"] == name) & (s["first"] >= low) & (s["last"] <= high))
                    return ~inside

                reach = reach & ((F.col("unnumbered") > 0) | F.exists("servers", outside))
            return reach
        return F.lit(True)


def gtid_intervals(gtid_set: str) -> list[tuple[str, int, int]]:
    """``uuid:1-5:8,uuid2:3`` to (server, first, last) triples."""
    out = []
    for part in gtid_set.split(","):
        server, *ranges = part.strip().split(":")
        for r in ranges:
            low, _, high = r.partition("-")
            out.append((server.strip(), int(low), int(high or low)))
    return out


def in_gtid_set(gtid: Column | str, gtid_set: str) -> Column:
    """Is the transaction already in the set? False where it carries no id."""
    column = F.col(gtid) if isinstance(gtid, str) else gtid
    server = F.substring_index(column, ":", 1)
    number = F.substring_index(column, ":", -1).try_cast("bigint")
    hit = F.lit(False)
    for name, low, high in gtid_intervals(gtid_set):
        hit = hit | ((server == name) & number.between(low, high))
    return F.coalesce(hit, F.lit(False))


def snapshot_then_log(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """R-07: snapshot rows (op ``r``, position 0) ahead of the log."""
    return snapshot.unionByName(changes)
