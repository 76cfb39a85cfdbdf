"""The kept state of a tenant: what each run has written, and which runs count.

Every run writes its rows to ``<table>/run=<id>``, in whole: run again, it overwrites them.
Nothing is seen before the run's row is in ``commits``, which is one append at its end, so
rows, flags, registry and columns of a run become visible together, and a run that was
killed half way leaves nothing that anyone reads. Runs are numbered upwards and there is
one writer at a time.

Tables that grow by each run are read over the runs since the last compaction, the others
at the last run. ``vacuum`` removes what no reader needs any more.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propfold.sources.schemas import TABLES
from propfold.sources.seen import ISLANDS
from propfold.sources.tables import TenantTables, path_exists

PENDING, SETTLED = "pending", "settled"

EVENT_STATE = f"{TABLES['user_event']}, state STRING"

# Kept by all runs since the last compaction.
GROWING = {
    "seen_events": ISLANDS,
    "seen_properties": ISLANDS,
    "observed": "event_name STRING, name STRING, n LONG, first_property LONG",
    "wide_columns": "event_type STRING, version INT, property STRING, type STRING",
}
# Of these the last run holds all.
CURRENT = {
    "pending_properties": f"{TABLES['event_property']}, counted BOOLEAN",
    "event_schema": TABLES["event_schema"],
    "property_event_schema": TABLES["property_event_schema"],
}
# Needed while a run works.
WORKING = ("new_events", "new_properties", "folded")

COMMITS = "run_id LONG, base LONG, registry LONG, judged LONG"


@dataclass(frozen=True)
class Commit:
    """A run that counts; ``base`` is the last compaction, ``registry`` the run that last
    changed a registry, ``judged`` the one that last judged events."""

    run_id: int
    base: int
    registry: int
    judged: int


@dataclass(frozen=True)
class Store:
    tables: TenantTables

    @property
    def spark(self):
        return self.tables.spark

    def path(self, table: str, run_id: int | None = None) -> str:
        path = self.tables.path(f"store/{table}")
        return path if run_id is None else f"{path}/run={run_id}"

    @cached_property
    def commits(self) -> list[Commit]:
        """Runs that count, in order: one small row each."""
        path = self.path("commits")
        if not path_exists(self.spark, path):
            return []
        rows = self.spark.read.schema(COMMITS).parquet(path).distinct().collect()
        return sorted((Commit(*row) for row in rows), key=lambda c: c.run_id)

    @property
    def last(self) -> Commit | None:
        return self.commits[-1] if self.commits else None

    @property
    def runs(self) -> list[int]:
        return [c.run_id for c in self.commits]

    def commit(self, run_id: int, **changed: int) -> Store:
        """Make a run count; returns the store as it now is. What isn't named stays."""
        row = {"base": run_id, "registry": run_id, "judged": run_id}
        if self.last:
            row = {name: getattr(self.last, name) for name in row}
        row = {"run_id": run_id, **row, **changed}
        rows = self.spark.createDataFrame([tuple(row.values())], COMMITS)
        rows.coalesce(1).write.mode("append").parquet(self.path("commits"))
        return Store(self.tables)

    def stored(self, table: str, schema: T.StructType | str, runs: list[int]) -> DataFrame:
        """Rows that the given runs have written, with ``run``; only their folders are read."""
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = T.StructType([*schema.fields, T.StructField("run", T.LongType())])
        if not runs or not path_exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table)).where(F.col("run").isin(runs))

    def growing(self, table: str) -> DataFrame:
        runs = [r for r in self.runs if r >= self.last.base] if self.last else []
        return self.stored(table, GROWING[table], runs).drop("run")

    def current(self, table: str) -> DataFrame:
        return self.stored(table, CURRENT[table], self.runs[-1:]).drop("run")

    def registry(self) -> tuple[DataFrame, DataFrame] | None:
        """Both event registries as the last run has left them."""
        if not self.last:
            return None
        return tuple(
            self.stored(name, CURRENT[name], [self.last.registry]).drop("run")
            for name in ("event_schema", "property_event_schema")
        )

    def state(self, runs: list[int], state: str) -> DataFrame:
        """Events in a state; a partition filter, so no other files are read."""
        rows = self.stored("event_state", EVENT_STATE, runs).where(F.col("state") == state)
        return rows.drop("state", "run")

    def pending(self) -> DataFrame:
        """Events that are not migrated, as the last run has left them."""
        return self.state(self.runs[-1:], PENDING)

    def settled(self) -> DataFrame:
        """Events that are migrated: ``id``, ``valid``, ``migrated``; one row each."""
        runs = [r for r in self.runs if r >= self.last.base] if self.last else []
        return self.state(runs, SETTLED).select("id", "valid", "migrated")

    def flags(self) -> DataFrame:
        """Current flags of all events that were taken in."""
        return self.settled().unionByName(self.pending().select("id", "valid", "migrated"))

    def write(self, table: str, run_id: int, rows: DataFrame, by: str | None = None) -> DataFrame:
        """Write what a run adds to a table, over what it had written, and read it back."""
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(self.path(table, run_id))
        return self.spark.read.schema(rows.schema).parquet(self.path(table, run_id))

    def vacuum(self) -> list[str]:
        """Remove folders that no reader needs; returns them. No run may be working."""
        last = self.last
        if not last:
            return []
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        removed = []

        def folders(path: str) -> list[tuple[int, str]]:
            where = jvm.org.apache.hadoop.fs.Path(path)
            files = where.getFileSystem(conf)
            if not files.exists(where):
                return []
            found = [s.getPath() for s in files.listStatus(where)]
            return [
                (int(p.getName().removeprefix("run=")), p.toString()) for p in found if p.getName().startswith("run=")
            ]

        def remove(path: str) -> None:
            where = jvm.org.apache.hadoop.fs.Path(path)
            if where.getFileSystem(conf).delete(where, True):
                removed.append(path)

        known = set(self.runs)
        for table in (*GROWING, *CURRENT, *WORKING, "event_state", "wide"):
            for run_id, path in folders(self.path(table)):
                if run_id > last.run_id:
                    continue
                stale = run_id not in known or table in WORKING
                stale |= table in GROWING and run_id < last.base
                stale |= table == "pending_properties" and run_id < last.run_id
                stale |= table in ("event_schema", "property_event_schema") and run_id < last.registry
                stale |= table == "event_state" and run_id < last.base
                if stale:
                    remove(path)
                elif table == "event_state" and run_id < last.run_id:
                    remove(f"{path}/state={PENDING}")
        return removed
