"""A property table in parts by the hash of the raw name, of which a change rewrites only its own.

Each run writes the parts that it changes to ``run=<id>/part=<n>`` and then, as its last
step, says so in ``manifest``: which names each of them holds now, and how many rows. A
part is read where the last run that wrote it has put it; what a killed run wrote is never
read, and the same run started again overwrites it. There is one writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propfold.sources.schemas import table_schema
from propfold.sources.tables import TenantTables, path_exists

PARTS = 1024
MANIFEST = "run LONG, part INT, name STRING, n LONG"


def part_of(name: Column) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(PARTS)).cast("int")


@dataclass(frozen=True)
class NamedParts:
    """One property table of a tenant, ``event_property`` or ``user_property``."""

    tables: TenantTables
    table: str

    @property
    def spark(self):
        return self.tables.spark

    def path(self, kind: str) -> str:
        return self.tables.path(f"parts/{self.table}/{kind}")

    def manifest(self) -> DataFrame:
        """Names that each part holds now; a part that is empty has no name."""
        if not path_exists(self.spark, self.path("manifest")):
            return self.spark.createDataFrame([], MANIFEST)
        rows = self.spark.read.schema(MANIFEST).parquet(self.path("manifest"))
        last = rows.groupBy("part").agg(F.max("run").alias("run"))
        return rows.join(F.broadcast(last), ["part", "run"], "left_semi").distinct()

    def runs(self) -> dict[int, int]:
        """The run that last wrote each part: at most ``PARTS`` rows."""
        return {r["part"]: r["run"] for r in self.manifest().select("part", "run").distinct().collect()}

    def has_run(self, run_id: int) -> bool:
        if not path_exists(self.spark, self.path("manifest")):
            return False
        rows = self.spark.read.schema(MANIFEST).parquet(self.path("manifest"))
        return not rows.where(F.col("run") == run_id).isEmpty()

    def parts_like(self, pattern: str) -> list[int]:
        """Parts that hold a name like the pattern."""
        found = self.manifest().where(F.col("name").like(pattern) & (F.col("n") > 0))
        return sorted(r["part"] for r in found.select("part").distinct().collect())

    def read(self, parts: list[int] | None = None) -> DataFrame:
        """Rows of the table, or of some parts: a filter on partitions, no other file is read."""
        schema = table_schema(self.table)
        runs = self.runs()
        by_run: dict[int, list[int]] = {}
        for part in runs if parts is None else [p for p in parts if p in runs]:
            by_run.setdefault(runs[part], []).append(part)
        if not by_run:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField("run", T.LongType()), T.StructField("part", T.IntegerType())])
        here = [(F.col("run") == run) & F.col("part").isin(some) for run, some in sorted(by_run.items())]
        rows = self.spark.read.schema(stored).parquet(self.path("rows")).where(reduce(Column.__or__, here))
        return rows.select(*schema.names)

    def write(self, run_id: int, rows: DataFrame, parts: list[int] | None = None) -> None:
        """Put these rows in place of the given parts (of all), and say so in the manifest.

        Rows are rebalanced by part, so a part with many rows is written by several tasks.
        """
        path = f"{self.path('rows')}/run={run_id}"
        placed = rows.withColumn("part", part_of(F.col("name"))).hint("rebalance", "part")
        placed.write.mode("overwrite").partitionBy("part").parquet(path)
        schema = T.StructType([*table_schema(self.table).fields, T.StructField("part", T.IntegerType())])
        written = self.spark.read.schema(schema).parquet(path).groupBy("part", "name").agg(F.count("*").alias("n"))
        touched = range(PARTS) if parts is None else parts
        every = self.spark.createDataFrame([(p,) for p in touched], "part int")
        names = every.join(written, "part", "left").select(
            F.lit(run_id).cast("long").alias("run"), "part", "name", F.coalesce("n", F.lit(0)).cast("long").alias("n")
        )
        names.coalesce(1).write.mode("append").parquet(self.path("manifest"))
