"""Create and evolve the wide table of an event type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propfold.functions.names import column
from propfold.operators.registry import EventType, schema_columns, wide_column_of
from propfold.sources.schemas import BASE_COLUMNS


def wide_table_schema(schemas: DataFrame, properties: DataFrame) -> DataFrame:
    """Columns of each wide table: properties in name order, then base columns."""
    declared = schema_columns(schemas, properties).select(
        "schema",
        F.lit(0).alias("part"),
        F.col("property").alias("order"),
        wide_column_of("property").alias("column_name"),
        F.col("type").alias("data_type"),
    )
    base = F.array(
        *(
            F.struct(
                F.lit(1).alias("part"),
                F.lit(f"{place}").alias("order"),
                F.lit(name).alias("column_name"),
                F.lit(kind.simpleString()).alias("data_type"),
            )
            for place, (name, kind) in enumerate(BASE_COLUMNS.items())
        )
    )
    fixed = declared.select("schema").distinct().select("schema", F.inline(base))
    order = Window.partitionBy("schema").orderBy("part", "order")
    return declared.unionByName(fixed).select(
        "schema", F.row_number().over(order).alias("position"), "column_name", "data_type"
    )


def missing_columns(declared: DataFrame, existing: DataFrame) -> DataFrame:
    """Declared columns which the table does not have yet; both by ``column_name``."""
    return declared.join(existing.select("column_name"), "column_name", "left_anti")


def build_table(spark: SparkSession, table: str, kind: EventType, path: str | None = None) -> list[str]:
    """Create the wide table, or add the columns it lacks; returns those added."""
    wanted = kind.struct()
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet", schema=wanted)
        return wanted.names
    present = {name.lower() for name in spark.table(table).columns}
    added = [field for field in wanted if field.name.lower() not in present]
    if added:
        columns = ", ".join(
            f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in added
        )
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [field.name for field in added]


def append_to_table(batch: DataFrame, table: str) -> None:
    """Append the rows whose id the table lacks, by column name."""
    target = batch.sparkSession.table(table)
    missing = [f for f in target.schema if f.name not in batch.columns]
    new = batch.join(target.select("id"), "id", "left_anti").select(
        "*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing)
    )
    new.select(*map(column, target.columns)).write.mode("append").insertInto(table)
