"""Reading and writing the tables of one tenant."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from propfold.sources.schemas import INVALID, VALID, table_schema


@dataclass(frozen=True)
class TenantTables:
    """The tables of one tenant, kept below ``base/tenant`` as Parquet."""

    spark: SparkSession
    base: str
    tenant: str

    def path(self, table: str) -> str:
        return f"{self.base.rstrip('/')}/{self.tenant}/{table}"

    def wide_path(self, event_type: str) -> str:
        """Folder of a wide table; the name may hold any character."""
        return self.path(f"wide/{quote(event_type, safe='')}")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(table_schema(table)).parquet(self.path(table))

    def exists(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))


@dataclass(frozen=True)
class CatalogTables(TenantTables):
    """Tables of one tenant that the catalog holds in the database ``tenant``.

    Tables bucketed by event id are folded and joined without any shuffle. A
    bucket is one task, so a table with an oversized bucket is read as plain
    files instead, and is shuffled after combining. What the jobs write goes to
    paths, and is read from there.
    """

    max_bucket_excess: float = 4.0

    def name(self, table: str) -> str:
        return f"{self.tenant}.{table}"

    def read(self, table: str) -> DataFrame:
        if not self.spark.catalog.tableExists(self.name(table)):
            return super().read(table)
        rows = self.spark.table(self.name(table))
        if bucket_excess(self.spark, self.name(table)) <= self.max_bucket_excess:
            return rows
        return self.spark.read.schema(rows.schema).parquet(location(self.spark, self.name(table)))

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table)) or super().exists(table)


def write_bucketed(rows: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save a catalog table in buckets of ``key``, each sorted by it.

    The property table by ``event_id`` and the event table by ``id``, in the same
    number of buckets, make validation and pivot free of shuffles.
    """
    rows.write.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.select("data_type").first()[0]


def bucket_excess(spark: SparkSession, table: str) -> float:
    """Rows of the largest bucket as a multiple of the mean; 0 without buckets.

    Rows are counted per file, which reads no column. File sizes would not do:
    the rows of one event compress to next to nothing.
    """
    files = spark.read.parquet(location(spark, table)).groupBy("_metadata.file_name").count()
    bucket = F.regexp_extract("file_name", r"_([0-9]+)[.]c[0-9]+[.][^/]*$", 1)
    counts = files.groupBy(bucket.alias("bucket")).agg(F.sum("count").alias("n"))
    found = counts.where("bucket <> ''").agg(F.max("n") / F.avg("n")).first()[0]
    return found or 0.0


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def read_jdbc(
    spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int, **options
) -> DataFrame:
    """Read a database table in ``partitions`` ranges of its ``id``."""
    return (
        spark.read.format("jdbc")
        .options(**jdbc_options(url, table, lower, upper, partitions), **options)
        .load()
    )


def jdbc_options(url: str, table: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": "id",
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
        "preferTimestampNTZ": "true",
    }


def write_snapshot(rows: DataFrame, path: str) -> DataFrame:
    """Write a complete new state of a table to a new path and read it back."""
    rows.write.mode("errorifexists").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def only_new(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose id is not in ``target`` yet."""
    return batch.join(target.select("id"), "id", "left_anti")


def within_ids(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``key`` lies between the lowest and highest of ``ids``.

    Ids grow with time, so this lets a scan of a table written in that order
    skip most of it. It removes no row that could match one of ``ids``.
    """
    low, high = ids.agg(F.min("id"), F.max("id")).first()
    return rows.where(F.col(key).between(low, high)) if low is not None else rows.limit(0)


def append_new(batch: DataFrame, path: str) -> None:
    """Append to a wide table; running it again appends nothing."""
    spark = batch.sparkSession
    if path_exists(spark, path):
        target = spark.read.schema(batch.schema).parquet(path)
        batch = only_new(batch, within_ids(target, "id", batch))
    batch.write.mode("append").parquet(path)


def current_flags(status: DataFrame) -> DataFrame:
    """Latest non-NULL ``valid`` and ``migrated`` of each event.

    ``status`` is append-only: one row per event and run. Flags change often and
    the event table is never rewritten for them. Run and flag are aggregated as
    one number, which a hash aggregation can hold.
    """

    def latest(flag: Column) -> Column:
        return F.max(F.when(flag.isNotNull(), F.col("run_id") * 2 + flag.cast("long")))

    def value(newest: str) -> Column:
        return F.pmod(newest, F.lit(2)) == 1

    newest = status.groupBy("event_id").agg(
        latest(F.col("valid") == VALID).alias("_valid"),
        latest(F.col("migrated")).alias("_migrated"),
    )
    return newest.select(
        "event_id",
        F.when(value("_valid"), VALID).when(~value("_valid"), INVALID).alias("valid"),
        value("_migrated").alias("migrated"),
    )


def with_flags(events: DataFrame, status: DataFrame) -> DataFrame:
    """Events with their current flags; an event without status keeps its own."""
    latest = current_flags(status).select(
        F.col("event_id").alias("id"),
        F.col("valid").alias("_valid"),
        F.col("migrated").alias("_migrated"),
    )
    return (
        events.join(latest, "id", "left")
        .withColumn("valid", F.coalesce("_valid", "valid"))
        .withColumn("migrated", F.coalesce("_migrated", "migrated"))
        .select(*events.columns)
    )
