"""Tables written between the steps of an operator, in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from propfold.session import shared_dir


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write the rows and read them back, which cuts their lineage.

    Each call has a folder of its own below ``spark.checkpoint.dir``, so that a run that
    is repeated never meets the files of another. Lost executors lose none of it.
    """
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
