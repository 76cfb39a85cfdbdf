"""Joins of a large side with a registry-sized side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS = 200_000
MAX_BYTES = 64 * 1024 * 1024


def fits_broadcast(rows: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Count rows and text bytes, summed on the map side."""
    texts = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType)]
    width = reduce(
        Column.__add__,
        (F.coalesce(F.octet_length(name), F.lit(0)).cast("long") for name in texts),
        F.lit(8 * len(rows.columns)).cast("long"),
    )
    found = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()
    return found["n"] <= max_rows and found["size"] <= max_bytes


def attach(
    facts: DataFrame,
    small: DataFrame,
    on: list[str],
    spread: str,
    how: str = "left",
    max_rows: int = MAX_ROWS,
    salts: int = 64,
) -> DataFrame:
    """Join ``small`` to ``facts``: broadcast if its size allows, else salted.

    The salted join copies ``small`` once per salt and spreads the rows of one
    key over ``salts`` tasks by the hash of column ``spread``, so one key may
    hold any share of ``facts``. NULL keys are spread as well.
    """
    if fits_broadcast(small, max_rows=max_rows):
        return facts.join(F.broadcast(small), on, how)
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def only_of(rows: DataFrame, key: str, ids: DataFrame, max_rows: int = 4_000_000) -> DataFrame:
    """Rows whose ``key`` is among ``ids``; a few ids are broadcast.

    ``ids`` is counted first, so it should be a stored table.
    """
    wanted = ids.select(F.col("id").alias(key))
    if fits_broadcast(wanted, max_rows=max_rows):
        wanted = F.broadcast(wanted)
    return rows.join(wanted, key, "left_semi")
