"""Turn user properties into columns of the user table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propfold.functions.names import column
from propfold.functions.values import READERS, accepts, read_as, spark_type, truthy
from propfold.operators.scans import has_identifier, identified_users
from propfold.sources.schemas import IDENTIFIED_COLUMNS, MIGRATED

# A user registry row is one column of the user table.
MAX_COLUMNS = 10_000
# Columns as columns of one aggregation up to this number, as one map beyond.
COLUMNS_PER_FOLD = 64

# Actions after which the property rows are gone.
CONSUMING = ("already_equal", "fill", "overwrite", "drop_empty")


def declared_columns(schemas: DataFrame, condition: Column) -> dict[str, str]:
    """Name and type of registry rows, brought to the driver to plan columns."""
    rows = schemas.where(condition).select("id", "name", "type").limit(MAX_COLUMNS + 1).collect()
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"over {MAX_COLUMNS} user columns in one run")
    return {row["name"]: row["type"] for row in sorted(rows, key=lambda row: row["id"])}


def to_create() -> Column:
    return F.col("db_status") == "pending_create"


def to_promote() -> Column:
    return (F.col("db_status") == "create_completed") & (
        F.col("migrate_status") == "migrate_pending"
    )


def evolve_user_columns(users: DataFrame, schemas: DataFrame) -> DataFrame:
    """Users with an empty column for each registered property to be created."""
    present = {name.lower() for name in users.columns}
    new = {
        name: F.lit(None).cast(spark_type(declared))
        for name, declared in declared_columns(schemas, to_create()).items()
        if name.lower() not in present
    }
    return users.withColumns(new)


def columns_created(schemas: DataFrame) -> DataFrame:
    """The user registry after the pending columns were created."""
    created = to_create()
    return schemas.withColumns(
        {
            "db_status": F.when(created, "create_completed").otherwise(F.col("db_status")),
            "migrate_status": F.when(created, "migrate_pending").otherwise(F.col("migrate_status")),
        }
    )


def promotion_done(schemas: DataFrame) -> DataFrame:
    """The user registry after the waiting properties were promoted."""
    status = F.when(to_promote(), "migrate_completed").otherwise(F.col("migrate_status"))
    return schemas.withColumn("migrate_status", status)


def promotable(properties: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Property rows with ``_fits``: does the row carry a value that fits its column?"""
    declared = properties.sparkSession.createDataFrame(
        list(columns.items()), "name string, _type string"
    )
    value, kind = F.col("value"), F.col("_type")
    fits = F.lit(True)
    for listed in READERS:
        fits = F.when(kind == listed, accepts(value, listed)).otherwise(fits)
    # Broadcast: one row per column, all from the driver.
    return properties.join(F.broadcast(declared), "name", "left").withColumn(
        "_fits", kind.isNotNull() & value.isNotNull() & fits
    )


def as_map(long_form: DataFrame) -> DataFrame:
    """Rows (user_id, name, value), one for each user and name, as one map for each user.

    A map holds no more entries than there are columns.
    """
    entries = F.collect_list(F.struct("name", "value"))
    return long_form.groupBy("user_id").agg(F.map_from_entries(entries).alias("_new"))


def promote_user_properties(
    users: DataFrame,
    properties: DataFrame,
    columns: dict[str, str],
    max_cell_columns: int | None = None,
) -> DataFrame:
    """Users with promoted values set; of several values the latest row's wins.

    One aggregation and one join for any number of columns. Up to ``max_cell_columns``
    (``COLUMNS_PER_FOLD``) each is a column of the aggregation; beyond, the values of a user are one map.
    """
    if not columns:
        return users
    entry = F.struct("id", "value")
    rows = promotable(properties, columns).where("_fits")
    if len(columns) > (max_cell_columns or COLUMNS_PER_FOLD):
        latest = as_map(rows.groupBy("user_id", "name").agg(F.max(entry)["value"].alias("value")))
        texts = [F.try_element_at("_new", F.lit(name)) for name in columns]
    else:
        latest = rows.groupBy("user_id").agg(
            *(
                F.max(F.when(F.col("name") == name, entry))["value"].alias(f"_new_{n}")
                for n, name in enumerate(columns)
            )
        )
        texts = [F.col(f"_new_{n}") for n in range(len(columns))]
    # Spark resolves columns without regard to case, so names that differ by it are one.
    targets = {name.lower(): name for name in users.columns}
    values = {name: column(name) for name in users.columns}
    updated = {}
    for text, (name, declared) in zip(texts, columns.items(), strict=True):
        target = targets.setdefault(name.lower(), name)
        new = read_as(text, declared)
        values[target] = F.coalesce(new, values[target]) if target in values else new
        updated[target] = values[target]
    joined = users.join(latest, users["id"] == latest["user_id"], "left")
    return joined.withColumns(updated).select(*map(column, targets.values()))


def unpromoted_properties(
    users: DataFrame, properties: DataFrame, columns: dict[str, str]
) -> DataFrame:
    """Property rows that promotion leaves behind, those of unknown users among them."""
    known = users.select(F.col("id").alias("user_id"), F.lit(True).alias("_known")).distinct()
    judged = promotable(properties, columns).join(known, "user_id", "left")
    return judged.where("not _fits or _known is null").select(*properties.columns)


def value_range(text: Column) -> dict[str, Column]:
    """Lowest and highest non-empty value.

    They tell no value, one value and several apart. That spares the second
    shuffle of a distinct count and combines on the map side.
    """
    return {"low": F.min(truthy(text)), "high": F.max(truthy(text))}


def consolidation(
    users: DataFrame, properties: DataFrame, names: list[str] | None = None
) -> DataFrame:
    """What becomes of each user's rows of a property.

    One row per user and property: the action, the value the user column has
    afterwards (where there is such a column), and the number of rows. Rows are
    grouped before they meet the users, so a user with very many rows counts for
    one row per property in the join.
    """
    if names is not None:
        properties = properties.where(F.col("name").isin(names))
    name, low, high = F.col("name"), F.col("low"), F.col("high")
    ranges = properties.groupBy("user_id", "name").agg(
        F.count("*").alias("n_rows"),
        *(value.alias(label) for label, value in value_range(F.col("value")).items()),
    )
    columns = [field for field in users.schema if field.name != "id"]
    current = F.coalesce(
        *(F.when(name == f.name, column(f.name, "_user").cast("string")) for f in columns)
    )
    fits = F.coalesce(
        *(F.when(name == f.name, low.try_cast(f.dataType).isNotNull()) for f in columns)
    )
    known = users.select(
        F.col("id").alias("user_id"), F.struct(*(column(f.name) for f in columns)).alias("_user")
    )
    decision = (
        F.when(low < high, "conflict")
        .when(low.isNull(), "drop_empty")
        .when(~name.isin([f.name for f in columns]), "no_column")
        .when(F.col("_user").isNull(), "no_user")
        .when(~fits, "misfit")
        .when(current == low, "already_equal")
        .when(current.isNull(), "fill")
        .otherwise("overwrite")
    )
    return (
        ranges.join(known, "user_id", "left")
        .withColumn("action", decision)
        .select(
            "user_id",
            "name",
            "action",
            F.when(F.col("action").isin("fill", "overwrite"), low).otherwise(current).alias("new_value"),
            "n_rows",
        )
    )


def consolidated_users(
    users: DataFrame,
    properties: DataFrame,
    names: list[str] | None = None,
    max_cell_columns: int | None = None,
) -> DataFrame:
    """Users after consolidation: a single value of a property sets its column.

    One aggregation and one join, as in promotion.
    """
    columns = [
        field.name
        for field in users.schema
        if field.name != "id" and (names is None or field.name in names)
    ]
    if not columns:
        return users
    rows = properties.where(F.col("name").isin(columns))
    if len(columns) > (max_cell_columns or COLUMNS_PER_FOLD):
        low, high = value_range(F.col("value")).values()
        ranges = rows.groupBy("user_id", "name").agg(low.alias("value"), high.alias("_high"))
        single = as_map(ranges.where(F.col("value") == F.col("_high")).drop("_high"))
        texts = [F.try_element_at("_new", F.lit(name)) for name in columns]
    else:
        single = rows.groupBy("user_id").agg(
            *(
                value.alias(f"_{label}_{n}")
                for n, name in enumerate(columns)
                for label, value in value_range(
                    F.when(F.col("name") == name, F.col("value"))
                ).items()
            )
        )
        ranges = [(F.col(f"_low_{n}"), F.col(f"_high_{n}")) for n in range(len(columns))]
        texts = [F.when(low == high, low) for low, high in ranges]
    updated = {
        name: F.coalesce(text.try_cast(users.schema[name].dataType), column(name))
        for text, name in zip(texts, columns, strict=True)
    }
    joined = users.join(single, users["id"] == single["user_id"], "left")
    return joined.withColumns(updated).select(*map(column, users.columns))


def unconsolidated_properties(properties: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Property rows that consolidation leaves behind."""
    gone = outcomes.where(F.col("action").isin(*CONSUMING)).select("user_id", "name")
    return properties.join(gone, ["user_id", "name"], "left_anti")


def users_to_migrate(users: DataFrame) -> DataFrame:
    """Identified users that are not flagged as migrated."""
    open_ = F.col("migrate").isNull() | (F.col("migrate") != MIGRATED)
    return identified_users(users).where(open_)


def migrate_identified_users(users: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Rows to append to the table of identified users."""
    rows = users_to_migrate(users).select(*IDENTIFIED_COLUMNS)
    return rows if target is None else rows.join(target.select("id"), "id", "left_anti")


def flag_migrated_users(users: DataFrame) -> DataFrame:
    """Users with the identified ones flagged as migrated."""
    return users.withColumn("migrate", F.when(has_identifier(), MIGRATED).otherwise(F.col("migrate")))


def mark_migrated(events: DataFrame, migrated: DataFrame) -> DataFrame:
    """Events with those listed in ``migrated`` (by ``id``) flagged."""
    hits = migrated.select("id").distinct().withColumn("_hit", F.lit(True))
    flagged = F.when(F.col("_hit"), True).otherwise(F.col("migrated"))
    return events.join(hits, "id", "left").withColumn("migrated", flagged).select(*events.columns)
