"""Table schemas and the status codes of the registries."""

from __future__ import annotations

from pyspark.sql import types as T

TABLES = {
    "user_event": (
        "id LONG, name STRING, value STRING, email STRING, valid STRING, migrated BOOLEAN, "
        "user_id LONG, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, "
        "integration_id LONG, integration_type STRING, uuid STRING"
    ),
    "event_property": (
        "id LONG, name STRING, value STRING, event_id LONG, "
        "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
    ),
    "event_schema": (
        "id LONG, name STRING, help_name STRING, description STRING, db_status INT, "
        "migrate_status INT, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, "
        "is_active BOOLEAN, is_migrated BOOLEAN"
    ),
    "property_event_schema": (
        "id LONG, name STRING, event_id LONG, help_name STRING, type STRING, db_status INT, "
        "migrate_status INT, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, is_active BOOLEAN"
    ),
    "user_company": (
        "id LONG, email STRING, first_name STRING, last_name STRING, mobile_number STRING, "
        "birth_data STRING, updated_at TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, "
        "anonymous_id STRING, user_uuid STRING, city STRING, country STRING, department STRING, "
        "gender STRING, user_ref_id STRING, identification STRING, identification_type STRING, "
        "migrate STRING"
    ),
    "user_property": "id LONG, name STRING, value STRING, user_id LONG",
    "property_user_schema": (
        "id LONG, name STRING, type STRING, db_status STRING, migrate_status STRING"
    ),
    "event_status": "event_id LONG, valid STRING, migrated BOOLEAN, run_id LONG",
}


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


# The columns every wide event table has besides its properties.
BASE_COLUMNS = {
    "id": T.LongType(),
    "updated_at": T.DateType(),
    "created_at": T.DateType(),
    "user_id": T.LongType(),
    "integration_id": T.LongType(),
    "integration_type": T.StringType(),
    "uuid": T.StringType(),
}

# The columns of an identified user.
IDENTIFIED_COLUMNS = [
    "id", "email", "first_name", "last_name", "mobile_number", "birth_data", "updated_at",
    "created_at", "anonymous_id", "user_uuid", "city", "country", "department", "gender",
    "user_ref_id", "identification", "identification_type",
]

# Status codes of event registries.
DB_STATUS = {
    "edit_in_progress": 1,
    "create_pending": 2,
    "create_in_progress": 3,
    "create_failed": 4,
    "create_completed": 5,
    "alter_table_in_progress": 6,
}
MIGRATE_STATUS = {
    "db_pending": 1,
    "migrate_pending": 2,
    "migrate_in_progress": 3,
    "migrate_failed": 4,
    "migrate_completed": 5,
}

# The user registry spells this status the other way round.
USER_CREATE_PENDING = "pending_create"

# Verdicts on an event, and the flag of a migrated user.
VALID, INVALID, MIGRATED = "validated", "unvalid", "migrated"


def status_code(name: str) -> int:
    """Code of a database status, in either spelling."""
    return DB_STATUS["create_pending" if name == USER_CREATE_PENDING else name]
