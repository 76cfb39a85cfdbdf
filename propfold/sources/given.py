"""Event and user tables derived from the given star-schema tables.

Every row of ``events``, ``documents``, ``orders`` and ``customer`` takes part.
Missing, odd and repeated values follow from the data itself: the hour or day of
an event, the number in its properties, the segment or nation of a customer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# First ids of the events that stand for orders and documents.
ORDER_IDS = 1_000_000_000_000
DOCUMENT_IDS = 2_000_000_000_000

# The declared properties of each event type: column, raw spelling, type.
DECLARED = {
    "purchase": [
        ("valor_total", "VALOR TOTAL", "numeric"),
        ("k", "K", "integer"),
        ("fecha", "FECHA", "date"),
        ("correo_ano", "Correo |Año", "varchar"),
    ],
    "signup": [("valor_total", "valor_total", "varchar"), ("k", "K", "varchar")],
    "view": [("k", "K", "integer")],
    "fallo": [
        ("valor_total", "VALOR TOTAL", "numeric"),
        ("k", "K", "integer"),
        ("fecha", "FECHA", "date"),
        ("correo_ano", "Correo |Año", "varchar"),
        ("extra_field", "Extra Field", "integer"),
    ],
    "documento_leido": [
        ("texto", "Texto", "varchar"),
        ("idioma", "Idioma", "varchar"),
        ("no_caracteres", "Nº Caracteres", "integer"),
        ("id", "ID", "integer"),
        ("id_prop", "ID Prop", "varchar"),
    ],
    "pedido_f": [
        ("valor_total", "Valor Total", "numeric"),
        ("fecha", "Fecha", "date"),
        ("prioridad", "Prioridad", "varchar"),
        ("cliente", "Cliente", "integer"),
    ],
    "pedido_o": [
        ("valor_total", "Valor Total", "integer"),
        ("fecha", "Fecha", "date"),
        ("prioridad", "Prioridad", "varchar"),
        ("cliente", "Cliente", "integer"),
    ],
}


# Columns read from the given tables.
GIVEN = {
    "events": "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, "
    "value DOUBLE, props STRING",
    "orders": "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "documents": "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG",
    "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
}

K = "regexp_extract(props, '[0-9]+', 0)"
ORDER_ID = f"{ORDER_IDS} + o_orderkey"
DOCUMENT_ID = f"{DOCUMENT_IDS} + doc_id"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{folder}/{name}.parquet")


def money(amount: str) -> str:
    return f"string(cast({amount} as decimal(18,2)))"


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").selectExpr(
        "event_id as id",
        "if(event_type = 'purchase' and hour(ts) = 7, 'Purchase|', upper(event_type)) as name",
        f"{money('value')} as value",
        "concat('u', user_id, '@example.com') as email",
        "string(null) as valid",
        "if(hour(ts) = 5, null, ts < timestamp_ntz'2024-01-04') as migrated",
        "user_id",
        "ts as created_at",
        "ts as updated_at",
        f"bigint({K}) as integration_id",
        "'sdk' as integration_type",
        "concat('uuid-', event_id) as uuid",
    )
    orders = table(spark, folder, "orders").selectExpr(
        f"{ORDER_ID} as id",
        "concat('Pedido ', o_orderstatus) as name",
        f"{money('o_totalprice')} as value",
        "string(null) as email",
        "string(null) as valid",
        "false as migrated",
        "o_custkey as user_id",
        "o_orderdate as created_at",
        "o_orderdate as updated_at",
        "bigint(null) as integration_id",
        "'shop' as integration_type",
        "concat('order-', o_orderkey) as uuid",
    )
    documents = table(spark, folder, "documents").selectExpr(
        f"{DOCUMENT_ID} as id",
        "'Documento Leído' as name",
        "string(n_chars) as value",
        "string(null) as email",
        "string(null) as valid",
        "false as migrated",
        "doc_id as user_id",
        "timestamp_ntz'2024-02-01' as created_at",
        "timestamp_ntz'2024-02-01' as updated_at",
        "bigint(null) as integration_id",
        "source as integration_type",
        "concat('doc-', doc_id) as uuid",
    )
    return events.unionByName(orders).unionByName(documents)


def property_rows(
    rows: DataFrame, owner: str, cells: list[tuple[str, str, str]], key: str = "event_id"
) -> DataFrame:
    """One row per cell that is present: name, value, presence. One scan."""
    entries = [
        f"if({present}, named_struct('id', ({owner}) * 10 + {place}, 'name', '{name}', "
        f"'value', string({value}), '{key}', {owner}), null)"
        for place, (name, value, present) in enumerate(cells, start=1)
    ]
    return rows.selectExpr(f"inline(array_compact(array({', '.join(entries)})))")


def event_properties(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").selectExpr(
        "event_id",
        "event_type",
        "user_id",
        "value > 100 as large",
        "hour(ts) <> 3 as kept",
        "day(ts) as day",
        "string(date(ts)) as date",
        f"{money('value')} as amount",
        f"{K} as k",
    )
    number = "int(k)"
    written = (
        f"case when {number} <= 7 then replace(amount, '.', ',') "
        f"when {number} <= 16 then concat('$', amount) "
        f"when {number} <= 18 then concat(amount, ' €') else amount end"
    )
    counted = (
        f"case when {number} between 37 and 39 then concat(k, '.5') "
        f"when {number} < 3 then concat(' ', k, ' ') else k end"
    )
    dated = "case day when 30 then '2024-02-30' when 15 then concat(date, 'T10:00:00') else date end"
    mail = "if(user_id < 22, 'no mail here', concat('u ', user_id, ' @example.com'))"
    events = property_rows(
        events,
        "event_id",
        [
            ("VALOR TOTAL", written, "kept and event_type <> 'signup'"),
            ("K", counted, f"kept and {number} <> 19"),
            ("FECHA", dated, "kept"),
            ("Correo |Año", mail, "kept"),
            ("Valor Total", "'7.25'", "kept and large"),
            ("Extra Field", "null", "event_type = 'error'"),
            ("valor_total", written, "kept and event_type = 'signup'"),
        ],
    )
    orders = property_rows(
        table(spark, folder, "orders"),
        ORDER_ID,
        [
            ("Valor Total", money("o_totalprice"), "true"),
            ("Fecha", "date(o_orderdate)", "true"),
            ("Prioridad", "o_orderpriority", "true"),
            ("Cliente", "o_custkey", "true"),
        ],
    )
    documents = property_rows(
        table(spark, folder, "documents"),
        DOCUMENT_ID,
        [
            ("Texto", "text", "true"),
            ("Idioma", "lang", "true"),
            ("Nº Caracteres", "n_chars", "true"),
            ("ID", "doc_id", "true"),
        ],
    )
    return events.unionByName(orders).unionByName(documents)


def event_schemas(spark: SparkSession, folder: str) -> DataFrame:
    """Registered event types: all but ``click`` and the orders in state P.

    The type of errors has another name than its events, which its spelling tells.
    """
    events = (
        table(spark, folder, "events")
        .where("event_type <> 'click'")
        .groupBy(F.col("event_type").alias("name"))
        .agg(F.min("event_id").alias("id"))
        .selectExpr("id", "if(name = 'error', 'fallo', name) as name", "upper(name) as help_name")
    )
    orders = (
        table(spark, folder, "orders")
        .where("o_orderstatus <> 'P'")
        .groupBy("o_orderstatus")
        .agg(F.expr(f"min({ORDER_ID})").alias("id"))
        .selectExpr(
            "id",
            "concat('pedido_', lower(o_orderstatus)) as name",
            "concat('Pedido ', o_orderstatus) as help_name",
        )
    )
    documents = table(spark, folder, "documents").selectExpr(
        f"min({DOCUMENT_ID}) as id", "'documento_leido' as name", "'Documento Leído' as help_name"
    )
    return (
        events.unionByName(orders)
        .unionByName(documents)
        .selectExpr(
            "id",
            "name",
            "help_name",
            "if(name = 'view', 5, 2) as db_status",
            "if(name = 'view', 4, 1) as migrate_status",
            "true as is_active",
            "name = 'view' as is_migrated",
        )
    )


def event_property_schemas(spark: SparkSession, folder: str) -> DataFrame:
    """The declared properties of the registered event types."""
    listed = [
        (event_type, place, *spec)
        for event_type, columns in DECLARED.items()
        for place, spec in enumerate(columns, start=1)
    ]
    declared = spark.createDataFrame(
        listed, "event_type string, place int, name string, help_name string, type string"
    )
    kinds = event_schemas(spark, folder).selectExpr("id as event_id", "name as event_type")
    return kinds.join(F.broadcast(declared), "event_type").selectExpr(
        "event_id * 100 + place as id", "name", "event_id", "help_name", "type"
    )


def user_companies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "c_custkey as id",
        "if(c_mktsegment <> 'MACHINERY', concat('c', c_custkey, '@example.com'), null) as email",
        "c_name as first_name",
        "string(null) as last_name",
        "if(c_nationkey >= 4, concat('555', c_custkey), null) as mobile_number",
        "string(null) as birth_data",
        "cast(null as timestamp_ntz) as updated_at",
        "cast(null as timestamp_ntz) as created_at",
        "concat('anon-', c_custkey) as anonymous_id",
        "string(null) as user_uuid",
        "c_mktsegment as city",
        "string(c_nationkey) as country",
        "string(null) as department",
        "string(null) as gender",
        "string(null) as user_ref_id",
        "if(c_acctbal > 2000, concat('ID', c_custkey), null) as identification",
        "if(c_acctbal > 8000, 'CC', null) as identification_type",
        "if(c_nationkey = 9, 'migrated', null) as migrate",
    )


def user_properties(spark: SparkSession, folder: str) -> DataFrame:
    kind = "case when c_nationkey = 1 then '' when c_nationkey <> 2 then 'CC' end"
    other = "if(c_acctbal < 3000, 'CC', 'TI')"
    mail = "concat('c', c_custkey, if(c_nationkey = 20, '@mail.example', '@example.com'))"
    car = "c_mktsegment = 'AUTOMOBILE'"
    amount = (
        f"case c_nationkey when 5 then replace({money('c_acctbal')}, '.', ',') "
        f"when 6 then concat('$', {money('c_acctbal')}) "
        f"when 7 then concat({money('c_acctbal')}, ' €') else {money('c_acctbal')} end"
    )
    return property_rows(
        table(spark, folder, "customer"),
        "c_custkey",
        [
            ("identification_type", kind, "c_acctbal > -500"),
            ("identification_type", other, "c_nationkey > 15"),
            ("CANTIDAD_CORTESIA", f"concat(' ', {amount}, ' ')", "true"),
            ("nickname", "c_name", car),
            ("nickname", "if(c_nationkey <> 3, lower(c_name), null)", car),
            ("email", mail, "c_mktsegment = 'MACHINERY' or c_nationkey in (20, 21)"),
        ],
        key="user_id",
    )


def user_property_schemas(spark: SparkSession, folder: str) -> DataFrame:
    """Registered user properties: every observed name."""
    return (
        user_properties(spark, folder)
        .groupBy(F.lower("name").alias("name"))
        .agg(F.min("id").alias("id"))
        .selectExpr(
            "id",
            "name",
            "if(name = 'cantidad_cortesia', 'numeric', 'varchar') as type",
            "if(name = 'cantidad_cortesia', 'pending_create', 'create_completed') as db_status",
            "case name when 'cantidad_cortesia' then 'db_pending' "
            "when 'nickname' then 'migrate_pending' else 'migrate_completed' end as migrate_status",
        )
    )


# The tables a query asks for by name.
DERIVED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "user_event": user_events,
    "event_property": event_properties,
    "event_schema": event_schemas,
    "property_event_schema": event_property_schemas,
    "user_company": user_companies,
    "user_property": user_properties,
    "property_user_schema": user_property_schemas,
}
