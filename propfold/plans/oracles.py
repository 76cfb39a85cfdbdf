"""SQL that must give the same rows as each registered query.

Every statement runs over the given tables. The derived event and user tables
are written out again here as common table expressions.
"""

from __future__ import annotations

import re

from propfold.functions import names as n
from propfold.functions import scripts
from propfold.functions import values as v
from propfold.sources.given import DECLARED, DOCUMENT_IDS, ORDER_IDS
from propfold.sources.schemas import IDENTIFIED_COLUMNS

MONEY = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)"
K = "regexp_extract(props, '[0-9]+')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def other_scripts(text: str) -> str:
    table = n.several_letters()
    known = f"map(string_split({quoted(' '.join(table))}, ' '), string_split({quoted(' '.join(table.values()))}, ' '))"
    place = f"(unicode(c) - {scripts.HANGUL_FIRST})"
    numbers = (f"{place} // 588", f"{place} % 588 // 28", f"{place} % 28")
    parts = [
        f"replace(string_split({quoted(' '.join(names))}, ' ')[{number} + 1], '.', '')"
        for names, number in zip(scripts.HANGUL, numbers, strict=True)
    ]
    syllable = f"{place} BETWEEN 0 AND {scripts.HANGUL_LAST - scripts.HANGUL_FIRST}"
    one = f"coalesce({known}[c], CASE WHEN {syllable} THEN {' || '.join(parts)} ELSE c END)"
    return f"array_to_string(list_transform(string_split({text}, ''), lambda c: {one}), '')"


def normal_form(text: str) -> str:
    raw = text
    for old, new in n.REPLACEMENTS:
        text = f"replace({text}, {quoted(old)}, {quoted(new)})"
    text = f"CASE WHEN regexp_matches({raw}, {quoted(n.BEYOND_LATIN)}) THEN {other_scripts(text)} ELSE {text} END"
    old, new = n.one_to_one()
    text = f"translate({text}, {quoted(old)}, {quoted(new)})"
    for sign, letters in n.SEVERAL.items():
        text = f"replace({text}, {quoted(sign)}, {quoted(letters)})"
    return text


def identifier(text: str) -> str:
    return f"lower({normal_form(text)})"


def comparison_key(text: str) -> str:
    return f"upper({normal_form(text)})"


def property_branches() -> str:
    amount, i = MONEY.format("value"), f"CAST({K} AS INT)"
    day = "CAST(CAST(ts AS DATE) AS VARCHAR)"
    written = f"""CASE WHEN {i} <= 7 THEN replace({amount}, '.', ',')
        WHEN {i} <= 16 THEN '$' || {amount} WHEN {i} <= 18 THEN {amount} || ' €' ELSE {amount} END"""
    number = f"CASE WHEN {i} BETWEEN 37 AND 39 THEN {K} || '.5' WHEN {i} < 3 THEN ' ' || {K} || ' ' ELSE {K} END"
    date = f"CASE day(ts) WHEN 30 THEN '2024-02-30' WHEN 15 THEN {day} || 'T10:00:00' ELSE {day} END"
    mail = "CASE WHEN user_id < 22 THEN 'no mail here' ELSE 'u ' || user_id || ' @example.com' END"
    kept = "hour(ts) <> 3"
    branches = [
        f"SELECT event_id*10+{place} AS id, {quoted(name)} AS name, {value} AS value, event_id FROM events WHERE {where}"
        for place, name, value, where in [
            (1, "VALOR TOTAL", written, f"{kept} AND event_type <> 'signup'"),
            (2, "K", number, f"{kept} AND {i} <> 19"),
            (3, "FECHA", date, kept),
            (4, "Correo |Año", mail, kept),
            (5, "Valor Total", "'7.25'", f"{kept} AND value > 100"),
            (6, "Extra Field", "CAST(NULL AS VARCHAR)", "event_type = 'error'"),
            (7, "valor_total", written, f"{kept} AND event_type = 'signup'"),
        ]
    ]
    order_id, doc_id = f"({ORDER_IDS}+o_orderkey)", f"({DOCUMENT_IDS}+doc_id)"
    branches += [
        f"SELECT {order_id}*10+{place}, {quoted(name)}, {value}, {order_id} FROM orders"
        for place, name, value in [
            (1, "Valor Total", MONEY.format("o_totalprice")),
            (2, "Fecha", "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"),
            (3, "Prioridad", "o_orderpriority"),
            (4, "Cliente", "CAST(o_custkey AS VARCHAR)"),
        ]
    ]
    branches += [
        f"SELECT {doc_id}*10+{place}, {quoted(name)}, {value}, {doc_id} FROM documents"
        for place, name, value in [
            (1, "Texto", "text"),
            (2, "Idioma", "lang"),
            (3, "Nº Caracteres", "CAST(n_chars AS VARCHAR)"),
            (4, "ID", "CAST(doc_id AS VARCHAR)"),
        ]
    ]
    return " UNION ALL ".join(branches)


def declared_values() -> str:
    rows = [
        f"({quoted(event)}, {place}, {', '.join(map(quoted, spec))})"
        for event, columns in DECLARED.items()
        for place, spec in enumerate(columns, start=1)
    ]
    return ", ".join(rows)


def user_branches() -> str:
    kind = "CASE WHEN c_nationkey = 1 THEN '' WHEN c_nationkey <> 2 THEN 'CC' END"
    amount = MONEY.format("c_acctbal")
    amount = f"""CASE c_nationkey WHEN 5 THEN replace({amount}, '.', ',') WHEN 6 THEN '$' || {amount}
        WHEN 7 THEN {amount} || ' €' ELSE {amount} END"""
    mail = "'c' || c_custkey || CASE WHEN c_nationkey = 20 THEN '@mail.example' ELSE '@example.com' END"
    return " UNION ALL ".join(
        f"SELECT c_custkey*10+{place} AS id, {quoted(name)} AS name, {value} AS value, c_custkey AS user_id FROM customer WHERE {where}"
        for place, name, value, where in [
            (1, "identification_type", kind, "c_acctbal > -500"),
            (2, "identification_type", "CASE WHEN c_acctbal < 3000 THEN 'CC' ELSE 'TI' END", "c_nationkey > 15"),
            (3, "CANTIDAD_CORTESIA", f"' ' || {amount} || ' '", "true"),
            (4, "nickname", "c_name", "c_mktsegment = 'AUTOMOBILE'"),
            (5, "nickname", "CASE WHEN c_nationkey <> 3 THEN lower(c_name) END", "c_mktsegment = 'AUTOMOBILE'"),
            (6, "email", mail, "c_mktsegment = 'MACHINERY' OR c_nationkey IN (20, 21)"),
        ]
    )


def text_accepted(value: str, declared: str) -> str:
    """Does ``value`` fit the type named by the SQL expression ``declared``?"""
    pointed = f"replace({value}, ',', '.')"
    return f"""CASE {declared}
        WHEN 'varchar' THEN true
        WHEN 'integer' THEN {read_integer(value)} IS NOT NULL
        WHEN 'numeric' THEN {read_numeric(pointed)} IS NOT NULL
        WHEN 'date' THEN {read_date(value)} IS NOT NULL ELSE true END"""


def read_integer(value: str) -> str:
    return f"CASE WHEN regexp_matches({value}, {quoted(v.INTEGER_TEXT)}) THEN try_cast(trim({value}) AS INT) END"


def read_numeric(value: str, kind: str = "DECIMAL(38,18)") -> str:
    return f"CASE WHEN regexp_matches({value}, {quoted(v.NUMERIC_TEXT)}) THEN try_cast(trim({value}) AS {kind}) END"


def read_date(value: str) -> str:
    real = f"regexp_matches({value}, {quoted(v.DATE_TEXT)}) AND {value} NOT LIKE '0000%'"
    return f"CASE WHEN {real} THEN try_cast(substr({value}, 1, 10) AS DATE) END"


# Amounts with two decimals, times a power of ten: whole cents give the digits.
SCALED = r"""(
    SELECT *, rtrim(CAST(cents AS VARCHAR), '0') AS d, length(CAST(cents AS VARCHAR)) - 3 + power AS e
    FROM (
        SELECT id, name, CAST(replace(value, '.', '') AS BIGINT) AS cents, event_id % 2 AS odd,
            event_id % 61 - 30 AS power
        FROM event_property WHERE regexp_matches(value, '^[0-9]+[.][0-9]{2}$')))"""
EXACT_TEXT = """CASE WHEN cents = 0 THEN '0' ELSE CASE odd WHEN 1 THEN '-' ELSE '' END || substr(d, 1, 1)
    || CASE WHEN length(d) > 1 THEN '.' || substr(d, 2) ELSE '' END || 'e' || e END"""


CTES = {
    "user_event": f"""
        SELECT event_id AS id,
            CASE WHEN event_type = 'purchase' AND hour(ts) = 7 THEN 'Purchase|' ELSE upper(event_type) END AS name,
            {MONEY.format("value")} AS value, 'u' || user_id || '@example.com' AS email,
            CAST(NULL AS VARCHAR) AS valid,
            CASE WHEN hour(ts) <> 5 THEN ts < TIMESTAMP '2024-01-04' END AS migrated,
            user_id, ts AS created_at, ts AS updated_at, CAST({K} AS BIGINT) AS integration_id,
            'sdk' AS integration_type, 'uuid-' || event_id AS uuid
        FROM events
        UNION ALL
        SELECT {ORDER_IDS} + o_orderkey, 'Pedido ' || o_orderstatus, {MONEY.format("o_totalprice")},
            NULL, NULL, false, o_custkey, o_orderdate, o_orderdate, NULL, 'shop', 'order-' || o_orderkey
        FROM orders
        UNION ALL
        SELECT {DOCUMENT_IDS} + doc_id, 'Documento Leído', CAST(n_chars AS VARCHAR), NULL, NULL, false,
            doc_id, TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-01', NULL, source, 'doc-' || doc_id
        FROM documents""",
    "event_property": property_branches(),
    "event_schema": f"""
        SELECT min(event_id) AS id, CASE event_type WHEN 'error' THEN 'fallo' ELSE event_type END AS name,
            upper(event_type) AS help_name,
            CASE event_type WHEN 'view' THEN 5 ELSE 2 END AS db_status,
            CASE event_type WHEN 'view' THEN 4 ELSE 1 END AS migrate_status,
            true AS is_active, event_type = 'view' AS is_migrated
        FROM events WHERE event_type <> 'click' GROUP BY event_type
        UNION ALL
        SELECT min({ORDER_IDS} + o_orderkey), 'pedido_' || lower(o_orderstatus), 'Pedido ' || o_orderstatus,
            2, 1, true, false
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus
        UNION ALL
        SELECT min({DOCUMENT_IDS} + doc_id), 'documento_leido', 'Documento Leído', 2, 1, true, false
        FROM documents""",
    "property_event_schema": f"""
        SELECT s.id * 100 + d.place AS id, d.name, s.id AS event_id, d.help_name, d.type
        FROM event_schema s JOIN (VALUES {declared_values()}) AS d(event, place, name, help_name, type)
        ON s.name = d.event""",
    "user_company": """
        SELECT c_custkey AS id,
            CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'c' || c_custkey || '@example.com' END AS email,
            c_name AS first_name, CAST(NULL AS VARCHAR) AS last_name,
            CASE WHEN c_nationkey >= 4 THEN '555' || c_custkey END AS mobile_number,
            CAST(NULL AS VARCHAR) AS birth_data, CAST(NULL AS TIMESTAMP) AS updated_at,
            CAST(NULL AS TIMESTAMP) AS created_at, 'anon-' || c_custkey AS anonymous_id,
            CAST(NULL AS VARCHAR) AS user_uuid, c_mktsegment AS city,
            CAST(c_nationkey AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS department,
            CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS user_ref_id,
            CASE WHEN c_acctbal > 2000 THEN 'ID' || c_custkey END AS identification,
            CASE WHEN c_acctbal > 8000 THEN 'CC' END AS identification_type,
            CASE WHEN c_nationkey = 9 THEN 'migrated' END AS migrate
        FROM customer""",
    "user_property": user_branches(),
    "property_user_schema": """
        SELECT min(id) AS id, lower(name) AS name,
            CASE lower(name) WHEN 'cantidad_cortesia' THEN 'numeric' ELSE 'varchar' END AS type,
            CASE lower(name) WHEN 'cantidad_cortesia' THEN 'pending_create' ELSE 'create_completed' END AS db_status,
            CASE lower(name) WHEN 'cantidad_cortesia' THEN 'db_pending'
                WHEN 'nickname' THEN 'migrate_pending' ELSE 'migrate_completed' END AS migrate_status
        FROM user_property GROUP BY lower(name)""",
    # Property names and event names with their normal form, once per spelling.
    "clean_names": f"""
        SELECT name, {identifier("name")} AS clean
        FROM (SELECT name FROM event_property UNION SELECT name FROM user_event)""",
    # The event type of each event name: by normal form, else as spelt.
    "event_kind": """
        SELECT n.name, coalesce(a.id, b.id) AS schema_id FROM clean_names n
        LEFT JOIN event_schema a ON a.name = n.clean LEFT JOIN event_schema b ON b.help_name = n.name
        WHERE a.id IS NOT NULL OR b.id IS NOT NULL""",
    "typed_event": """
        SELECT e.*, s.id AS schema_id, s.name AS schema
        FROM user_event e JOIN event_kind k USING (name) JOIN event_schema s ON s.id = k.schema_id
        WHERE s.db_status = 2""",
    "judged_property": f"""
        SELECT e.id AS event_id, e.schema_id, e.schema, e.migrated, p.id, p.name, p.value, c.clean, d.type,
            d.type IS NOT NULL AS known,
            d.type IS NOT NULL AND coalesce({text_accepted("p.value", "d.type")}, false) AS ok
        FROM typed_event e JOIN event_property p ON p.event_id = e.id JOIN clean_names c ON c.name = p.name
        LEFT JOIN property_event_schema d ON d.event_id = e.schema_id AND d.name = c.clean""",
    "cleaned_property": """
        SELECT p.id, p.name, p.event_id, c.clean, d.type, CASE d.type
            WHEN 'numeric' THEN replace(replace(replace(replace(p.value, ' ', ''), '$', ''), '€', ''), ',', '.')
            WHEN 'date' THEN replace(p.value, ' ', '') ELSE p.value END AS value
        FROM event_property p JOIN clean_names c ON c.name = p.name
        LEFT JOIN typed_event e ON e.id = p.event_id
        LEFT JOIN property_event_schema d ON d.event_id = e.schema_id AND d.name = c.clean""",
    "conformance": """
        SELECT schema_id AS type_id, schema, bool_and(known) AS conforms
        FROM judged_property GROUP BY ALL""",
    "verdict": """
        SELECT e.id, e.schema, e.schema_id,
            CASE WHEN coalesce(bool_and(p.ok), true) THEN 'validated' ELSE 'unvalid' END AS valid
        FROM typed_event e LEFT JOIN judged_property p ON p.event_id = e.id
        WHERE e.migrated = false GROUP BY e.id, e.schema, e.schema_id""",
    "judged_event": """
        SELECT e.* REPLACE (coalesce(v.valid, e.valid) AS valid)
        FROM user_event e LEFT JOIN verdict v USING (id)""",
    "latest_cell": """
        SELECT p.event_id, c.clean, arg_max_null(p.value, p.id) AS value
        FROM event_property p JOIN clean_names c USING (name) GROUP BY ALL""",
    "scope_user": """
        SELECT id FROM user_company
        WHERE email IS NULL OR mobile_number IS NULL OR identification IS NULL""",
    "user_value": """
        SELECT user_id, name, count(*) AS n_rows, count(DISTINCT nullif(value, '')) AS n_values,
            max(nullif(value, '')) AS value
        FROM user_property GROUP BY user_id, name""",
    "outcome": """
        SELECT x.user_id, x.name, x.n_rows,
            CASE WHEN n_values > 1 THEN 'conflict' WHEN n_values = 0 THEN 'drop_empty'
                WHEN x.name NOT IN ('email', 'identification_type') THEN 'no_column'
                WHEN current = x.value THEN 'already_equal'
                WHEN current IS NULL THEN 'fill' ELSE 'overwrite' END AS action,
            CASE WHEN n_values = 1 AND x.name IN ('email', 'identification_type') THEN x.value
                ELSE current END AS new_value
        FROM (SELECT uv.*, CASE uv.name WHEN 'email' THEN u.email
                WHEN 'identification_type' THEN u.identification_type END AS current
            FROM user_value uv JOIN user_company u ON u.id = uv.user_id) x""",
}


def with_ctes(statement: str) -> str:
    """Put the common table expressions in front that the statement needs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(body)
                needed.append(name)

    visit(statement)
    listed = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    return f"WITH {listed}\n{statement}" if listed else statement


BASE = """CAST(e.id AS BIGINT) AS id, CAST(e.updated_at AS DATE) AS updated_at,
    CAST(e.created_at AS DATE) AS created_at, e.user_id, e.integration_id, e.integration_type, e.uuid"""


def new_id(registry: str, first: str, ties: str) -> str:
    """Numbers of new registry rows, dealt in 16 parts."""
    return f"""(SELECT max(id) + 1 FROM {registry}) + {first} % 16
            + 16 * (row_number() OVER (PARTITION BY {first} % 16 ORDER BY {first}, {ties}) - 1)"""


READERS = {
    "varchar": lambda x: x,
    "integer": read_integer,
    "numeric": lambda x: f"CAST({read_numeric(f'replace({x}, {quoted(",")}, {quoted(".")})')} AS DECIMAL(18,2))",
    "date": read_date,
}


def pivot_sql(event: str, where: str = "true") -> str:
    """Ready events of one type with the last value of each declared property."""
    cells = [
        READERS[kind](f"max(CASE WHEN c.clean = {quoted(name)} THEN c.value END)")
        + f" AS {name + '_prop' if name in ('id', 'id_prop') else name}"
        for name, _, kind in DECLARED[event]
    ]
    return f"""SELECT {BASE}, {", ".join(cells)}
        FROM judged_event e JOIN clean_names m ON m.name = e.name
        LEFT JOIN latest_cell c ON c.event_id = e.id
        WHERE m.clean = {quoted(event)} AND e.migrated = false AND e.valid = 'validated' AND {where}
        GROUP BY ALL"""


def clean_sql(change: str, event: str, pattern: str) -> str:
    return f"""SELECT p.id, p.name, p.event_id,
        CASE WHEN p.name LIKE {quoted(pattern)}
            AND p.event_id IN (SELECT id FROM user_event WHERE name = {quoted(event)})
            THEN {change} ELSE p.value END AS value FROM event_property p"""


def clean_user_sql(change: str, pattern: str, column: str = "value") -> str:
    other = "p.name" if column == "value" else "p.value"
    return f"""SELECT p.id, p.user_id, {other},
        CASE WHEN p.name LIKE {quoted(pattern)} AND p.user_id IN (SELECT id FROM scope_user)
            THEN {change} ELSE p.{column} END AS {column} FROM user_property p"""


FIRST_SPACE = """CASE WHEN instr(p.value, ' ') > 0 THEN substr(p.value, 1, instr(p.value, ' ') - 1)
    || substr(p.value, instr(p.value, ' ') + 1) ELSE p.value END"""
TO_INTEGER = f"coalesce(CAST(try_cast(round({read_numeric('p.value')}) AS INT) AS VARCHAR), p.value)"
REASON = f"""CASE WHEN type IS NULL THEN 'unregistered'
    WHEN value IS NULL AND type <> 'varchar' THEN 'null_value'
    WHEN type = 'date' THEN 'not_date'
    WHEN type = 'integer' AND NOT regexp_matches(value, {quoted(v.INTEGER_TEXT)}) THEN 'not_integer'
    WHEN type = 'numeric' AND NOT regexp_matches(replace(value, ',', '.'), {quoted(v.NUMERIC_TEXT)})
        THEN 'not_numeric' ELSE 'out_of_range' END"""
NEW_ROW = """2 AS db_status, 1 AS migrate_status, TIMESTAMP '2024-03-01' AS created_at,
    TIMESTAMP '2024-03-01' AS updated_at, true AS is_active"""
ACTIVE_CELLS = sorted(
    {name for event, columns in DECLARED.items() if event != "view" for name, _, _ in columns}
)
TYPED_CELLS: dict[tuple[str, str], list[str]] = {}
for _event, _columns in DECLARED.items():
    for _name, _, _kind in _columns if _event != "view" else ():
        TYPED_CELLS.setdefault((_name, _kind), []).append(_event)
WIDE_SCHEMA = """
    SELECT schema, CAST(row_number() OVER (PARTITION BY schema ORDER BY part, name) AS INT) AS position,
        CASE WHEN part = 0 AND name IN ('id', 'id_prop') THEN name || '_prop' WHEN part = 1 THEN substr(name, 2) ELSE name END AS column_name,
        data_type
    FROM (SELECT s.name AS schema, 0 AS part, d.name, d.type AS data_type
          FROM property_event_schema d JOIN event_schema s ON s.id = d.event_id
          UNION ALL
          SELECT s.name, 1, b.name, b.type FROM event_schema s JOIN (VALUES ('0id', 'bigint'),
            ('1updated_at', 'date'), ('2created_at', 'date'), ('3user_id', 'bigint'),
            ('4integration_id', 'bigint'), ('5integration_type', 'string'), ('6uuid', 'string')) AS b(name, type) ON true
          WHERE s.id IN (SELECT event_id FROM property_event_schema))"""
IDENTIFIED = "(email IS NOT NULL OR mobile_number IS NOT NULL OR identification IS NOT NULL)"
READY = """SELECT id, name, valid, migrated FROM judged_event
    WHERE migrated = false AND valid = 'validated'"""
LAST_NICKNAME = """SELECT user_id, arg_max(value, id) AS nickname FROM user_property
    WHERE name = 'nickname' AND value IS NOT NULL GROUP BY user_id"""

STATEMENTS = {
    "pivot_events": pivot_sql("purchase"),
    "pivot_documents": pivot_sql("documento_leido"),
    "pivot_orders": pivot_sql("pedido_f"),
    "pivot_ready_events": pivot_sql("purchase"),
    "pivot_all_schemas": f"""
        SELECT v.id, v.schema, v.valid, {", ".join(
            f"max(CASE WHEN c.clean = {quoted(name)} THEN c.value END) AS text_{name}"
            for name in ACTIVE_CELLS)}
        FROM verdict v LEFT JOIN latest_cell c ON c.event_id = v.id GROUP BY v.id, v.schema, v.valid""",
    "pivot_events_incremental": pivot_sql(
        "purchase", "NOT CAST(e.created_at AS DATE) < DATE '2024-01-16'"
    ),
    "misfit_cells": f"""
        SELECT event_id, clean AS property, value, {REASON} AS reason FROM (
            SELECT e.id AS event_id, c.clean, c.value, d.type,
                coalesce({text_accepted("c.value", "d.type")}, false) AS ok
            FROM typed_event e JOIN latest_cell c ON c.event_id = e.id
            JOIN property_event_schema d ON d.event_id = e.schema_id AND d.name = c.clean
            WHERE e.schema = 'purchase' AND e.migrated = false)
        WHERE NOT ok AND value IS NOT NULL""",
    "pipeline_all_schemas": f"""
        SELECT v.id, v.schema, {", ".join(
            f"CASE WHEN v.schema IN ({', '.join(map(quoted, owners))}) THEN "
            + READERS[kind](f"max(CASE WHEN c.clean = {quoted(name)} THEN c.value END)")
            + f" END AS {name}_{kind}"
            for (name, kind), owners in TYPED_CELLS.items())}
        FROM (
            SELECT e.id, e.schema FROM typed_event e LEFT JOIN cleaned_property p ON p.event_id = e.id
            WHERE e.migrated = false GROUP BY e.id, e.schema
            HAVING coalesce(bool_and(p.id IS NULL OR (p.type IS NOT NULL
                AND coalesce({text_accepted("p.value", "p.type")}, false))), true)) v
        LEFT JOIN (
            SELECT event_id, clean, arg_max_null(value, id) AS value FROM cleaned_property GROUP BY ALL) c
        ON c.event_id = v.id GROUP BY v.id, v.schema""",
    "mark_migrated": """
        SELECT id, name, valid, CASE WHEN migrated = false AND valid = 'validated' THEN true
            ELSE migrated END AS migrated FROM judged_event""",
    "event_flags": """
        SELECT id AS event_id, 'validated' AS valid,
            CASE WHEN created_at < TIMESTAMP '2024-01-16' THEN true ELSE migrated END AS migrated
        FROM user_event""",
    "validate_events": "SELECT id, schema, valid FROM verdict",
    "validate_events_gated": """
        SELECT id, schema, valid FROM verdict
        WHERE schema_id IN (SELECT type_id FROM conformance WHERE conforms)""",
    "schema_conformance": "SELECT * FROM conformance",
    "refused_properties": f"""
        SELECT event_id, schema, id AS property_id, name, value, {REASON} AS reason
        FROM judged_property WHERE migrated = false AND NOT ok""",
    "exact_numbers": f"""
        SELECT id, {EXACT_TEXT} AS exact,
            cents = 0 OR (e < 20 AND power + 16 + length(CAST(cents AS VARCHAR)) - length(d) >= 0) AS held
        FROM {SCALED}""",
    "exact_number_ranges": f"""
        SELECT name, count(*) AS n, max(text) FILTER (up = 1) AS least, max(text) FILTER (down = 1) AS greatest
        FROM (
            SELECT *, row_number() OVER (PARTITION BY name ORDER BY sign, sign * e, sign * m) AS up,
                row_number() OVER (PARTITION BY name ORDER BY sign DESC, sign * e DESC, sign * m DESC) AS down
            FROM (
                SELECT name, {EXACT_TEXT} AS text, e, CAST(rpad(d, 20, '0') AS HUGEINT) AS m,
                    CASE WHEN cents = 0 THEN 0 WHEN odd = 1 THEN -1 ELSE 1 END AS sign
                FROM {SCALED}))
        GROUP BY name""",
    "read_types": f"""
        SELECT id, {read_integer("value")} AS as_integer,
            CAST({read_numeric("replace(value, ',', '.')")} AS DECIMAL(18,2)) AS as_numeric,
            {read_date("value")} AS as_date,
            value AS as_varchar
        FROM event_property""",
    "normalize_names": f"""
        SELECT name, {identifier("name")} AS identifier, {comparison_key("name")} AS key
        FROM (SELECT name FROM user_event UNION SELECT name FROM event_property)""",
    "normalize_texts": f"""
        SELECT doc_id, {identifier("text")} AS identifier, {comparison_key("text")} AS key FROM documents""",
    "discover_event_schemas": f"""
        SELECT {new_id("event_schema", "min(e.id)", "c.clean")} AS id, c.clean AS name,
            min(e.name) AS help_name, CAST(NULL AS VARCHAR) AS description, {NEW_ROW}, false AS is_migrated
        FROM user_event e JOIN clean_names c USING (name)
        WHERE NOT EXISTS (SELECT 1 FROM event_schema s WHERE s.name = c.clean OR s.help_name = e.name)
        GROUP BY c.clean""",
    "discover_properties": f"""
        SELECT {new_id("property_event_schema", "first_id", "schema_id, help_name")} AS id, clean AS name,
            schema_id AS event_id, help_name, 'varchar' AS type, {NEW_ROW}, has_name OR first_id > first AS is_alias
        FROM (SELECT *, min(first_id) OVER (PARTITION BY schema_id, clean) AS first FROM (SELECT s.id AS schema_id, p.name AS help_name, c.clean, min(p.id) AS first_id,
                EXISTS (SELECT 1 FROM property_event_schema d WHERE d.event_id = s.id AND d.name = c.clean) AS has_name,
                EXISTS (SELECT 1 FROM property_event_schema d WHERE d.event_id = s.id AND d.help_name = p.name) AS has_spelling
            FROM event_property p JOIN user_event e ON e.id = p.event_id JOIN event_kind m ON m.name = e.name
            JOIN event_schema s ON s.id = m.schema_id JOIN clean_names c ON c.name = p.name
            GROUP BY s.id, p.name, c.clean))
        WHERE NOT (has_name AND has_spelling)""",
    "events_with_new_properties": """
        SELECT DISTINCT e.id FROM event_property p JOIN user_event e ON e.id = p.event_id
        JOIN event_kind m ON m.name = e.name JOIN event_schema s ON s.id = m.schema_id
        JOIN clean_names c ON c.name = p.name
        WHERE NOT EXISTS (SELECT 1 FROM property_event_schema d
            WHERE d.event_id = s.id AND d.name = c.clean AND d.help_name = p.name)""",
    "wide_table_schema": WIDE_SCHEMA,
    "missing_wide_columns": f"""
        SELECT column_name, data_type FROM ({WIDE_SCHEMA}) WHERE schema = 'purchase' AND column_name NOT IN
            (SELECT column_name FROM ({WIDE_SCHEMA}) WHERE schema = 'signup')""",
    "scan_pending_events": "SELECT * FROM user_event WHERE name = 'PURCHASE' AND migrated = false",
    "pending_events_batch": """
        SELECT * FROM user_event WHERE name = 'PURCHASE' AND migrated = false ORDER BY id LIMIT 200""",
    "filter_eq": "SELECT * FROM user_property WHERE name = 'nickname'",
    "filter_like": "SELECT * FROM event_property WHERE name LIKE '%A_O%'",
    "event_property_join": """
        SELECT p.*, e.name AS event_name FROM event_property p JOIN user_event e ON e.id = p.event_id""",
    "scan_event_props_like": """
        SELECT * FROM event_property WHERE name LIKE 'VALOR_TOTAL'
            AND event_id IN (SELECT id FROM user_event WHERE name = 'PURCHASE')""",
    "scan_user_props_incomplete": """
        SELECT * FROM user_property WHERE name LIKE 'CANTIDAD%' AND user_id IN (SELECT id FROM scope_user)""",
    "active_schemas": "SELECT * FROM event_schema WHERE db_status = 2",
    "schema_columns": """
        SELECT d.event_id, s.name AS schema, d.name AS property, d.type
        FROM property_event_schema d JOIN event_schema s ON s.id = d.event_id""",
    "pending_user_schema": """
        SELECT * FROM property_user_schema
        WHERE db_status = 'create_completed' AND migrate_status = 'migrate_pending'""",
    "identified_users": f"SELECT * FROM user_company WHERE {IDENTIFIED}",
    "identified_users_small_batch": f"SELECT * FROM user_company WHERE {IDENTIFIED} ORDER BY id LIMIT 50",
    "identified_users_batch": f"SELECT * FROM user_company WHERE {IDENTIFIED} ORDER BY id LIMIT 5000",
    "incomplete_users": "SELECT * FROM user_company WHERE id IN (SELECT id FROM scope_user)",
    "users_with_property": "SELECT DISTINCT user_id FROM user_property WHERE name = 'identification_type'",
    "distinct_event_names": "SELECT DISTINCT name FROM user_event",
    "observed_properties": """
        SELECT DISTINCT e.name AS event_name, p.name AS property_name
        FROM event_property p JOIN user_event e ON e.id = p.event_id""",
    "semi_event_ids": """
        SELECT * FROM event_property WHERE event_id IN (SELECT id FROM user_event WHERE name = 'PURCHASE')""",
    "semi_schema_properties": """
        SELECT * FROM property_event_schema
        WHERE event_id IN (SELECT id FROM event_schema WHERE name = 'purchase')""",
    "ready_events": READY,
    "ready_events_small_batch": f"{READY} ORDER BY id LIMIT 100",
    "ready_events_batch": f"{READY} ORDER BY id LIMIT 100000",
    "clean_remove_space": clean_sql("replace(p.value, ' ', '')", "PURCHASE", "Correo%"),
    "clean_remove_space_first": clean_sql(FIRST_SPACE, "PURCHASE", "Correo%"),
    "clean_remove_space_user": clean_user_sql("replace(p.value, ' ', '')", "CANTIDAD%"),
    "clean_comma_to_dot_user": clean_user_sql("replace(p.value, ',', '.')", "CANTIDAD%"),
    "clean_remove_dollar_user": clean_user_sql("replace(p.value, '$', '')", "CANTIDAD%"),
    "clean_remove_euro_user": clean_user_sql("replace(p.value, '€', '')", "CANTIDAD%"),
    "clean_replace_text_user": clean_user_sql("replace(p.value, 'example', 'correo')", "email"),
    "clean_comma_to_dot": clean_sql("replace(p.value, ',', '.')", "PURCHASE", "VALOR%"),
    "clean_remove_dollar": clean_sql("replace(p.value, '$', '')", "PURCHASE", "VALOR%"),
    "clean_remove_euro": clean_sql("replace(p.value, '€', '')", "PURCHASE", "VALOR%"),
    "clean_replace_text": clean_sql("replace(p.value, 'example', 'correo')", "PURCHASE", "Correo%"),
    "clean_cast_integer": clean_sql(TO_INTEGER, "PURCHASE", "VALOR%"),
    "clean_cast_integer_user": clean_user_sql(TO_INTEGER, "CANTIDAD%"),
    "clean_declared_values": "SELECT id, name, event_id, value FROM cleaned_property",
    "blank_property_value": clean_sql("NULL", "PURCHASE", "K"),
    "blank_user_property_value": clean_user_sql("NULL", "nick%"),
    "rename_user_property": clean_user_sql("'cantidad_cortesia'", "CANTIDAD%", "name"),
    "email_validity": f"""
        SELECT DISTINCT value, regexp_matches(value, {quoted(v.EMAIL_TEXT)}) AS is_email FROM event_property
        WHERE name LIKE 'Correo%' AND value IS NOT NULL
            AND event_id IN (SELECT id FROM user_event WHERE name = 'PURCHASE')""",
    "email_validity_texts": f"""
        SELECT DISTINCT text AS value, regexp_matches(text, {quoted(v.EMAIL_TEXT)}) AS is_email
        FROM documents WHERE text IS NOT NULL""",
    "email_validity_user": f"""
        SELECT DISTINCT value, regexp_matches(value, {quoted(v.EMAIL_TEXT)}) AS is_email
        FROM user_property WHERE value IS NOT NULL AND user_id IN (SELECT id FROM scope_user)""",
    "evolve_user_columns": "SELECT *, CAST(NULL AS DECIMAL(18,2)) AS cantidad_cortesia FROM user_company",
    "user_schema_status": """
        SELECT id, name, type, CASE db_status WHEN 'pending_create' THEN 'create_completed' ELSE db_status END AS db_status,
            CASE WHEN db_status = 'pending_create' OR migrate_status = 'migrate_pending'
                THEN 'migrate_completed' ELSE migrate_status END AS migrate_status
        FROM property_user_schema""",
    "promote_user_properties": f"""
        SELECT u.*, x.nickname FROM user_company u LEFT JOIN ({LAST_NICKNAME}) x ON x.user_id = u.id""",
    "remaining_user_props": """
        SELECT * FROM user_property WHERE NOT (name = 'nickname' AND value IS NOT NULL)
            OR user_id NOT IN (SELECT id FROM user_company)""",
    "consolidate_user_property": "SELECT user_id, name, action, new_value, n_rows FROM outcome",
    "consolidated_users": """
        SELECT u.* REPLACE (
            coalesce((SELECT new_value FROM outcome o WHERE o.user_id = u.id AND o.name = 'email'), u.email) AS email,
            coalesce((SELECT new_value FROM outcome o WHERE o.user_id = u.id AND o.name = 'identification_type'),
                u.identification_type) AS identification_type)
        FROM user_company u""",
    "unconsolidated_user_props": """
        SELECT p.* FROM user_property p JOIN outcome o USING (user_id, name)
        WHERE o.action IN ('conflict', 'no_column')""",
    "migrate_identified_users": f"""
        SELECT {", ".join(IDENTIFIED_COLUMNS)} FROM user_company
        WHERE {IDENTIFIED} AND coalesce(migrate, '') <> 'migrated' AND CAST(country AS INT) < 10""",
    "flag_migrated_users": f"""
        SELECT id, CASE WHEN {IDENTIFIED} THEN 'migrated' ELSE migrate END AS migrate FROM user_company""",
}

STATEMENTS |= {
    "observed_counts": """
        SELECT e.name AS event_name, p.name, count(*) AS n, min(p.id) AS first_property
        FROM event_property p JOIN user_event e ON e.id = p.event_id GROUP BY ALL""",
    "schema_conformance_kept": STATEMENTS["schema_conformance"],
    "validate_events_kept_gate": STATEMENTS["validate_events_gated"],
    "discover_properties_kept": STATEMENTS["discover_properties"],
    "seen_islands": """
        SELECT block, min(id) AS first, max(id) AS last
        FROM (
            SELECT id, id // 65536 AS block,
                sum(CASE WHEN id = before + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY id // 65536 ORDER BY id) AS island
            FROM (
                SELECT id, lag(id) OVER (PARTITION BY id // 65536 ORDER BY id) AS before
                FROM (SELECT DISTINCT id FROM event_property)
            )
        )
        GROUP BY block, island""",
    "unseen_properties": "SELECT * FROM event_property WHERE event_id % 3 <> 0",
    "wide_over_versions": STATEMENTS["pivot_events"],
    "clean_in_parts": STATEMENTS["clean_remove_dollar"],
    "rename_in_parts": STATEMENTS["rename_user_property"],
}


def statements() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in STATEMENTS.items()}
