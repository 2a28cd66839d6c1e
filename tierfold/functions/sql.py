"""The same functions under SQL names, as SQL-defined functions (no Python at run time)."""

from __future__ import annotations

from pyspark.sql import SparkSession

IDENTIFIER_TYPE = (
    "ARRAY<STRUCT<system: STRUCT<value: STRING>,"
    " type: STRUCT<coding: STRING, text: STRUCT<value: STRING>>,"
    " value: STRUCT<value: STRING>>>"
)

DEFINITIONS = {
    "identifier_concat": f"""(items {IDENTIFIER_TYPE}) RETURNS STRING RETURN
        coalesce(array_join(transform(items, item -> CASE
            WHEN item.system IS NOT NULL AND item.type.text IS NOT NULL
                 AND item.value IS NOT NULL
            THEN concat_ws('_', coalesce(item.system.value, 'null'),
                 coalesce(item.type.text.value, 'null'), coalesce(item.value.value, 'null'))
            WHEN item.value IS NOT NULL THEN coalesce(item.value.value, 'null')
            END), ','), '')""",
    "dob_to_date": "(ts TIMESTAMP_NTZ) RETURNS DATE RETURN CAST(ts AS DATE)",
    "int_array_to_string": """(items ARRAY<BIGINT>) RETURNS STRING RETURN
        coalesce(array_join(CAST(items AS ARRAY<STRING>), ','), '')""",
    "timestamp_repair": """(ts TIMESTAMP_NTZ) RETURNS TIMESTAMP_NTZ RETURN CASE
        WHEN CAST(extract(SECOND FROM ts) * 1000000 AS BIGINT) % 1000 = 0
             AND CAST(extract(SECOND FROM ts) * 1000000 AS BIGINT) % 10000 <> 0 THEN ts
        ELSE ts + make_dt_interval(0, 0, 0,
             CAST(0.136 - extract(SECOND FROM ts) % 1 AS DECIMAL(18, 6))) END""",
}


def register_sql_functions(spark: SparkSession) -> None:
    """Create all functions as temporary functions of this session."""
    for name, body in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body}")
