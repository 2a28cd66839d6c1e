from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierfold.functions import (
    dob_to_date,
    identifier_concat,
    int_array_to_string,
    register_sql_functions,
    timestamp_repair,
)
from tierfold.functions.sql import IDENTIFIER_TYPE

FULL = f"id INT, items {IDENTIFIER_TYPE}"


def item(system, kind, value):
    """Identifier with None for an absent struct, ('text',) for a present one."""
    return (
        system and (system[0],),
        ("code", kind and (kind[0],)),
        value and (value[0],),
    )


CASES = [
    ([item(("s",), ("t",), ("v",)), item(("s2",), ("t2",), ("v2",))], "s_t_v,s2_t2_v2"),
    (None, ""),
    ([], ""),
    ([item((None,), ("t",), ("v",))], "null_t_v"),
    ([item(("s",), ("t",), (None,))], "s_t_null"),
    ([item(("",), ("t",), ("",))], "_t_"),
    ([item(None, ("t",), ("v",))], "v"),
    ([item(("s",), None, ("v",))], "v"),
    ([(("s",), None, ("v",))], "v"),
    ([item(("s",), ("t",), None)], ""),
    ([None], ""),
    ([None, item(("s",), ("t",), ("v",)), item(("s",), ("t",), None)], "s_t_v"),
]


def test_identifier_cases(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], FULL)
    element = df.schema["items"].dataType.elementType
    register_sql_functions(spark)
    rows = df.select(
        "id",
        identifier_concat(F.col("items"), element).alias("x"),
        F.expr("identifier_concat(items)").alias("y"),
    ).collect()
    for row in rows:
        assert row["x"] == CASES[row["id"]][1], CASES[row["id"]]
        assert row["y"] == row["x"]


@pytest.mark.parametrize(
    ("element", "items", "expected"),
    [
        ("value STRUCT<value: STRING>", [(("v",),), ((None,),), (None,)], "v,null"),
        ("system STRUCT<value: STRING>, value STRUCT<value: STRING>", [(("s",), ("v",))], "v"),
        ("system STRUCT<value: STRING>", [(("s",),)], ""),
    ],
)
def test_identifier_without_some_fields(spark, element, items, expected):
    kind = StructType.fromDDL(element)
    schema = StructType.fromDDL(f"items ARRAY<{kind.simpleString()}>")
    df = spark.createDataFrame([(items,)], schema)
    assert df.select(identifier_concat(F.col("items"), kind)).first()[0] == expected


def test_int_array(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,), ([-7],)], "a ARRAY<BIGINT>")
    found = [r[0] for r in df.select(int_array_to_string(F.col("a"))).collect()]
    assert found == ["1,2", "", "", "-7"]


def test_dob(spark):
    df = spark.createDataFrame([(datetime(1950, 1, 1, 23, 59),), (None,)], "t TIMESTAMP")
    found = [r[0] for r in df.select(dob_to_date(F.col("t"))).collect()]
    assert found == [date(1950, 1, 1), None]


@pytest.mark.parametrize("kind", ["TIMESTAMP", "TIMESTAMP_NTZ"])
def test_timestamp_repair(spark, kind):
    base = datetime(2020, 3, 29, 1, 30, 59)
    fractions = [123_000, 120_000, 0, 123_456, 100_000, 1_000, 999_999]
    df = spark.createDataFrame([(base.replace(microsecond=f),) for f in fractions], f"t {kind}")
    df = df.union(spark.createDataFrame([(None,)], f"t {kind}"))
    repaired = df.select(timestamp_repair(F.col("t")).alias("r"))
    assert repaired.schema["r"].dataType == df.schema["t"].dataType
    found = [r[0] and r[0].microsecond for r in repaired.collect()]
    assert found == [123_000, 136_000, 136_000, 136_000, 136_000, 1_000, 136_000, None]


def test_timestamp_repair_does_not_depend_on_the_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.sql("SELECT timestamp_ntz'2020-03-29 02:30:00.5' AS t")
        found = df.select(timestamp_repair(F.col("t")).cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == "2020-03-29 02:30:00.136"


def test_sql_functions_equal_the_columns(spark):
    from tierfold.functions import dob_to_date, int_array_to_string, timestamp_repair

    register_sql_functions(spark)
    rows = [
        ("2020-01-02 03:04:05.123", [1, 2]), ("2020-01-02 03:04:05.120", []),
        ("2020-01-02 03:04:05", None), ("2020-01-02 03:04:05.123456", [None, 3]), (None, [7]),
    ]
    df = spark.createDataFrame(rows, "t STRING, items ARRAY<BIGINT>")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    pairs = {
        "dob_to_date(t)": dob_to_date(F.col("t")),
        "int_array_to_string(items)": int_array_to_string(F.col("items")),
        "timestamp_repair(t)": timestamp_repair(F.col("t")),
    }
    for text, column in pairs.items():
        for row in df.select(F.expr(text).alias("x"), column.alias("y")).collect():
            assert row["x"] == row["y"], text
