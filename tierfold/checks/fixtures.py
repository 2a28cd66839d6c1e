"""Nested patient and user documents derived from the supplied test tables.

Only expressions over whole tables, so the documents grow with the tables and the same
rows can be derived in plain SQL. Timestamps are without zone, as in the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DAY_ZERO = "TIMESTAMP_NTZ '2020-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _days_after(start: str, days: str) -> str:
    return f"{start} + make_dt_interval(CAST({days} AS INT))"


def _wrap(value: str) -> str:
    return f"named_struct('value', {value})"


def _identifier(system: str, kind: str, value: str) -> str:
    return f"""named_struct('system', {_wrap(system)},
        'type', named_struct('coding', 'code', 'text', {_wrap(kind)}), 'value', {_wrap(value)})"""


def _array_or_gap(key: str, null_every: int, empty_every: int, items: str) -> str:
    return f"""CASE WHEN {key} % {null_every} = 0 THEN NULL
        WHEN {key} % {empty_every} = 0 THEN slice({items}, 1, 0) ELSE {items} END"""


FIRST_IDENTIFIER = _identifier("'cust'", "c_mktsegment", "c_name")
SECOND_IDENTIFIER = _identifier(
    "CASE WHEN c_custkey % 5 <> 0 THEN 'nat' END", "'N'", "CAST(c_nationkey AS STRING)"
)
PATIENT = {
    "_id": "c_custkey",
    "gender": _wrap("CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END"),
    "identifier": _array_or_gap(
        "c_custkey", 7, 11, f"array({FIRST_IDENTIFIER}, {SECOND_IDENTIFIER})"
    ),
    "dateCreated": _days_after(DAY_ZERO, "c_custkey % 90"),
    "active": _wrap("c_acctbal > 0"),
    "birthDate": _wrap(
        _days_after("TIMESTAMP_NTZ '1950-01-01 13:45:00'", "c_custkey % 20000")
    ),
    "lowerCaseName": f"named_struct('text', {_wrap('lower(c_name)')})",
    "maritalStatus": f"named_struct('text', {_wrap('c_mktsegment')})",
    "lastUpdated": _days_after(DAY_ZERO, "c_custkey % 90 + c_custkey % 13"),
}
ADDRESS = {
    "address": f"""CASE WHEN c_custkey % 8 <> 0 THEN
        array(named_struct('city', {_wrap("c_name")}, 'country', {_wrap("n_name")})) END""",
    "isAnonymous": _wrap("c_custkey % 10 = 0"),
    "extension": "'ext'",
}
USER = {
    "_id": "o_orderkey",
    "email": "concat('u', o_orderkey, '@example.org')",
    "enabled": "o_totalprice > 100000",
    "firstName": "concat('F', o_custkey)",
    "lastName": "concat('L', o_orderkey)",
    "phoneNo": "CAST(o_orderkey AS STRING)",
    "userType": "CASE WHEN o_orderstatus = 'F' THEN 'PATIENT' ELSE 'STAFF' END",
    "dateCreated": "o_orderdate",
    "lastLoginTimeStamp": _days_after("o_orderdate", "o_orderkey % 30"),
    "patientId": "o_custkey",
    "dob": _days_after("TIMESTAMP_NTZ '1960-06-01 08:00:00'", "o_orderkey % 9000"),
    "gender": "CASE WHEN o_orderkey % 2 = 0 THEN 'female' ELSE 'male' END",
    "countryCode": "'91'",
    "userGroups": _array_or_gap("o_orderkey", 9, 10, "array(o_orderkey % 5, o_custkey % 7)"),
    "lastUpdated": "o_orderdate",
}


def _derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{expression} AS {name}" for name, expression in columns.items()))


def raw_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients from ``customer``, without addresses."""
    return _derive(table(spark, sf_dir, "customer"), PATIENT)


def raw_patient_with_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients with one address each, of which only city and country are filled in.

    The address is null for every eighth patient. The country comes from ``nation``.
    """
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    joined = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    return _derive(joined, {**PATIENT, **ADDRESS})


def raw_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users from ``orders``; about a third of them are patients."""
    return _derive(table(spark, sf_dir, "orders"), USER)


def rekeyed(clean: DataFrame, factor: int, shift_every: int | None = None) -> DataFrame:
    """Clean rows under keys ``mongoId * factor``, dated by the new key.

    Two such tables with coprime factors share the common multiples of the factors. With
    ``shift_every`` the rows under multiples of it are dated one day later.
    """
    key = f"mongoId * {factor}"
    days = f"({key}) % 30"
    if shift_every is not None:
        days += f" + IF(({key}) % {shift_every} = 0, 1, 0)"
    created = _days_after(DAY_ZERO, days)
    changed = {
        "mongoId": key,
        "dateCreated": created,
        "partitionDate": f"CAST({created} AS DATE)",
    }
    return _derive(clean, {name: changed.get(name, name) for name in clean.columns})


def repair_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times, every second one cut to milliseconds taken from the event id."""
    cut = """make_dt_interval(0, 0, 0,
        CAST(event_id % 1000 / 1000 - extract(SECOND FROM ts) % 1 AS DECIMAL(18, 6)))"""
    return _derive(
        table(spark, sf_dir, "events"),
        {"event_id": "event_id", "t": f"IF(event_id % 2 = 0, ts, ts + {cut})"},
    )
