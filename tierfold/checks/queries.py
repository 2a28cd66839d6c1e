"""One query per operator and job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierfold import functions, sinks, sources
from tierfold.checks import fixtures
from tierfold.config import LakeConfig
from tierfold.operators import clean, columns, marts, merge
from tierfold.plans import jobs, sql
from tierfold.staging import qualified, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _flat_patient(raw: DataFrame) -> DataFrame:
    return raw.select(
        "_id",
        F.col("gender.value").alias("gender"),
        F.col("lowerCaseName.text.value").alias("name"),
        F.size("identifier").alias("identifiers"),
        "dateCreated",
        "lastUpdated",
    )


def _address_fields(df: DataFrame, column: str) -> DataFrame:
    first = F.col(column)[0]
    return df.select(
        "_id",
        first["city"]["value"].alias("city"),
        first["country"]["value"].alias("country"),
        *(
            first[name]["value"].alias(name)
            for name in ("postalCode", "state", "text", "useCode")
            if name in df.schema[column].dataType.elementType.names
        ),
    )


def _document_files(df: DataFrame, collection: str, document_format: str = "json") -> str:
    """Write documents as files of a collection and return the source root."""
    root = shared_folder(df.sparkSession, "documents")
    df.write.format(document_format).save(f"{root}/{collection}")
    return root


# Sources


@query
def scan_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fixtures.raw_patient(spark, sf_dir)
    root = _document_files(documents, "patient")
    return _flat_patient(
        sources.scan_collection(spark, "patient", "json", root, documents.schema)
    )


@query
def scan_layer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "raw.user")
    sinks.append_partitioned(columns.with_raw_partition(fixtures.raw_user(spark, sf_dir)), path)
    return sources.scan_layer(spark, path).drop("userGroups")


@query
def scan_parquet_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.scan_parquet(spark, qualified(spark, f"{sf_dir}/orders.parquet"))


@query
def table_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an existing table, and whether a path without a table gave none."""
    absent = sources.table_or_none(spark, shared_folder(spark, "absent")) is None
    present = sources.table_or_none(spark, f"{sf_dir}/customer.parquet")
    return present.select("c_custkey", "c_name", F.lit(absent).alias("other_is_absent"))


@query
def scan_json_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines from customers, every eleventh of them cut off before its end."""
    key = F.col("c_custkey")
    line = F.concat(
        F.lit('{"_id":'), key, F.lit(',"name":"'), F.col("c_name"),
        F.lit('","born":"'), F.expr("DATE'1950-01-01' + CAST(c_custkey % 20000 AS INT)"),
        F.lit('","seen":"2020-01-01T00:00:'), F.lpad((key % 60).cast("string"), 2, "0"),
        F.lit('.250Z"'), F.when(key % 11 != 0, "}").otherwise(""),
    )
    path = shared_folder(spark, "lines")
    fixtures.table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    schema = StructType.fromDDL("_id BIGINT, name STRING, born DATE, seen TIMESTAMP")
    return sources.scan_json(spark, path, schema).select(
        "_id", "name", "born", F.unix_millis("seen").alias("seen_ms"),
        F.col(sources.CORRUPT_COLUMN).alias("bad_line"),
    )


@query
def scan_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients that some user of type PATIENT refers to."""
    users = columns.only_patients(fixtures.raw_user(spark, sf_dir))
    patients = fixtures.raw_patient(spark, sf_dir)
    return _flat_patient(sources.scan_by_ids(patients, users.select("patientId")))


@query
def scan_by_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    patients = fixtures.raw_patient_with_address(spark, sf_dir)
    low, high = datetime(2020, 1, 10), datetime(2020, 3, 12)
    return _flat_patient(sources.scan_by_date_range(patients, low, high))


# Projections and filters


@query
def partition_date_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = columns.with_raw_partition(fixtures.raw_patient(spark, sf_dir))
    return rows.select("_id", "lastUpdated", "partitionDate")


@query
def partition_date_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = columns.with_clean_partition(fixtures.raw_patient(spark, sf_dir))
    return rows.select("_id", "dateCreated", "partitionDate")


@query
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = {
        name: path
        for name, path in clean.PATIENT_COLUMNS.items()
        if "." in path or name == "mongoId"
    }
    return clean.extract(fixtures.raw_patient(spark, sf_dir), nested)


@query
def clean_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_patient(fixtures.raw_patient(spark, sf_dir))


@query
def clean_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_user(fixtures.raw_user(spark, sf_dir))


@query
def rename_for_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.rename_secondary(clean_user(spark, sf_dir))


@query
def rename_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.rename_primary(clean_patient(spark, sf_dir))


@query
def copy_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = columns.copy_column(fixtures.raw_patient_with_address(spark, sf_dir))
    return _address_fields(rows, "address1")


@query
def conform_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = columns.conform_address(fixtures.raw_patient_with_address(spark, sf_dir))
    return _address_fields(rows, "address")


@query
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the remaining columns and values of some of them, of each patient."""
    rows = columns.drop_columns(fixtures.raw_patient_with_address(spark, sf_dir))
    return rows.select(
        "_id",
        F.lit(",".join(rows.columns)).alias("column_names"),
        F.col("gender.value").alias("gender"),
        "lastUpdated",
        "isAnonymous.value",
    )


@query
def filter_user_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = columns.only_patients(fixtures.raw_user(spark, sf_dir))
    return rows.select("_id", "userType", "patientId")


@query
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = columns.with_value(fixtures.raw_patient_with_address(spark, sf_dir))
    return _address_fields(rows, "address")


# Functions


@query
def identifier_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.raw_patient(spark, sf_dir)
    element = raw.schema["identifier"].dataType.elementType
    text = functions.identifier_concat(F.col("identifier"), element)
    return raw.select("_id", text.alias("identifier"))


@query
def dob_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.raw_user(spark, sf_dir)
    return raw.select("_id", functions.dob_to_date(F.col("dob")).alias("dob"))


@query
def int_array_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.raw_user(spark, sf_dir)
    text = functions.int_array_to_string(F.col("userGroups"))
    return raw.select("_id", text.alias("userGroups"))


@query
def timestamp_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.repair_input(spark, sf_dir)
    repaired = functions.timestamp_repair(F.col("t"))
    return events.select("event_id", "t", repaired.alias("repaired"))


@query
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same functions called from SQL."""
    functions.register_sql_functions(spark)
    fixtures.raw_patient(spark, sf_dir).createOrReplaceTempView("sql_patient")
    fixtures.raw_user(spark, sf_dir).createOrReplaceTempView("sql_user")
    return spark.sql(
        """SELECT p._id AS patient, u._id AS user,
                  identifier_concat(p.identifier) AS identifier,
                  dob_to_date(u.dob) AS dob,
                  int_array_to_string(u.userGroups) AS userGroups,
                  timestamp_repair(u.dateCreated) AS repaired
           FROM sql_patient p JOIN sql_user u ON p._id = u.patientId"""
    )


# Joins, aggregates, merge


@query
def patient_user_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.patient_user_join(clean_patient(spark, sf_dir), clean_user(spark, sf_dir))


@query
def user_activity_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.user_activity_agg(clean_user(spark, sf_dir))


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.row_count(clean_user(spark, sf_dir))


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.rekeyed(clean_patient(spark, sf_dir), 2)


def merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.rekeyed(clean_patient(spark, sf_dir), 3, shift_every=4)
    return rows.withColumn("patientName", F.upper("patientName"))


@query
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merged(merge_target(spark, sf_dir), merge_source(spark, sf_dir))


@query
def merge_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert carried out on a written table."""
    path = shared_folder(spark, "clean.patient")
    sinks.create_partitioned(merge_target(spark, sf_dir), path)
    merge.merge_into(spark, path, merge_source(spark, sf_dir))
    return sources.scan_layer(spark, path)


@query
def merge_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert again, interrupted once its new contents are noted: refused, then finished."""
    path = shared_folder(spark, "clean.patient")
    sinks.create_partitioned(merge_target(spark, sf_dir), path)
    merge.stage_merge(spark, path, merge_source(spark, sf_dir))
    try:
        sources.scan_layer(spark, path)
    except sources.OpenMerge:
        merge.finish_merge(spark, path)
    return sources.scan_layer(spark, path)


@query
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw documents ingested twice, the second time a day later: the newer row of each."""
    rows = columns.with_raw_partition(fixtures.raw_patient(spark, sf_dir))
    path = shared_folder(spark, "raw.patient")
    older = rows.withColumn("lastUpdated", F.col("lastUpdated") - F.expr("INTERVAL 1 DAY"))
    sinks.append_partitioned(columns.with_raw_partition(older), path)
    sinks.append_partitioned(rows, path)
    raw = sources.scan_layer(spark, path, schema=rows.schema)
    return _flat_patient_dated(columns.latest_per_key(raw, "_id", "lastUpdated"))


@query
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append, then merge, rows that have a column the table lacks."""
    path = shared_folder(spark, "clean.patient")
    sinks.append_partitioned(merge_target(spark, sf_dir).drop("maritalStatus"), path)
    sinks.append_partitioned(
        merge_target(spark, sf_dir)
        .withColumn("mongoId", -F.col("mongoId") - 1)
        .withColumn("tier", F.lit("appended")),
        path,
    )
    source = merge_source(spark, sf_dir).withColumn("origin", F.lit("merged"))
    merge.merge_into(spark, path, source)
    names = ("mongoId", "patientName", "maritalStatus", "tier", "origin", "partitionDate")
    return sources.scan_layer(spark, path).select(*names)


# Sinks


@query
def append_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends of the same rows."""
    path = shared_folder(spark, "raw.patient")
    rows = columns.with_raw_partition(fixtures.raw_patient(spark, sf_dir))
    sinks.append_partitioned(rows, path)
    sinks.append_partitioned(rows, path)
    return _flat_patient_dated(sources.scan_layer(spark, path))


def _flat_patient_dated(raw: DataFrame) -> DataFrame:
    return raw.select(
        "_id",
        F.col("gender.value").alias("gender"),
        F.col("lowerCaseName.text.value").alias("name"),
        F.size("identifier").alias("identifiers"),
        "lastUpdated",
        "partitionDate",
    )


@query
def create_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "clean.patient")
    sinks.create_partitioned(clean_patient(spark, sf_dir), path)
    return sources.scan_layer(spark, path)


@query
def append_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "patientJson")
    rows = columns.with_raw_partition(fixtures.raw_patient(spark, sf_dir))
    sinks.append_json(rows, path)
    return _flat_patient_dated(spark.read.schema(rows.schema).json(path))


@query
def mart_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart table written twice holds the second contents only."""
    mart = sinks.FileMart(shared_folder(spark, "mart"))
    mart.overwrite(clean_patient(spark, sf_dir), "patient")
    mart.overwrite(clean_user(spark, sf_dir), "patient")
    return spark.read.parquet(mart.path("patient"))


@query
def stale_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of the files that belong to a superseded copy of a table."""
    root = shared_folder(spark, "snapshots")
    rows = clean_patient(spark, sf_dir)
    sinks.create_partitioned(rows, f"{root}/old")
    sinks.create_partitioned(rows, f"{root}/new")
    report = sinks.stale_files(spark, root, f"{root}/new", older_than_hours=0)
    day = F.regexp_extract("path", r"/old/partitionDate=([0-9-]+)/", 1)
    return report.select(day.cast("date").alias("partitionDate")).distinct()


# SQL


@query
def sql_over_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.raw_patient(spark, sf_dir)
    return sql.sql_over_view(raw, "SELECT lastUpdated FROM patient", "patient")


@query
def sql_over_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _document_files(fixtures.raw_patient(spark, sf_dir), "patient", "parquet")
    picked = "_id, birthDate.value AS birthDate, maritalStatus.text.value AS maritalStatus"
    return sql.sql_over_path(spark, f"{root}/patient", picked)


# Jobs


def _lake(spark: SparkSession, sf_dir: str, *collections: str) -> tuple[LakeConfig, sinks.FileMart]:
    """A new lake whose sources hold the given collections, ingested into raw tables."""
    makers = {"patient": fixtures.raw_patient, "user": fixtures.raw_user}
    root = shared_folder(spark, "lake")
    config = LakeConfig(root=root, source_root=f"{root}/source", source_format="parquet")
    for name in collections:
        makers[name](spark, sf_dir).write.parquet(f"{config.source_root}/{name}")
        jobs.raw_ingest(spark, config, name)
    return config, sinks.FileMart(f"{root}/mart")


@query
def job_raw_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    config, _ = _lake(spark, sf_dir, "patient")
    return _flat_patient_dated(sources.scan_layer(spark, config.raw_path("patient")))


def _raw_schema(spark: SparkSession, sf_dir: str) -> StructType:
    return columns.with_raw_partition(fixtures.raw_patient(spark, sf_dir)).schema


@query
def job_raw_ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the default format, JSON; timestamps are typed."""
    root = shared_folder(spark, "lake")
    config = LakeConfig(root=root, source_root=f"{root}/source")
    fixtures.raw_patient(spark, sf_dir).write.json(f"{config.source_root}/patient")
    jobs.raw_ingest(spark, config, "patient")
    return _flat_patient_dated(sources.scan_layer(spark, config.raw_path("patient")))


def _patient_json(spark: SparkSession, documents: DataFrame, root: str, name: str) -> LakeConfig:
    """A lake at ``root`` whose next documents are JSON lines in which nulls are written."""
    config = LakeConfig(root=root, source_root=f"{root}/{name}")
    lines = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    documents.select(lines.alias("value")).write.text(f"{config.source_root}/patient")
    return config


@query
def job_raw_ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth line is cut short: raw rows of the others, and the text of these."""
    root = shared_folder(spark, "lake")
    config = LakeConfig(root=root, source_root=f"{root}/source")
    patients = fixtures.raw_patient(spark, sf_dir)
    line = F.to_json(F.struct("*"))
    cut = F.concat(F.lit('{"_id":'), F.col("_id"), F.lit(',"gender":'))
    lines = patients.select(F.when(F.col("_id") % 5 == 0, cut).otherwise(line).alias("value"))
    lines.write.text(f"{config.source_root}/patient")
    jobs.raw_ingest(spark, config, "patient", patients.schema)
    raw = sources.scan_layer(spark, config.raw_path("patient"))
    broken = spark.read.parquet(config.quarantine_path("patient"))
    rows = raw.select("_id", F.col("gender.value").alias("gender"), F.lit(None).alias("document"))
    return rows.union(broken.select(F.lit(None), F.lit(None), "document"))


@query
def job_raw_ingest_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch of JSON has no gender in any document, and a field more."""
    patients = fixtures.raw_patient(spark, sf_dir)
    root = shared_folder(spark, "lake")
    even, odd = patients.where("_id % 2 = 0"), patients.where("_id % 2 = 1")
    odd = odd.withColumn("gender", F.lit(None).cast("string")).withColumn("ward", F.col("_id") % 3)
    for name, documents in (("first", even), ("second", odd)):
        jobs.raw_ingest(spark, _patient_json(spark, documents, root, name), "patient")
    raw = sources.scan_layer(spark, f"{root}/raw.patient")
    flat = _flat_patient_dated(raw.drop("ward"))
    return flat.join(raw.select("_id", "ward", "ingestBatch"), "_id")


@query
def job_clean_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingests cleaned one by one; the later ones bring documents of older dates and changes."""
    root = shared_folder(spark, "lake")
    patients = fixtures.raw_patient(spark, sf_dir)
    changed = F.struct(F.concat("gender.value", F.lit("*")).alias("value"))
    rounds = (
        patients.where("_id % 3 = 0").withColumn("gender", changed),
        patients.where("_id % 3 <> 2 AND dateCreated < '2020-02-01'"),
        patients.where("_id % 3 <> 2 AND dateCreated >= '2020-02-01'"),
        patients.where("_id % 3 = 2"),
    )
    for k, documents in enumerate(rounds):
        config = LakeConfig(root=root, source_root=f"{root}/{k}", source_format="parquet")
        documents.write.parquet(f"{config.source_root}/patient")
        jobs.raw_ingest(spark, config, "patient")
        if k != 1:  # two ingests are cleaned in one go
            jobs.clean_load(spark, config, "patient", incremental=True)
    return sources.scan_layer(spark, config.clean_path("patient"))


@query
def job_clean_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingests: even ids, then all with another gender, so the second run updates and adds."""
    root = shared_folder(spark, "lake")
    patients = fixtures.raw_patient(spark, sf_dir)
    changed = F.struct(F.concat("gender.value", F.lit("*")).alias("value"))
    first = patients.where("_id % 2 = 0").withColumn("gender", changed)
    for name, documents in (("first", first), ("second", patients)):
        config = LakeConfig(root=root, source_root=f"{root}/{name}", source_format="parquet")
        documents.withColumn(
            "lastUpdated", F.col("lastUpdated") - F.expr(f"INTERVAL {int(name == 'first')} DAY")
        ).write.parquet(f"{config.source_root}/patient")
        jobs.raw_ingest(spark, config, "patient")
        jobs.clean_load(
            spark, config, "patient", _raw_schema(spark, sf_dir), latest=True, extra_columns=False
        )
    return sources.scan_layer(spark, config.clean_path("patient"))


@query
def job_clean_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only raw rows ingested from a day on are read and cleaned."""
    config, _ = _lake(spark, sf_dir, "patient")
    schema = _raw_schema(spark, sf_dir)
    jobs.clean_load(spark, config, "patient", schema, since=date(2020, 2, 1))
    return sources.scan_layer(spark, config.clean_path("patient"))


@query
def job_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in the paths of all files below the lake that no table of it needs."""
    config, mart = _lake(spark, sf_dir, "patient", "user")
    config = replace(config, retention_hours=0, mart_root=mart.root)
    jobs.clean_load(spark, config, "patient")
    jobs.mart_load(spark, config, mart, "patient")
    raw = sources.scan_layer(spark, config.raw_path("patient"))
    sinks.create_partitioned(raw, f"{config.root}/backup/raw.patient")
    jobs.raw_ingest(spark, config, "patient")  # the live tables go on
    report = jobs.retention(spark, config, "patient", config.root)
    day = F.regexp_extract("path", r"/partitionDate=([0-9-]+)/", 1)
    return report.select(day.cast("date").alias("partitionDate")).distinct()


@query
def job_retention_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after all that is stale below the lake, and nothing else, has been deleted."""
    config, mart = _lake(spark, sf_dir, "patient")
    config = replace(config, retention_hours=0, mart_root=mart.root)
    jobs.clean_load(spark, config, "patient")
    sinks.create_partitioned(clean_patient(spark, sf_dir), f"{config.root}/old/clean.patient")
    jobs.remove_stale(spark, config, config.root)
    jobs.mart_load(spark, config, mart, "patient")
    if sources.has_data(spark, f"{config.root}/old/clean.patient"):
        return spark.read.parquet(f"{config.root}/old/clean.patient").limit(0)
    return spark.read.parquet(mart.path("patient"))


@query
def job_clean_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    config, _ = _lake(spark, sf_dir, "user")
    jobs.clean_load(spark, config, "user")
    return sources.scan_layer(spark, config.clean_path("user"))


@query
def job_mart_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    config, mart = _lake(spark, sf_dir, "patient")
    jobs.clean_load(spark, config, "patient")
    jobs.mart_load(spark, config, mart, "patient")
    return spark.read.parquet(mart.path("patient"))


@query
def job_mart_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ingested twice, so every patient is there twice."""
    config, mart = _lake(spark, sf_dir, "patient")
    jobs.raw_ingest(spark, config, "patient")
    jobs.mart_load_from_raw(spark, config, mart, "patient")
    return spark.read.parquet(mart.path("patient"))


def _joined_mart(spark: SparkSession, sf_dir: str) -> sinks.FileMart:
    config, mart = _lake(spark, sf_dir, "patient", "user")
    jobs.clean_load(spark, config, "patient")
    jobs.clean_load(spark, config, "user")
    jobs.joined_mart_load(spark, config, mart)
    return mart


@query
def job_patient_user_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_joined_mart(spark, sf_dir).path("patient_user"))


@query
def job_activity_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_joined_mart(spark, sf_dir).path("patient_aggData"))


@query
def job_document_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "lake")
    documents = fixtures.raw_patient_with_address(spark, sf_dir)
    config = LakeConfig(root=root, source_root=f"{root}/source", source_format="parquet")
    documents.write.parquet(f"{config.source_root}/patient")
    jobs.document_copy(spark, config, f"{root}/patientJson", as_json=True)
    schema = columns.copy_column(columns.with_raw_partition(documents)).schema
    return _address_fields(spark.read.schema(schema).json(f"{root}/patientJson"), "address1")


@query
def job_object_store_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _document_files(fixtures.raw_patient(spark, sf_dir), "patient.parquet", "parquet")
    return _flat_patient_dated(jobs.object_store_rows(spark, f"{root}/patient.parquet"))


@query
def job_patient_mart_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    config, mart = _lake(spark, sf_dir, "patient")
    jobs.patient_mart_direct(spark, config, mart)
    return spark.read.parquet(mart.path("patient"))

