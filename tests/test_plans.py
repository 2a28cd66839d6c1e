"""What Spark makes of the queries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tierfold.checks import fixtures, queries
from tierfold.operators import clean, marts, merge
from tierfold.operators.columns import with_raw_partition
from tierfold.sinks import append_partitioned
from tierfold.sources import scan_by_ids, scan_layer

LAZY = (
    "clean_patient", "clean_user", "conform_nested", "copy_column", "dob_to_date",
    "filter_not_null", "filter_user_type", "flatten_nested", "identifier_concat",
    "int_array_to_string", "merge_upsert", "patient_user_join", "scan_by_date_range",
    "scan_by_ids", "sql_functions", "timestamp_repair", "user_activity_agg",
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_joins(spark, sf_dir, name):
    text = plan(entry_module.queries()[name](spark, sf_dir))
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert node not in text


@pytest.fixture(scope="module")
def raw_path(spark, sf_dir, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('plans')}/raw.patient"
    append_partitioned(with_raw_partition(fixtures.raw_patient_with_address(spark, sf_dir)), path)
    return path


def test_clean_step_reads_only_needed_nested_fields(spark, raw_path):
    text = plan(clean.clean_patient(scan_layer(spark, raw_path)))
    schema = text.split("ReadSchema: ")[1]
    assert "gender:struct<value:string>" in schema
    for unread in ("address", "extension", "isAnonymous"):
        assert unread not in schema
    assert "Exchange" not in text


def test_filters_reach_the_scan(spark, sf_dir, raw_path, tmp_path):
    path = f"{tmp_path}/user"
    fixtures.raw_user(spark, sf_dir).write.parquet(path)
    users = clean.clean_user(scan_layer(spark, path))
    assert "EqualTo(userType,PATIENT)" in plan(users)
    assert "In(_id, [4,7])" in plan(scan_by_ids(scan_layer(spark, raw_path), [4, 7]))
    dated = scan_layer(spark, raw_path).where("partitionDate = DATE'2020-01-05'")
    filters = plan(dated).split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "partitionDate" in filters


def test_counts_are_partial_before_the_shuffle(spark, sf_dir):
    text = plan(queries.user_activity_agg(spark, sf_dir))
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "partial_count" in below and "partial_count" not in above


def test_rewrite_prunes_to_the_touched_dates(spark, sf_dir, tmp_path):
    path = f"{tmp_path}/t"
    append_partitioned(queries.merge_target(spark, sf_dir), path)
    target = scan_layer(spark, path)
    actions = target.where("partitionDate = DATE'2020-01-05'")
    with merge._dates(actions, "partitionDate") as dates:
        touched = merge._on_dates(target, dates, "partitionDate")
        assert touched.count() == actions.count() > 0
        touched.collect()
        plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "dynamicpruningexpression(true)" not in plan


def test_target_keys_are_read_without_other_columns(spark, sf_dir, tmp_path):
    path = f"{tmp_path}/t"
    append_partitioned(queries.merge_target(spark, sf_dir), path)
    classified = merge._classified(
        scan_layer(spark, path), queries.merge_source(spark, sf_dir), "mongoId", "partitionDate"
    )
    scans = [line for line in plan(classified).split("\n") if "FileScan" in line and "/t]" in line]
    assert len(scans) == 1
    assert scans[0].split("ReadSchema: ")[1].startswith("struct<mongoId:bigint>")


@pytest.fixture
def small_splits(spark):
    """No broadcasts, and skew handling from 100 KB on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def keyed(spark, key, hot):
    """60,000 rows, a third of them with the key ``hot``."""
    return spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id")).cast("bigint").alias(key),
        F.sha2(F.col("id").cast("string"), 256).alias("email"),
        F.lit("2020-01-01").cast("date").alias("partitionDate"),
    )


def test_hot_patient_is_split_in_the_join(spark, small_splits):
    patients = spark.range(60_000).select(
        F.col("id").alias("mongoId"), F.lit("p").alias("patientName")
    )
    joined = marts.join_renamed(patients, keyed(spark, "patientId", 7))
    assert len(joined.collect()) == 60_000
    assert "skew=true" in plan(joined)


@pytest.mark.parametrize("hot", [7, None])
def test_hot_target_key_is_split_in_the_merge(spark, small_splits, hot):
    target = keyed(spark, "mongoId", hot)
    source = keyed(spark, "mongoId", None).where("mongoId IS NOT NULL")
    changed = merge._updated(target, source, "mongoId", "partitionDate")
    assert len(changed.collect()) == 60_000
    assert "skew=true" in plan(changed)


def test_null_source_keys_are_split_in_the_merge(spark, small_splits):
    target = keyed(spark, "mongoId", 7)
    classified = merge._classified(
        target, keyed(spark, "mongoId", None), "mongoId", "partitionDate"
    )
    assert len(classified.collect()) == 60_000
    assert "skew=true" in plan(classified)
