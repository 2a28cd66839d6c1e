from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierfold import staging
from tierfold.checks import fixtures
from tierfold.operators.columns import conform_address, only_patients, with_raw_partition
from tierfold.sinks import (
    FileMart,
    JdbcMart,
    append_json,
    append_partitioned,
    create_partitioned,
    delete_stale,
    mart_from_config,
    stale_files,
)
from tierfold.sinks.marts import RowsMissing
from tierfold.config import LakeConfig
from tierfold.sinks.retention import stale_trees
from tierfold.sources import (
    CORRUPT_COLUMN,
    scan_by_date_range,
    scan_by_ids,
    scan_collection,
    scan_json,
    scan_layer,
    table_or_none,
)


def test_absent_and_empty_tables_are_none(spark, tmp_path):
    assert table_or_none(spark, f"{tmp_path}/absent") is None
    (tmp_path / "empty").mkdir()
    assert table_or_none(spark, f"{tmp_path}/empty") is None


def test_other_read_errors_are_raised(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)no_such_format"):
        table_or_none(spark, str(tmp_path), "no_such_format")


def test_bad_json_line(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text('{"_id":1,"d":"2020-02-01","t":"2020-02-01T03:04:05.5Z"}\n{"_id":2\n')
    schema = StructType.fromDDL("_id BIGINT, d DATE, t TIMESTAMP")
    found = {tuple(r) for r in scan_json(spark, str(path), schema).collect()}
    bad = (None, None, None, '{"_id":2')
    assert bad in found
    assert {r[0:2] for r in found - {bad}} == {(1, date(2020, 2, 1))}


def test_collection_schema_is_inferred_or_given(spark, tmp_path):
    (tmp_path / "patient").mkdir()
    (tmp_path / "patient" / "a.json").write_text('{"_id":1,"x":{"value":"a"}}\n{"_id":\n')
    inferred = scan_collection(spark, "patient", root=str(tmp_path))
    assert inferred.columns == [CORRUPT_COLUMN, "_id", "x"]
    assert inferred.count() == 2
    given = scan_collection(
        spark, "patient", root=str(tmp_path), schema=StructType.fromDDL("_id BIGINT")
    )
    assert sorted(given.collect(), key=repr)[0][0] == 1


def test_collection_file_format_needs_a_root(spark):
    with pytest.raises(ValueError, match="root"):
        scan_collection(spark, "patient")


def test_ids_as_list_or_frame(spark):
    documents = spark.range(100).withColumnRenamed("id", "_id")
    assert [r[0] for r in scan_by_ids(documents, [4, 7, 1000]).collect()] == [4, 7]
    ids = spark.createDataFrame([(4,), (4,), (7,), (None,)], "x BIGINT")
    assert sorted(r[0] for r in scan_by_ids(documents, ids).collect()) == [4, 7]


def test_date_range_excludes_both_ends_and_anonymous(spark):
    day = lambda d: datetime(2020, 3, d)
    data = [
        (4, day(14), (False,)),
        (3, day(12), (False,)),
        (2, day(13), (False,)),
        (1, day(13), (True,)),
        (0, day(13), (None,)),
        (5, day(15), (False,)),
    ]
    documents = spark.createDataFrame(
        data, "_id BIGINT, lastUpdated TIMESTAMP, isAnonymous STRUCT<value: BOOLEAN>"
    )
    found = scan_by_date_range(documents, day(12), day(15)).collect()
    assert [r[0] for r in found] == [2, 4]


def test_date_range_without_zone_ignores_the_session_zone(spark):
    documents = spark.createDataFrame(
        [(1, datetime(2020, 3, 12, 0, 0, 1), (False,))],
        "_id BIGINT, lastUpdated TIMESTAMP_NTZ, isAnonymous STRUCT<value: BOOLEAN>",
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = scan_by_date_range(documents, datetime(2020, 3, 12), datetime(2020, 3, 13)).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == 1


def test_sort_spreads_copies_of_one_key(spark):
    copies = spark.range(0, 60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("_id"),
        F.lit(datetime(2020, 3, 13)).alias("lastUpdated"),
        F.struct(F.lit(False).alias("value")).alias("isAnonymous"),
    )
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        result = scan_by_date_range(copies, datetime(2020, 3, 12), datetime(2020, 3, 15))
        assert result.columns == copies.columns
        placed = result.select("_id", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set(key, before)
    ids = [r["_id"] for r in placed]
    assert len(ids) == 60_000 and ids == sorted(ids)
    assert len({r["p"] for r in placed if r["_id"] == 7}) > 1


def test_null_user_type_is_dropped(spark):
    users = spark.createDataFrame([("PATIENT",), (None,), ("STAFF",)], "userType STRING")
    assert only_patients(users).count() == 1


def test_conform_keeps_nulls_and_order(spark):
    value = "STRUCT<value: STRING>"
    schema = f"address ARRAY<STRUCT<country: {value}, other: INT, line: ARRAY<{value}>>>"
    data = [([(("IN",), 1, [("x",), None]), None],), (None,), ([(None, 2, None)],)]
    found = [r[0] for r in conform_address(spark.createDataFrame(data, schema)).collect()]
    first = found[0][0]
    assert first.asDict()["country"]["value"] == "IN"
    names = ["city", "country", "line", "postalCode", "state", "text", "useCode"]
    assert list(first.asDict()) == names
    assert first["line"][0]["value"] == "x" and first["line"][1] is None and first["city"] is None
    assert found[0][1] is None and found[1] is None
    assert found[2][0]["country"] is None


def test_create_fails_on_an_existing_table(spark, tmp_path):
    rows = spark.createDataFrame([(1, date(2020, 1, 1))], "a INT, partitionDate DATE")
    assert create_partitioned(rows, f"{tmp_path}/t") == 1
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        create_partitioned(rows, f"{tmp_path}/t")


def test_null_dates_and_new_columns_survive_appends(spark, tmp_path):
    path = f"{tmp_path}/t"
    append_partitioned(spark.createDataFrame([(1, None)], "a INT, partitionDate DATE"), path)
    assert scan_layer(spark, path).schema["partitionDate"].dataType.simpleString() == "date"
    rows = [(2, "x", date(2020, 1, 1))]
    append_partitioned(spark.createDataFrame(rows, "a INT, b STRING, partitionDate DATE"), path)
    found = scan_layer(spark, path).select("a", "b", "partitionDate").orderBy("a").collect()
    assert [tuple(r) for r in found] == [(1, None, None), (2, "x", date(2020, 1, 1))]


def test_hot_date_is_split_and_whole(spark, tmp_path):
    """Two thirds of the rows on one date: several files for it, one for most others."""
    hot = F.when(F.col("id") % 3 == 0, (F.col("id") % 90).cast("int")).otherwise(100)
    rows = (
        spark.range(0, 300_000, numPartitions=12)
        .withColumn("noise", F.sha2(F.col("id").cast("string"), 256))
        .withColumn("partitionDate", F.date_add(F.lit("2020-01-01").cast("date"), hot))
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        assert append_partitioned(rows, f"{tmp_path}/t", partitions=64) == 300_000
    finally:
        spark.conf.set(key, before)
    table = scan_layer(spark, f"{tmp_path}/t")
    files = dict(
        tuple(r)
        for r in table.select("partitionDate", F.col("_metadata.file_path").alias("f"))
        .groupBy("partitionDate")
        .agg(F.count_distinct("f"))
        .collect()
    )
    assert files.pop(date(2020, 4, 10)) > 3
    assert sorted(files.values())[len(files) // 2] == 1
    assert table.select("id").distinct().count() == table.count() == 300_000


def test_writer_leaves_settings_alone(spark, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key)
    rows = spark.createDataFrame([(1, date(2020, 1, 1))], "a INT, partitionDate DATE")
    append_json(rows, f"{tmp_path}/t", partitions=3)
    assert spark.conf.get(key) == before


def test_file_mart_overwrites(spark, tmp_path):
    mart = FileMart(str(tmp_path))
    assert mart.overwrite(spark.range(5), "t") == 5
    assert mart.overwrite(spark.range(3), "t") == 3
    assert spark.read.parquet(mart.path("t")).count() == 3


class Gone(RuntimeError):
    pass


def test_a_failed_overwrite_leaves_the_table_readable(spark, tmp_path, monkeypatch):
    mart = FileMart(str(tmp_path))
    mart.overwrite(spark.range(5), "t")
    failing = spark.range(3).select(F.raise_error(F.lit("no")).alias("id"))
    for overwrite in (mart.overwrite, mart.overwrite_if_any):
        with pytest.raises(Exception, match="no"):
            overwrite(failing, "t")
    assert spark.read.parquet(mart.path("t")).count() == 5
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    assert mart.overwrite_if_any(spark.range(0), "t") == 0
    assert spark.read.parquet(mart.path("t")).count() == 5

    move = staging.move_tree

    def second_move_breaks(spark, source, target):
        if "_new." in source:
            raise Gone
        move(spark, source, target)

    with monkeypatch.context() as patched:
        patched.setattr(staging, "move_tree", second_move_breaks)
        with pytest.raises(Gone):
            mart.overwrite(spark.range(2), "t")
    assert spark.read.parquet(mart.path("t")).count() == 5
    # the process ends between the two moves
    move(spark, mart.path("t"), staging.backup_of(mart.path("t")))
    assert mart.recover(spark, "t") and not mart.recover(spark, "t")
    assert spark.read.parquet(mart.path("t")).count() == 5
    move(spark, mart.path("t"), staging.backup_of(mart.path("t")))
    assert mart.overwrite(spark.range(2), "t") == 2
    assert spark.read.parquet(mart.path("t")).count() == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_notes_are_read_back(spark, tmp_path):
    path = f"{tmp_path}/folder/_note"
    assert staging.read_note(spark, path) is None
    for note in ({"a": [1, "é"]}, 7, {}):
        staging.write_note(spark, path, note)
        assert staging.read_note(spark, path) == note
    assert staging.children(spark, f"{tmp_path}/folder") == ["_note"]
    assert staging.children(spark, f"{tmp_path}/none") == []


def test_only_whole_stale_folders_go_at_once(spark, tmp_path):
    """Files beside live or young ones go one by one; a live folder without files stays."""
    root = f"{tmp_path}/lake"
    for place in ("old/a", "old/b", "mixed/live", "mixed/stale", "kept"):
        spark.range(3).coalesce(1).write.parquet(f"{root}/{place}")
    os.makedirs(f"{root}/old/b/empty table")
    live = [f"{root}/kept", f"{root}/mixed/live", f"{root}/old/b/empty table"]
    report = stale_files(spark, root, live, older_than_hours=0)
    trees = {r["path"].split("/lake/")[1] for r in stale_trees(report, root, live).collect()}
    whole = {t for t in trees if not t.endswith(".parquet")}
    assert whole == {"old/a", "mixed/stale"}
    assert [t.startswith("old/b/part-") for t in trees - whole] == [True]
    assert delete_stale(report, root, live) == 3
    assert sorted(os.listdir(f"{root}/mixed")) == ["live"]
    assert sorted(os.listdir(f"{root}/old")) == ["b"] and os.path.isdir(live[2])


def test_jdbc_mart_refuses_nested_columns(spark, sf_dir):
    with pytest.raises(TypeError, match="identifier"):
        JdbcMart("jdbc:none:x").overwrite(fixtures.raw_patient(spark, sf_dir), "patient")


def test_jdbc_mart_without_a_driver_fails(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        JdbcMart("jdbc:none:x").overwrite(spark.range(2), "t")


class RecordedMart(JdbcMart):
    """The writer's logic with the database calls replaced."""

    stored: list[int]

    def _stored_rows(self, spark, table):
        return self.stored.pop(0)


def test_jdbc_mart_repeats_until_the_counts_agree(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(
        DataFrameWriter,
        "jdbc",
        lambda self, url, table, mode=None, properties=None: (
            calls.append((url, table, properties)),
            self.format("noop").mode("overwrite").save(),
        ),
    )
    mart = RecordedMart("jdbc:x", {"user": "u"}, connections=4)
    object.__setattr__(mart, "stored", [5, 3])
    assert mart.overwrite(spark.range(3), "t") == 3
    expected = {"user": "u", "numPartitions": "4", "batchsize": "10000"}
    assert calls == [("jdbc:x", "t", expected)] * 2
    own = JdbcMart("jdbc:x", {"batchsize": "500", "numPartitions": "2"}).writer_options()
    assert own == {"batchsize": "500", "numPartitions": "2"}
    object.__setattr__(mart, "stored", [4, 4])
    with pytest.raises(RowsMissing):
        mart.overwrite(spark.range(3), "t")


def test_mart_choice():
    assert isinstance(mart_from_config(LakeConfig("r", jdbc_url="jdbc:x")), JdbcMart)
    assert isinstance(mart_from_config(LakeConfig("r", mart_root="m")), FileMart)
    with pytest.raises(ValueError):
        mart_from_config(LakeConfig("r"))


def test_stale_files_are_reported_then_deleted(spark, tmp_path):
    rows = spark.createDataFrame(
        [(i, date(2020, 1, 1 + i % 3)) for i in range(9)], "a INT, partitionDate DATE"
    )
    root = f"{tmp_path}/snap shots"
    create_partitioned(rows, f"{root}/old")
    create_partitioned(rows, f"{root}/new")
    empty = rows.limit(0)
    empty.write.parquet(f"{root}/new/partitionDate=2020-03-01")  # live, though without rows
    live = f"{root}/new"
    assert stale_files(spark, root, live, older_than_hours=1).isEmpty()
    report = stale_files(spark, root, live, older_than_hours=0)
    assert report.columns == ["path", "modificationTime", "length"]
    assert {("/old/" in r["path"]) for r in report.collect()} == {True}
    with pytest.raises(ValueError, match="not under"):
        delete_stale(report, f"{root}/new")
    assert delete_stale(report, root) == 3
    assert stale_files(spark, root, live, older_than_hours=0).isEmpty()
    assert scan_layer(spark, f"{root}/new").count() == 9


def test_shared_folder_follows_the_session(spark, tmp_path):
    before = spark.conf.get(staging.CHECKPOINT_KEY, None)
    if before:
        assert staging.shared_folder(spark, "x").startswith(before.rstrip("/"))
    else:
        assert "tierfold-" in staging.shared_folder(spark, "x")


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "yarn"

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError, match="share"):
        staging.shared_folder(Session(), "x")


def test_appended_rows_keep_nested_values(spark, sf_dir, tmp_path):
    raw = with_raw_partition(fixtures.raw_patient_with_address(spark, sf_dir))
    append_partitioned(raw, f"{tmp_path}/t")
    back = scan_layer(spark, f"{tmp_path}/t").select(*raw.columns)
    assert back.exceptAll(raw).isEmpty() and raw.exceptAll(back).isEmpty()
