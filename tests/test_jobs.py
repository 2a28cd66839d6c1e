from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import tierfold.__main__ as cli
from tierfold.checks import fixtures
from tierfold.config import LakeConfig
from tierfold.operators import merge
from tierfold.operators.merge import DuplicateSourceKeys
from tierfold.plans import jobs
from tierfold.sinks import FileMart
from tierfold.sources import SchemaMismatch, scan_layer, table_or_none


@pytest.fixture
def lake(tmp_path):
    root = str(tmp_path)
    config = LakeConfig(root=root, source_root=f"{root}/source", source_format="parquet")
    return config, FileMart(f"{root}/mart")


def put(spark, config, name, documents):
    """Documents of the next ingest: earlier ones are kept under their own folder."""
    source = replace(config, source_root=f"{config.source_root}/{documents.semanticHash()}")
    documents.write.parquet(f"{source.source_root}/{name}")
    return source


@pytest.fixture
def patients(spark, sf_dir):
    return fixtures.raw_patient(spark, sf_dir)


@pytest.fixture
def users(spark, sf_dir):
    wanted = fixtures.raw_user(spark, sf_dir)
    # Few dates, to keep the number of folders small.
    day = F.date_trunc("year", "dateCreated").cast("timestamp_ntz")
    return wanted.withColumn("dateCreated", day).withColumn("lastUpdated", day)


def test_two_rounds_of_all_layers(spark, lake, patients, users):
    config, mart = lake
    even, odd = patients.where("_id % 2 = 0"), patients.where("_id % 2 = 1")
    first, second = put(spark, config, "patient", even), put(spark, config, "patient", odd)
    assert jobs.raw_ingest(spark, first, "patient") == even.count()
    stats = jobs.clean_load(spark, config, "patient")
    assert stats.inserted == even.count()
    assert jobs.raw_ingest(spark, second, "patient") == odd.count()
    stats = jobs.clean_load(spark, config, "patient")
    assert (stats.updated, stats.inserted, stats.dropped) == (even.count(), odd.count(), 0)
    clean = scan_layer(spark, config.clean_path("patient"))
    assert clean.count() == clean.select("mongoId").distinct().count() == patients.count()

    assert jobs.mart_load(spark, config, mart, "patient") == patients.count()
    jobs.raw_ingest(spark, put(spark, config, "user", users), "user")
    jobs.clean_load(spark, config, "user")
    joined, groups = jobs.joined_mart_load(spark, config, mart)
    patients_only = users.where("userType = 'PATIENT'").count()
    assert joined == patients_only
    table = spark.read.parquet(mart.path("patient_user"))
    assert len(table.columns) == 26
    counts = spark.read.parquet(mart.path("patient_aggData"))
    assert counts.count() == groups
    assert counts.agg(F.sum("count")).first()[0] == patients_only


def test_reingested_rows_are_refused_by_the_merge(spark, lake, patients):
    config, _ = lake
    source = put(spark, config, "patient", patients)
    jobs.raw_ingest(spark, source, "patient")
    jobs.raw_ingest(spark, source, "patient")
    jobs.clean_load(spark, config, "patient")
    clean = scan_layer(spark, config.clean_path("patient"))
    assert clean.count() == 2 * patients.count()
    with pytest.raises(DuplicateSourceKeys):
        jobs.clean_load(spark, config, "patient")


def test_documents_of_other_types_are_refused(spark, lake, patients):
    config, _ = lake
    jobs.raw_ingest(spark, put(spark, config, "patient", patients), "patient")
    changed = patients.withColumn("active", F.struct(F.lit("yes").alias("value")))
    with pytest.raises(SchemaMismatch, match="active.value is boolean, not string"):
        jobs.raw_ingest(spark, put(spark, config, "patient", changed), "patient")
    grown = patients.withColumn("active", F.struct("active.value", F.lit("x").alias("note")))
    grown = grown.withColumn("extra", F.lit(1))
    jobs.raw_ingest(spark, put(spark, config, "patient", grown), "patient")
    raw = scan_layer(spark, config.raw_path("patient"))
    assert raw.count() == 2 * patients.count()
    assert raw.where("active.note IS NOT NULL AND extra = 1").count() == patients.count()


def test_nothing_is_written_without_input(spark, lake, patients):
    config, mart = lake
    empty = put(spark, config, "patient", patients.limit(0))
    assert jobs.raw_ingest(spark, empty, "patient") == 0
    assert table_or_none(spark, config.raw_path("patient")) is None
    assert jobs.clean_load(spark, config, "patient") is None
    assert jobs.mart_load(spark, config, mart, "patient") == 0
    assert jobs.mart_load_from_raw(spark, config, mart, "patient") == 0
    assert jobs.joined_mart_load(spark, config, mart) == (0, 0)
    assert jobs.patient_mart_direct(spark, config, mart) == 0
    assert table_or_none(spark, mart.path("patient")) is None


def test_unknown_collection_writes_nothing(spark, lake, patients):
    config, mart = lake
    jobs.raw_ingest(spark, put(spark, config, "visit", patients), "visit")
    assert jobs.clean_load(spark, config, "visit") is None
    assert jobs.mart_load_from_raw(spark, config, mart, "visit") == 0


def test_empty_join_leaves_the_marts_alone(spark, lake, patients, users):
    config, mart = lake
    jobs.raw_ingest(spark, put(spark, config, "patient", patients), "patient")
    strangers = users.withColumn("patientId", -F.col("patientId") - 1)
    jobs.raw_ingest(spark, put(spark, config, "user", strangers), "user")
    for name in ("patient", "user"):
        jobs.clean_load(spark, config, name)
    mart.overwrite(spark.range(1), "patient_user")
    assert jobs.joined_mart_load(spark, config, mart) == (0, 0)
    assert spark.read.parquet(mart.path("patient_user")).columns == ["id"]
    assert table_or_none(spark, mart.path("patient_aggData")) is None


def test_retention_reports_nothing_for_a_whole_table(spark, lake, patients):
    config, _ = lake
    jobs.raw_ingest(spark, put(spark, config, "patient", patients), "patient")
    config = replace(config, retention_hours=0, mart_root=f"{config.root}/mart")
    assert jobs.retention(spark, config, "patient") is None
    jobs.raw_ingest(spark, put(spark, config, "user", patients), "user")
    jobs.clean_load(spark, config, "patient")
    jobs.mart_load(spark, config, FileMart(config.mart_root), "patient")
    assert jobs.retention(spark, config, "patient", config.root).isEmpty()
    patients.write.parquet(f"{config.root}/old/raw.user")
    found = {r["path"] for r in jobs.retention(spark, config, "patient", config.root).collect()}
    assert len(found) == len(list(Path(config.root, "old").rglob("*.parquet")))
    assert jobs.remove_stale(spark, config, config.root) == len(found)
    assert not Path(config.root, "old").exists()
    assert jobs.remove_stale(spark, config, config.root) == 0
    assert scan_layer(spark, config.raw_path("user")).count() == patients.count()


def test_a_failed_first_clean_load_can_be_run_again(spark, lake, patients):
    config, _ = lake
    jobs.raw_ingest(spark, put(spark, config, "patient", patients), "patient")
    (Path(config.clean_path("patient")) / "_temporary").mkdir(parents=True)
    assert jobs.clean_load(spark, config, "patient").inserted == patients.count()
    assert jobs.clean_load(spark, config, "patient").updated == patients.count()
    assert scan_layer(spark, config.clean_path("patient")).count() == patients.count()


def test_document_copies_of_other_types_are_refused(spark, lake, sf_dir):
    config, _ = lake
    documents = fixtures.raw_patient_with_address(spark, sf_dir)
    path = config.raw_path("patient")
    assert jobs.document_copy(spark, put(spark, config, "patient", documents), path) > 0
    changed = documents.withColumn("active", F.struct(F.lit("yes").alias("value")))
    with pytest.raises(SchemaMismatch, match="active.value"):
        jobs.document_copy(spark, put(spark, config, "patient", changed), path)
    assert "address1" in scan_layer(spark, path).columns


def test_since_and_a_schema_reach_the_scan(spark, lake, patients):
    config, _ = lake
    jobs.raw_ingest(spark, put(spark, config, "patient", patients), "patient")
    path = config.raw_path("patient")
    schema = scan_layer(spark, path).schema
    table = table_or_none(spark, path, schema=schema, since=date(2020, 2, 1))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partitionDate" in plan and ">= 2020-02-01" in plan


def test_errors_are_raised(spark, lake):
    config, _ = lake
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.raw_ingest(spark, config, "patient")


def test_command_line(spark, sf_dir, lake, patients, monkeypatch, capsys):
    config, _ = lake
    source = put(spark, config, "patient", patients)
    source = replace(source, mart_root=f"{config.root}/mart")
    monkeypatch.setattr(LakeConfig, "from_session", classmethod(lambda cls, s: source))
    assert cli.main(["processMongoRawData", "patient"]) == patients.count()
    clean = ["cleanMongoRawData", "patient", "--incremental"]
    assert cli.main([*clean, "--since", "2020-02-01"]).inserted < patients.count()
    assert cli.main(clean).dropped == 0
    assert cli.main(clean) is None
    assert cli.main(["processMongoRawData", "patient"]) == patients.count()
    assert cli.main([*clean, "--latest"]).updated == patients.count()
    rows = cli.main(["processData", "--objects", f"{source.source_root}/patient", "--show"])
    assert rows.count() == patients.count()
    json = f"{config.root}/json"
    with_address = fixtures.raw_patient_with_address(spark, sf_dir)
    addressed = put(spark, config, "patient", with_address)
    monkeypatch.setattr(LakeConfig, "from_session", classmethod(lambda cls, s: addressed))
    assert cli.main(["processData", "--json", json]) == patients.count()
    assert spark.read.json(json).select("address1").count() == patients.count()
    assert cli.main(["processData"]) == patients.count()
    monkeypatch.setattr(LakeConfig, "from_session", classmethod(lambda cls, s: source))
    assert cli.main(["loadDiscreteDataInMysql", "patient"]) == patients.count()
    assert cli.main(["cleanFile", "--show"]) is None
    with pytest.raises(SystemExit):
        cli.main(["loadAggregatedDataInMysql", "patient"])
    with pytest.raises(SystemExit):
        cli.main(["noSuchAction"])


def test_config_from_session():
    class Conf:
        def getAll(self):
            return [
                ("spark.tierfold.root", "s3a://b/lake/"),
                ("spark.tierfold.source.option.database", "d"),
                ("spark.tierfold.jdbc.property.user", "u"),
                ("spark.tierfold.retentionHours", "0.1"),
                ("spark.tierfold.writePartitions", "400"),
                ("spark.app.name", "x"),
            ]

    class Context:
        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    config = LakeConfig.from_session(Session())
    assert config.raw_path("user") == "s3a://b/lake/raw.user"
    assert config.clean_path("user") == "s3a://b/lake/clean.user"
    assert config.source_options == {"database": "d"}
    assert config.jdbc_properties == {"user": "u"}
    assert (config.retention_hours, config.write_partitions) == (0.1, 400)


def test_a_mart_load_after_a_broken_commit_is_whole(spark, lake, patients, monkeypatch):
    """The reader finishes the merge that a crash left half in place."""
    config, mart = lake
    changed = F.struct(F.concat("gender.value", F.lit("*")).alias("value"))
    first = put(spark, config, "patient", patients.withColumn("gender", changed))
    jobs.raw_ingest(spark, first, "patient")
    jobs.clean_load(spark, config, "patient", incremental=True)
    jobs.raw_ingest(spark, put(spark, config, "patient", patients), "patient")
    move, moved = merge.move_tree, []

    def third_move_breaks(spark, source, target):
        moved.append(target)
        if len(moved) == 3:
            raise OSError("gone")
        move(spark, source, target)

    with monkeypatch.context() as patched:
        patched.setattr(merge, "move_tree", third_move_breaks)
        with pytest.raises(OSError, match="gone"):
            jobs.clean_load(spark, config, "patient", incremental=True)
    assert jobs.mart_load(spark, config, mart, "patient") == patients.count()
    table = spark.read.parquet(mart.path("patient"))
    assert table.where("gender LIKE '%*'").isEmpty()
    assert table.select("mongoId").distinct().count() == patients.count()
    assert jobs.clean_load(spark, config, "patient", incremental=True) is None


def test_late_documents_are_cleaned_incrementally(spark, lake, patients):
    """``since`` misses documents that arrive under an old date; the ingest mark does not."""
    config, _ = lake
    late, early = patients.where("_id % 4 = 0"), patients.where("_id % 4 <> 0")
    jobs.raw_ingest(spark, put(spark, config, "patient", early), "patient")
    jobs.clean_load(spark, config, "patient", incremental=True)
    old = late.withColumn("lastUpdated", F.lit("2001-01-01").cast("timestamp_ntz"))
    jobs.raw_ingest(spark, put(spark, config, "patient", old), "patient")
    assert jobs.clean_load(spark, config, "patient", since=date(2020, 1, 1)).inserted == 0
    assert jobs.clean_load(spark, config, "patient", incremental=True).inserted == late.count()
    assert jobs.clean_load(spark, config, "patient", incremental=True) is None
    plan = jobs._raw_rows(spark, config, "patient", batches=(1, 2))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ingestBatch,1)" in text and "LessThanOrEqual(ingestBatch,2)" in text


def jobs_run(spark, call):
    """What ``call`` gives, and the number of jobs Spark ran for it."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "counted")
    try:
        found = call()
        return found, len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_an_append_reads_no_footers(spark, lake, patients):
    """The columns are noted beside the table, so nothing runs before the rows are written."""
    config, _ = lake
    patients = patients.where("_id % 90 < 3")  # few dates, which are listed without a job
    source = put(spark, config, "patient", patients)
    jobs.raw_ingest(spark, source, "patient")
    path = config.raw_path("patient")
    layout, ran = jobs_run(spark, lambda: jobs._layout_of(spark, config, path))
    assert ran == 0 and layout.batch == 1
    wanted = {(f.name, f.dataType.simpleString()) for f in scan_layer(spark, path).schema}
    assert {(f.name, f.dataType.simpleString()) for f in layout.schema} == wanted
    grown = patients.withColumn("extra", F.lit(1))
    jobs.raw_ingest(spark, put(spark, config, "patient", grown), "patient")
    raw, ran = jobs_run(spark, lambda: jobs._raw_rows(spark, config, "patient"))
    assert ran == 0 and "extra" in raw.columns
    assert raw.where("ingestBatch = 2 AND extra = 1").count() == patients.count()
    assert raw.where("ingestBatch = 1 AND extra IS NULL").count() == patients.count()
    # without the note the footers tell the same
    Path(path, "_layout").unlink()
    assert jobs._layout_of(spark, config, path).batch == 2
    assert jobs.raw_ingest(spark, source, "patient") == patients.count()
    assert scan_layer(spark, path).agg(F.max("ingestBatch")).first()[0] == 3


def json_lake(config, lines, name="first"):
    folder = Path(config.root, name, "patient")
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("\n".join(lines))
    return replace(config, source_format="json", source_root=str(folder.parent))


def test_broken_documents_are_kept_apart(spark, lake):
    config, _ = lake
    good = ['{"_id":1,"lastUpdated":"2020-01-01T00:00:00","a":1}', '{"_id":2,"a":2}']
    source = json_lake(config, [*good, '{"_id":3,"a":', "no JSON at all"])
    assert jobs.raw_ingest(spark, source, "patient") == 2
    assert scan_layer(spark, config.raw_path("patient")).where("_id IS NULL").isEmpty()
    kept = spark.read.parquet(config.quarantine_path("patient"))
    assert {r["document"] for r in kept.collect()} == {'{"_id":3,"a":', "no JSON at all"}
    assert {r["ingestBatch"] for r in kept.collect()} == {1}
    assert all(r["file"].endswith("a.json") for r in kept.collect())
    # a value that does not fit the table's type, though it parses
    later = json_lake(config, [*good, '{"_id":4,"lastUpdated":"yesterday"}'], "second")
    assert jobs.raw_ingest(spark, later, "patient") == 2
    assert kept.where("document LIKE '%yesterday%'").count() == 0
    kept = spark.read.parquet(config.quarantine_path("patient"))
    assert kept.where("document LIKE '%yesterday%' AND ingestBatch = 2").count() == 1
    # nothing but broken documents: no rows, and all of them kept
    only = json_lake(config, ["{", "}"], "third")
    schema = scan_layer(spark, config.raw_path("patient")).drop("ingestBatch").schema
    assert jobs.raw_ingest(spark, only, "patient", schema) == 0
    assert spark.read.parquet(config.quarantine_path("patient")).count() == 5


def test_types_json_cannot_tell_follow_the_table(spark, lake):
    config, _ = lake
    first = ['{"_id":1,"lastUpdated":"2020-01-01T00:00:00","s":{"v":"x"},"d":1.5,"t":"1","l":[{"k":1}]}']
    later = ['{"_id":2,"lastUpdated":null,"s":null,"d":2,"t":7,"l":[]}', '{"_id":3,"s":{"v":null}}']
    assert jobs.raw_ingest(spark, json_lake(config, first), "patient") == 1
    assert jobs.raw_ingest(spark, json_lake(config, later, "second"), "patient") == 2
    raw = scan_layer(spark, config.raw_path("patient"))
    assert raw.schema["s"].dataType.simpleString() == "struct<v:string>"
    found = {r["_id"]: r for r in raw.collect()}
    assert (found[2]["d"], found[2]["t"], found[2]["s"]) == (2.0, "7", None)
    other = ['{"_id":4,"s":"text","lastUpdated":"2020-01-01T00:00:00"}']
    with pytest.raises(SchemaMismatch, match="s is struct"):
        jobs.raw_ingest(spark, json_lake(config, other, "third"), "patient")
    assert scan_layer(spark, config.raw_path("patient")).count() == 3
