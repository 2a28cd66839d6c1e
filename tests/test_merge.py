from __future__ import annotations

import os
import shutil
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierfold.operators import merge
from tierfold.sinks import create_partitioned
from tierfold.sources import OpenMerge, scan_layer

SCHEMA = "mongoId BIGINT, v STRING, partitionDate DATE"
D1, D2, D3 = date(2020, 1, 1), date(2020, 1, 2), date(2020, 1, 3)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def rows_of(df, *names):
    chosen = df.select(*(names or ("mongoId", "v", "partitionDate")))
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def written(spark, tmp_path, rows, schema=SCHEMA):
    path = f"{tmp_path}/clean.t"
    create_partitioned(frame(spark, rows, schema), path)
    return path


def brute_force(target, source):
    """Row by row, as the rule reads."""
    result = []
    for key, value, day in target:
        hits = [s for s in source if key is not None and s[0] == key]
        same = [s for s in hits if day is not None and s[2] == day]
        result.append(same[0] if same else (key, value, day))
    keys = {t[0] for t in target}
    result += [s for s in source if s[0] is None or s[0] not in keys]
    return sorted(result, key=repr)


TARGET = [(1, "a", D1), (2, "b", D1), (None, "n", D1)]
SOURCE = [(1, "A", D1), (2, "B", D2), (3, "C", D1), (None, "N", D1)]
EXPECTED = sorted(
    [(1, "A", D1), (2, "b", D1), (3, "C", D1), (None, "n", D1), (None, "N", D1)], key=repr
)


def test_four_outcomes(spark):
    assert rows_of(merge.merged(frame(spark, TARGET), frame(spark, SOURCE))) == EXPECTED


def test_four_outcomes_written(spark, tmp_path):
    path = written(spark, tmp_path, TARGET)
    stats = merge.merge_into(spark, path, frame(spark, SOURCE))
    assert rows_of(scan_layer(spark, path)) == EXPECTED
    assert (stats.source_rows, stats.updated, stats.inserted, stats.dropped) == (4, 1, 2, 1)


def test_running_twice_adds_only_null_keys_again(spark, tmp_path):
    path = written(spark, tmp_path, TARGET)
    source = [row for row in SOURCE if row[0] is not None]
    for _ in range(2):
        merge.merge_into(spark, path, frame(spark, source))
    assert rows_of(scan_layer(spark, path)) == brute_force(TARGET, source)


days = st.one_of(st.none(), st.integers(0, 3).map(lambda d: D1 + timedelta(days=d)))
keys = st.one_of(st.none(), st.integers(0, 9))
targets = st.lists(st.tuples(keys, st.sampled_from("abc"), days), min_size=1, max_size=12)
sources = st.lists(
    st.tuples(keys, st.sampled_from("XYZ"), days),
    min_size=1,
    max_size=12,
    unique_by=lambda r: r[0] if r[0] is not None else object(),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=targets, source=sources)
def test_against_brute_force(spark, target, source):
    assert rows_of(merge.merged(frame(spark, target), frame(spark, source))) == brute_force(
        target, source
    )


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=targets, source=sources)
def test_written_against_brute_force(spark, tmp_path_factory, target, source):
    path = written(spark, tmp_path_factory.mktemp("merge"), target)
    merge.merge_into(spark, path, frame(spark, source))
    assert rows_of(scan_layer(spark, path)) == brute_force(target, source)


def test_repeated_target_rows_are_each_replaced(spark, tmp_path):
    target = [(1, "a", D1), (1, "b", D1), (1, "c", D2)]
    source = [(1, "A", D1)]
    expected = sorted([(1, "A", D1), (1, "A", D1), (1, "c", D2)], key=repr)
    assert rows_of(merge.merged(frame(spark, target), frame(spark, source))) == expected
    path = written(spark, tmp_path, target)
    merge.merge_into(spark, path, frame(spark, source))
    assert rows_of(scan_layer(spark, path)) == expected


@pytest.mark.parametrize("second_day", [D1, D2])
def test_repeated_source_key_in_target_is_an_error(spark, tmp_path, second_day):
    source = frame(spark, [(1, "A", D1), (1, "B", second_day)])
    with pytest.raises(merge.DuplicateSourceKeys):
        merge.merged(frame(spark, TARGET), source)
    path = written(spark, tmp_path, TARGET)
    with pytest.raises(merge.DuplicateSourceKeys):
        merge.merge_into(spark, path, source)
    assert rows_of(scan_layer(spark, path)) == sorted(TARGET, key=repr)


def test_repeated_new_keys_are_all_inserted(spark):
    source = [(7, "A", D1), (7, "B", D1)]
    found = rows_of(merge.merged(frame(spark, TARGET), frame(spark, source)))
    assert found == sorted(TARGET + source, key=repr)


def files_of(spark, path):
    wanted = ("_metadata.file_path", "_metadata.file_modification_time")
    found = scan_layer(spark, path).select(*wanted)
    return {tuple(r) for r in found.distinct().collect()}


def test_only_dates_in_question_are_rewritten(spark, tmp_path):
    target = [(i, "t", D1 + timedelta(days=i)) for i in range(6)]
    path = written(spark, tmp_path, target)
    before = files_of(spark, path)
    source = [(2, "U", D1 + timedelta(days=2)), (100, "I", D1 + timedelta(days=4))]
    merge.merge_into(spark, path, frame(spark, source))
    after = files_of(spark, path)
    gone = {p.split("partitionDate=")[1].split("/")[0] for p, _ in before - after}
    new = {p.split("partitionDate=")[1].split("/")[0] for p, _ in after - before}
    assert gone == {"2020-01-03", "2020-01-05"}
    assert new == {"2020-01-03", "2020-01-05"}
    assert rows_of(scan_layer(spark, path)) == brute_force(target, source)


def test_columns_of_either_side_only(spark, tmp_path):
    old = "mongoId BIGINT, v STRING, kept STRING, partitionDate DATE"
    new = "mongoId BIGINT, v STRING, extra STRING, partitionDate DATE"
    target = [(1, "a", "k1", D1), (2, "b", "k2", D2)]
    source = [(1, "A", "x1", D1), (3, "C", "x3", D1)]
    expected = sorted(
        [(1, "A", "k1", "x1", D1), (2, "b", "k2", None, D2), (3, "C", None, "x3", D1)], key=repr
    )
    names = ("mongoId", "v", "kept", "extra", "partitionDate")
    pure = merge.merged(frame(spark, target, old), frame(spark, source, new))
    assert rows_of(pure, *names) == expected
    path = written(spark, tmp_path, target, old)
    merge.merge_into(spark, path, frame(spark, source, new))
    assert rows_of(scan_layer(spark, path), *names) == expected


def test_shared_columns_keep_the_type_of_the_target(spark, tmp_path):
    path = written(spark, tmp_path, [(1, "a", D1), (2, "b", D2)])
    source = frame(spark, [(1, 10, D1), (3, 30, D3)], "mongoId INT, v INT, partitionDate DATE")
    merge.merge_into(spark, path, source)
    expected = [(1, "10", D1), (2, "b", D2), (3, "30", D3)]
    assert rows_of(scan_layer(spark, path)) == expected
    assert scan_layer(spark, path).schema["mongoId"].dataType.simpleString() == "bigint"


def test_hot_target_key_and_null_keys(spark, tmp_path):
    hot = [(5, f"h{i}", D1) for i in range(200)] + [(None, f"n{i}", D2) for i in range(200)]
    target = hot + [(i, "t", D3) for i in range(100, 300)]
    source = [(5, "H", D1)] + [(None, f"m{i}", D2) for i in range(200)] + [(100, "T", D3)]
    path = written(spark, tmp_path, target)
    merge.merge_into(spark, path, frame(spark, source))
    assert rows_of(scan_layer(spark, path)) == brute_force(target, source)


def test_staged_rows_are_removed(spark, tmp_path):
    from tierfold.staging import staged

    with staged(frame(spark, TARGET), "t", counts={"ones": F.count_if(F.col("mongoId") == 1)}) as s:
        assert (s.rows, s.counts["ones"]) == (3, 1)
        assert s.df.count() == 3
        path = s.path
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


class Broken(RuntimeError):
    pass


FAILED_TARGET = [*TARGET, (9, "kept", D1), (8, "kept", D2)]
FAILED_SOURCE = [(1, "A", D1), (7, "x", D2), (7, "y", D2), (None, "N", D1), (5, "new", D3)]


def stages_of(path):
    return [n for n in os.listdir(path) if n.startswith(merge.STAGE)]


def interrupted(spark, path, monkeypatch, phase):
    """Run the merge into a written table until it breaks in the given phase."""
    move, moved = merge.move_tree, []

    def broken_move(spark, source, target):
        if phase == "after the first date" and not moved:
            moved.append(target)
            return move(spark, source, target)
        raise Broken

    def never(*args):
        raise Broken

    with monkeypatch.context() as patched:
        if phase == "while staging":
            patched.setattr(merge, "_begin_commit", never)
        elif phase == "before the note":
            patched.setattr(merge, "_updated", never)
        else:
            patched.setattr(merge, "move_tree", broken_move)
        with pytest.raises(Broken):
            merge.merge_into(spark, path, frame(spark, FAILED_SOURCE), mark=4)


@pytest.mark.parametrize(
    "phase", ["before the note", "while staging", "before the first date", "after the first date"]
)
def test_a_failed_merge_can_be_run_again(spark, tmp_path, monkeypatch, phase):
    """Repeated new keys, null keys and kept rows come out once, whatever failed."""
    path = written(spark, tmp_path, FAILED_TARGET)
    interrupted(spark, path, monkeypatch, phase)
    if phase in ("before the note", "while staging"):
        assert stages_of(path) == []
        assert rows_of(scan_layer(spark, path)) == sorted(FAILED_TARGET, key=repr)
        assert merge.merged_up_to(spark, path) is None
        merge.merge_into(spark, path, frame(spark, FAILED_SOURCE), mark=4)
    else:
        with pytest.raises(OpenMerge):
            scan_layer(spark, path)
        assert merge.finish_merge(spark, path)
    assert rows_of(scan_layer(spark, path)) == brute_force(FAILED_TARGET, FAILED_SOURCE)
    assert merge.merged_up_to(spark, path) == 4
    assert stages_of(path) == []
    assert not merge.finish_merge(spark, path)


def test_the_next_merge_finishes_the_interrupted_one(spark, tmp_path, monkeypatch):
    path = written(spark, tmp_path, FAILED_TARGET)
    interrupted(spark, path, monkeypatch, "after the first date")
    second = [(2, "later", D2), (12, "more", D1)]
    merge.merge_into(spark, path, frame(spark, second))
    first = brute_force(FAILED_TARGET, FAILED_SOURCE)
    assert rows_of(scan_layer(spark, path)) == brute_force(first, second)


@pytest.mark.parametrize("phase", ["before the first date", "after the first date"])
def test_a_lost_stage_is_an_error_and_the_table_stays_shut(spark, tmp_path, monkeypatch, phase):
    path = written(spark, tmp_path, FAILED_TARGET)
    interrupted(spark, path, monkeypatch, phase)
    for name in stages_of(path):
        shutil.rmtree(os.path.join(path, name))
    for _ in range(2):
        with pytest.raises(merge.LostStage):
            merge.finish_merge(spark, path)
        with pytest.raises(OpenMerge):
            scan_layer(spark, path)


def test_every_row_is_written_once(spark, tmp_path):
    """What the merge writes are its actions, the dates, and each row of the dates concerned."""
    path = written(spark, tmp_path, FAILED_TARGET)
    merge.stage_merge(spark, path, frame(spark, FAILED_SOURCE))
    (stage,) = stages_of(path)
    staged_rows = spark.read.parquet(os.path.join(path, stage))
    assert rows_of(staged_rows) == brute_force(FAILED_TARGET, FAILED_SOURCE)
    files = {r[0] for r in staged_rows.select("_metadata.file_name").distinct().collect()}
    assert merge.finish_merge(spark, path)
    after = scan_layer(spark, path).select("_metadata.file_name").distinct().collect()
    assert {r[0] for r in after} == files


def test_target_is_pruned_by_the_dates(spark, tmp_path):
    from tierfold.session import settings_during

    target = [(i, "t", D1 + timedelta(days=i % 40)) for i in range(400)]
    path = written(spark, tmp_path, target)
    source = frame(spark, [(2, "U", D1 + timedelta(days=2)), (500, "I", D1 + timedelta(days=4))])
    table = scan_layer(spark, path)
    actions = merge._classified(table, source, "mongoId", "partitionDate")
    # a broadcast threshold below the size of anything but the few dates
    with settings_during(spark, {"spark.sql.autoBroadcastJoinThreshold": "2k"}):
        with merge._dates(actions, "partitionDate") as dates:
            rows = merge._on_dates(table, dates, "partitionDate")
            assert {r[2] for r in rows.collect()} == {D1 + timedelta(days=2), D1 + timedelta(days=4)}
            plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "mongoId" in x)
    assert "IN dynamicpruning" in plan or "dynamicpruning#" in scan
    assert "dynamicpruningexpression(true)" not in plan
