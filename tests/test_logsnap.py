"""Latest rows from a snapshot and the files after it equal those of the whole log."""

import random
import time

import pytest

from tablewright.operators.logsnap import LatestLog
from tablewright.operators.runlog import latest_per_key
from tablewright.plans import metadata as md
from tablewright.session import scratch_path, unique_table_name
from tablewright.sinks import store

SCHEMA = "k string, t int, seq int, v string, m map<string,string>"


def _log(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    return LatestLog(spark, scratch_path(spark, "log"), scratch_path(spark, "snaps"), schema, ["k"], ["t", "seq"])


def _append(spark, log, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(log.log)


def _plain(df):
    return sorted((r.k or "", r.t if r.t is not None else -1, r.seq, r.v) for r in df.select("k", "t", "seq", "v").collect())


@pytest.mark.parametrize("seed", range(4))
def test_equal_to_the_whole_log(spark, seed):
    """Random drops, late rows, null keys and times, snapshots at any moment."""
    rnd, log, seq, everything = random.Random(seed), _log(spark), 0, []
    for _ in range(5):
        rows = []
        for _ in range(rnd.randrange(0, 12)):
            seq += 1
            rows.append((rnd.choice(["a", "b", "c", "d", None]), rnd.choice([None, *range(6)]), seq, f"v{seq}", {"x": str(seq)}))
        everything += rows
        _append(spark, log, rows)
        if rnd.random() < 0.7:
            log.take(grace=rnd.choice([0, 0, 3600]))
        want = latest_per_key(spark.createDataFrame(everything, SCHEMA), ["k"], ["t", "seq"])
        assert _plain(log.current()) == _plain(want)


def test_older_files_are_not_read(spark):
    log = _log(spark)
    for i in range(4):
        _append(spark, log, [("a", i, i, f"v{i}", None), (f"only{i}", 0, i, "x", None)])
        time.sleep(0.02)
    log.take(grace=0)
    older = sorted(store.files_below(spark, log.log))
    _append(spark, log, [("a", 9, 9, "new", None)])
    df = log.current()
    read = df.inputFiles()
    assert "file_modification_time" in df._jdf.queryExecution().toString()
    want = _plain(df)
    newest = spark.read.format("binaryFile").load(log.log).orderBy("modificationTime").select("path").collect()
    for r in newest[:3]:  # gone, yet nobody asks for them
        store.delete(spark, r.path)
    assert len(older) == 4 and read
    assert _plain(log.current()) == want
    assert ("a", 9, 9, "new") in want and ("only0", 0, 0, "x") in want


def test_empty_and_missing_log(spark):
    log = _log(spark)
    assert log.current().count() == 0
    log.take(grace=0)
    assert log.current().count() == 0
    _append(spark, log, [("a", 1, 1, "v", None)])
    assert log.current().count() == 1
    with pytest.raises(ValueError):
        log.take(keep=1)


def test_failed_snapshot_is_no_snapshot(spark):
    log = _log(spark)
    _append(spark, log, [("a", 1, 1, "v", None)])
    folder = log.take(grace=0)
    _append(spark, log, [("a", 2, 2, "w", None)])
    spark.createDataFrame([("a", 99, 99, "half", None)], SCHEMA).write.parquet(f"{log.snapshots}/snapshot-000000002-lost")
    assert _plain(log.current()) == [("a", 2, 2, "w")]
    for _ in range(3):
        last = log.take(grace=0)
    kept = [n for n in store.names(spark, log.snapshots) if not n.endswith("-lost")]
    assert len(kept) == 2 and last.endswith(kept[-1]) and not folder.endswith(kept[0])


def test_operation_log(spark):
    db = unique_table_name("meta")
    md.create_metadata_tables(spark, db, scratch_path(spark, "meta"))
    for i in range(3):
        md.log_operation(spark, db, f"op{i}", "e", None, {"path": f"/{i}"})
        md.log_operation(spark, db, f"op{i}", "e", md.STARTED)
    md.snapshot_operations(spark, db, grace=0)
    md.log_operation(spark, db, "op1", "e", md.FINISHED)
    got = {r.op_id: r.status for r in md.operations_current(spark, db).collect()}
    assert got == {"op0": md.STARTED, "op1": md.FINISHED, "op2": md.STARTED}
    assert md.operations_current(spark, db).columns == spark.table(f"`{db}`.`{md.OPERATIONS}`").columns
