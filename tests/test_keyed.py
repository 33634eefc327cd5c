"""Keyed tables: a batch writes its own rows only, replays change nothing, reads merge, compaction keeps rows and readers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from optlake.operators import bars as B
from optlake.session import list_folders
from optlake.sources.keyed import KeyedTable
from optlake.streaming import jobs as X
from support import rows

SCHEMA = "task_id long, status string, n int"


def _batch(spark, ids, status, n):
    return spark.createDataFrame([(i, status, n) for i in ids], SCHEMA)


def _delta_rows(spark, table):
    return {v: spark.read.parquet(table._path("delta", v)).count() for v in table.versions()[1]}


def test_batches_write_their_own_rows(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["task_id"], share=1e9)
    table.apply(_batch(spark, range(1000), "pending", 0), 0)
    for v in range(1, 6):
        table.apply(_batch(spark, [v, 10 + v], "running", v), v)
    assert _delta_rows(spark, table) == {0: 1000} | {v: 2 for v in range(1, 6)}
    got = {r.task_id: (r.status, r.n) for r in table.read().collect()}
    assert len(got) == 1000 and got[3] == ("running", 3) and got[12] == ("running", 2) and got[500] == ("pending", 0)
    assert table.read().columns == ["task_id", "status", "n"]


def test_compaction_is_amortised(spark, tmp_path):
    """With a share of one half, everything that 30 small batches write is a small multiple of what they brought."""
    table = KeyedTable(spark, str(tmp_path / "t"), ["task_id"], buckets=4, share=0.5)
    written = brought = 0
    for v in range(30):
        base = table.versions()[0]
        table.apply(_batch(spark, range(20 * v, 20 * v + 20), "x", v), v)
        brought += 20
        after = table.versions()[0]
        written += 20 + (spark.read.parquet(table._path("base", after)).count() if after != base else 0)
    assert table.read().count() == brought == 600 and written <= 5 * brought
    assert len(table.versions()[1]) < 20 and len(list_folders(spark, str(tmp_path / "t/base"))) <= 2


def test_replay_changes_nothing(spark, tmp_path):
    add = lambda r, key, seq: r.groupBy(*key).agg(F.sum("n").cast("int").alias("n"), F.max("status").alias("status"))
    table = KeyedTable(spark, str(tmp_path / "t"), ["task_id"], fold=add)
    for v in (0, 1, 1, 2, 0, 2):  # an adding fold would count a replay twice
        table.apply(_batch(spark, [1, 2, v + 5], "s", 10), v)
    assert rows(table.read(), "task_id", "n") == [(1, 30), (2, 30), (5, 10), (6, 10), (7, 10)]
    table.compact()
    assert table.apply(_batch(spark, [1], "s", 10), 1) is False and table.versions() == (2, [])
    assert rows(table.read(), "task_id", "n")[0] == (1, 30)


def test_a_batch_that_died_is_not_seen(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["task_id"])
    table.apply(_batch(spark, [1, 2], "a", 1), 0)
    table._write(_batch(spark, [1, 3], "half", 9), "delta", 1)
    (tmp_path / "t/delta" / "v=000000000001" / "_SUCCESS").unlink()
    assert rows(table.read(), "task_id", "status") == [(1, "a"), (2, "a")]
    assert table.apply(_batch(spark, [3], "b", 2), 1)
    assert rows(table.read(), "task_id", "status") == [(1, "a"), (2, "a"), (3, "b")]


def test_keys_nulls_and_empty_batches(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["task_id"], buckets=8)
    with pytest.raises(FileNotFoundError):
        table.read()
    table.apply(_batch(spark, [], "a", 1), 0)
    with pytest.raises(FileNotFoundError):
        table.read()
    table.apply(_batch(spark, [None, *range(50)], "a", 1), 1)
    table.apply(_batch(spark, [None, 7], "b", 2), 2)
    table.apply(_batch(spark, [], "c", 3), 3)
    got = {r.task_id: r.status for r in table.read().collect()}
    assert len(got) == 51 and got[None] == got[7] == "b"
    wanted = _batch(spark, [7, 8, 99], "", 0).select("task_id")
    assert rows(table.read(keys=wanted), "task_id", "status") == [(7, "b"), (8, "a")]
    plan = table.read(keys=wanted)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__bucket" in plan or "PartitionFilters: [__bucket" in plan
    assert len(table.read(upto=1).where("status = 'a'").collect()) == 51


def test_changes_add_up(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["task_id"])
    log = None
    for v, (ids, status) in enumerate([([1, 2, 3], "a"), ([2, 3, 4], "b"), ([3], "b"), ([1], "c")]):
        table.apply(_batch(spark, ids, status, 0), v, compact=False)
        got = table.changes(v)
        log = got if log is None else log.unionByName(got)
        if v == 1:
            assert rows(got, "task_id", "status", "op") == [(2, "a", -1), (2, "b", 1), (3, "a", -1), (3, "b", 1), (4, "b", 1)]
        if v == 2:
            assert got.count() == 0
    left = log.groupBy("task_id", "status", "n").agg(F.sum("op").alias("op")).where("op <> 0")
    assert rows(left, "task_id", "status", "op") == [(*r, 1) for r in rows(table.read(), "task_id", "status")]


def test_late_ticks_correct_written_bars(spark, tmp_path):
    """Ticks hours behind the newest one change open, close, high, low, volume and vwap of bars written before."""
    d = dt.datetime(2025, 1, 3)
    loads = [[("C", d.replace(hour=8, minute=10), 2.0, 1, 10), ("C", d.replace(hour=12), 4.0, 1, 20)],
             [("C", d.replace(hour=8, minute=5), 1.0, 3, 11), ("C", d.replace(hour=8, minute=50), 9.0, 2, 12)],
             [("C", d.replace(hour=8, minute=50), 7.0, 2, 13), ("D", d.replace(hour=8), 5.0, 1, 14)]]
    schema = "contract string, t timestamp, price double, size long, event_id long"
    table, log, ck, land = X.bar_table(spark, str(tmp_path / "bars")), str(tmp_path / "log"), str(tmp_path / "ck"), tmp_path / "land"
    for n, load in enumerate(loads):
        spark.createDataFrame(load, schema).write.parquet(str(land / str(n)))
        src = spark.readStream.schema(schema).parquet(str(land / "*"))
        X.late_bars_stream(src, "1 hour", table, ck, changelog=log).awaitTermination()
        now = B.finish_states(table.read())
        want = B.ticks_to_bars(spark.createDataFrame([t for part in loads[:n + 1] for t in part], schema), "1 hour")
        assert rows(now, *want.columns) == rows(want)
    first = {r.op: r for r in spark.read.parquet(f"{log}/v=1").where("contract = 'C'").collect()}
    assert (first[-1].open, first[-1].last, first[-1].volume) == (2.0, 2.0, 1.0)
    assert (first[1].open, first[1].last, first[1].high, first[1].volume) == (1.0, 9.0, 9.0, 6.0)
    assert rows(spark.read.parquet(f"{log}/v=2"), "contract", "op") == [("C", -1), ("C", 1), ("D", 1)]


def test_task_stream_writes_changed_tasks_only(spark, tmp_path):
    schema = "seq long, task_id long, at timestamp, kind string, retryable boolean, worker string, rows_inserted long, message string"
    table = KeyedTable(spark, str(tmp_path / "state"), ["task_id"], share=1e9)
    at = dt.datetime(2025, 1, 3)
    loads = [[(i, i, at, "claimed", None, "w", None, None) for i in range(100)], [(200 + i, i, at, "completed", None, "w", 5, None) for i in (3, 4)]]
    for n, load in enumerate(loads):
        spark.createDataFrame(load, schema).write.parquet(str(tmp_path / "land" / str(n)))
        src = spark.readStream.schema(schema).parquet(str(tmp_path / "land" / "*"))
        X.task_state_stream(src, table, str(tmp_path / "ck")).awaitTermination()
    sizes = sorted(n for n in (0 if d is None else d.count() for d in (table._read("delta", v) for v in table.versions()[1])) if n)
    held = 0 if table.versions()[0] is None else table._read("base", table.versions()[0]).count()
    assert sizes in ([2, 100], [2]) and (sizes != [2] or held == 100)
    got = {r.task_id: r.status for r in table.read().collect()}
    assert len(got) == 100 and got[3] == got[4] == "completed" and got[5] == "running"


def test_deltas_and_compaction_shuffle_their_rows_once(spark, tmp_path, monkeypatch):
    table, plans = KeyedTable(spark, str(tmp_path / "once"), ["task_id"], share=1e9), []
    write = KeyedTable._write
    monkeypatch.setattr(KeyedTable, "_write", lambda self, rows, kind, v: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), write(self, rows, kind, v))[1])
    for v in range(2):
        table.apply(spark.createDataFrame([(n % 30, v, n) for n in range(90)], "task_id long, load int, seq int"), v, seq="seq")
    table.compact()
    assert [p.count("Exchange ") for p in plans] == [1, 1, 1] and not any("rebalance" in p.lower() for p in plans)
    assert table.versions() == (1, []) and sorted((r.task_id, r.load) for r in table.read().collect()) == [(n, 1) for n in range(30)]
    assert table.read().columns == ["task_id", "load"]
