"""Smaller inventory items: generic records (N6), row keys (N8), overall
next tasks (T3), outcome classes with error text (L2), file inventory (S9)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from optlake.operators.normalize import normalize, row_key
from optlake.operators.requests import outcome_class
from optlake.operators.tasks import next_pending
from optlake.sources.pages import page_records, parse_pages


def _recs(spark, page):
    df = spark.createDataFrame([("p", json.dumps(page))], "page_id string, page_text string")
    return page_records(parse_pages(df))


def test_generic_scalars_and_legacy(spark):
    out = normalize(_recs(spark, {"data": [7, {"id": "a", "type": "x", "attributes": {"k": 1}}]}), "other").collect()
    got = sorted(((r.value, r.response_id, r.response_type) for r in out), key=repr)
    assert got == sorted([(None, "a", "x"), ("7", None, None)], key=repr)
    assert all(len(r.row_key) == 40 for r in out)


def test_row_key_per_endpoint(spark):
    df = spark.createDataFrame([("C1", dt.datetime(2025, 1, 3))], "contract string, tradetime timestamp")
    k = df.select(row_key(df, "eod").alias("k")).collect()[0].k
    assert (k.contract, k.tradetime) == ("C1", dt.datetime(2025, 1, 3))
    h = df.select(row_key(df, "unknown").alias("k")).collect()[0].k
    assert len(h.row_hash) == 40


def test_next_pending_overall(spark):
    t = spark.createDataFrame([
        (1, 1, "pending", 200, dt.datetime(2025, 1, 1)), (2, 1, "pending", 100, dt.datetime(2025, 1, 2)),
        (3, 2, "pending", 100, dt.datetime(2025, 1, 1)), (4, 2, "running", 50, dt.datetime(2025, 1, 1)),
    ], "task_id long, job_id long, status string, priority int, created_at timestamp")
    assert [r.task_id for r in next_pending(t, 2).collect()] == [3, 2]


def test_outcome_classes(spark):
    df = spark.createDataFrame([(200, None), (429, None), (503, None), (403, None), (None, "read timed out"),
                                (None, "connection reset by peer"), (None, "bad token")], "code int, msg string")
    got = [r.c for r in df.select(outcome_class(F.col("code"), F.col("msg")).alias("c")).collect()]
    assert got == ["ok", "retryable", "retryable", "fatal", "retryable", "retryable", "fatal"]


def test_file_inventory(spark, tmp_path):
    from optlake.sources.flatfiles import file_inventory, folder_summary, sample_files

    for i in range(3):
        (tmp_path / "d").mkdir(exist_ok=True)
        (tmp_path / "d" / f"f{i}.csv").write_text("x\n" * (i + 1))
    inv = file_inventory(spark, str(tmp_path / "d"))
    s = folder_summary(inv).collect()[0]
    assert (s.files, s.bytes) == (3, 2 + 4 + 6)
    assert [r.path.rsplit("/", 1)[1] for r in sample_files(inv, 2).collect()] == ["f0.csv", "f1.csv"]
