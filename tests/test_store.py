"""Table store: merges rewrite only the touched partitions and read no others,
are idempotent, keep held rows, quarantine bad ones and clean up after
themselves; API reads prune."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from optlake import api
from optlake.session import list_folders, scratch_root
from optlake.sources.store import TableStore
from support import rows

SCHEMA = ("contract string, tradetime timestamp, underlying_symbol string, option_type string, "
          "strike double, bid double, ask double, fetched_at timestamp, raw_json string, seq int")
STAMP = dt.datetime(2026, 9, 1)


def _row(contract, day, strike=50.0, bid=1.0, ask=1.5, raw=None, seq=1):
    return contract, day, "KLMN", "put", strike, bid, ask, STAMP, raw, seq


def _staged(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_is_idempotent_and_partitioned(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    march, april = dt.datetime(2026, 3, 9, 15), dt.datetime(2026, 4, 10, 15)
    store.upsert_eod(_staged(spark, [_row("A", march, raw="r"), _row("B", april, strike=60.0, bid=2.0)]))
    second = _staged(spark, [_row("A", march, strike=51.0, bid=None, ask=1.7, seq=2)])
    store.upsert_eod(second)
    got = rows(store.read("option_eod"), "contract", "strike", "bid", "ask", "raw_json")
    assert got == [("A", 50.0, None, 1.7, "r"), ("B", 60.0, 2.0, 1.5, None)]
    store.upsert_eod(second)  # replay
    assert rows(store.read("option_eod"), "contract", "strike", "bid", "ask", "raw_json") == got
    assert sorted(list_folders(spark, store.path("option_eod"))) == ["trade_month=2026-03-01", "trade_month=2026-04-01"]
    q = api.eod(store, underlying_symbol="KLMN", tradetime_from="2026-04-01", tradetime_to="2026-04-30")
    assert [r.contract for r in q.collect()] == ["B"]


def test_snapshots_of_one_day_are_one_row(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "day"))
    early, late = dt.datetime(2026, 3, 9, 14, 30), dt.datetime(2026, 3, 9, 15, 30)
    store.upsert_eod(_staged(spark, [_row("A", early, bid=1.0, seq=1), _row("A", late, bid=1.2, seq=2)]))
    store.upsert_eod(_staged(spark, [_row("A", late, bid=1.9, seq=3), _row("A", dt.datetime(2026, 3, 10), seq=4)]))
    got = rows(store.read("option_eod"), "contract", "tradetime", "bid")
    assert got == [("A", dt.date(2026, 3, 9), 1.9), ("A", dt.date(2026, 3, 10), 1.0)]
    assert store.read("option_eod").where("tradetime = date '2026-03-09'").first().bid_date == early


def test_merge_reads_touched_months_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "months"))
    store.upsert_eod(_staged(spark, [_row(f"C{m}", dt.datetime(2026, m, 5)) for m in range(1, 9)]))
    held = store._held("option_eod", ["2026-03-01", "2026-05-01"])
    scan = next(line for line in _plan(held).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [trade_month" in scan and "2026-03-01" in scan and "DynamicFileSourceScan" not in scan
    assert {f.split("trade_month=")[1][:10] for f in (r.f for r in held.select(F.input_file_name().alias("f")).collect())} == \
        {"2026-03-01", "2026-05-01"}
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "months/option_eod").glob("trade_month=*/*.parquet")}
    store.upsert_eod(_staged(spark, [_row("C3", dt.datetime(2026, 3, 5), bid=9.0)]))
    after = set((tmp_path / "months/option_eod").glob("trade_month=*/*.parquet"))
    gone = {p.parent.name for p in before if p not in after}
    assert gone == {"trade_month=2026-03-01"} and store.read("option_eod").count() == 8


def test_null_keys_go_to_quarantine_and_held_rows_stay(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "bad"))
    day = dt.datetime(2026, 3, 9)
    store.upsert_eod(_staged(spark, [_row("A", day)]))
    store.upsert_eod(_staged(spark, [_row("B", None), _row(None, day), _row("D", day)]))
    assert rows(store.read("option_eod"), "contract") == [("A",), ("D",)]
    assert sorted(r.reasons[0] for r in store.quarantine("option_eod").collect()) == ["contract is null", "tradetime is null"]
    store.upsert_eod(_staged(spark, [_row(None, None)]))  # nothing good in the load
    assert store.read("option_eod").count() == 2 and store.quarantine("option_eod").count() == 3


def test_bars_merge_keeps_other_contracts(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "bars"))
    schema = "contract string, tradetime timestamp, open double, high double, low double, last double, volume double, vwap double, seq int"

    def bars(contract, n, price):
        t0 = dt.datetime(2026, 3, 9)
        return spark.createDataFrame([(contract, t0 + dt.timedelta(minutes=i), price, price, price, price, 1.0, price, i) for i in range(n)], schema)

    store.upsert_bars(bars("C", 1440, 1.0))
    store.upsert_bars(bars("D", 1, 2.0).unionByName(bars("C", 2, 3.0)))
    got = {r.contract: (r.n, r.s) for r in store.read("bars").groupBy("contract").agg(F.count("*").alias("n"), F.sum("last").alias("s")).collect()}
    assert got == {"C": (1440, 1438 + 6.0), "D": (1, 2.0)}
    with pytest.raises(ValueError):
        store.replace("bars", bars("D", 1, 2.0))


def test_scratch_is_clean_after_a_merge(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "clean"))
    root = f"{scratch_root(spark)}/optlake"
    before = set(list_folders(spark, root))
    for bid in (1.0, 2.0):
        store.upsert_eod(_staged(spark, [_row("A", dt.datetime(2026, 3, 9), bid=bid)]))
    assert set(list_folders(spark, root)) == before


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from optlake import session

    monkeypatch.setattr(session, "is_local", lambda s: False)
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    if not spark.conf.get("spark.checkpoint.dir", None):
        with pytest.raises(RuntimeError):
            session.scratch_root(spark)


def test_pushdown_in_plan(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s2"))
    store.ensure("option_eod")
    q = api.eod(store, contract="C1", tradetime_from="2026-01-01", tradetime_to="2026-01-31", fields="contract,bid")
    scan = next(line for line in _plan(q).splitlines() if "FileScan" in line)
    pushed = scan.split("PushedFilters: [")[1]
    assert "IsNotNull(contract)" in pushed and "IsNotNull(tradetime)" in pushed
    assert scan.split("ReadSchema: ")[1].startswith("struct<contract:string,tradetime:date,bid:double")


def test_a_merge_shuffles_its_rows_once(spark, tmp_path, monkeypatch):
    store, seen = TableStore(spark, str(tmp_path / "once")), []
    write = store.overwrite_partitions
    monkeypatch.setattr(store, "overwrite_partitions", lambda name, rows, **how: (seen.append((rows, how)), write(name, rows, **how))[1])
    for load in range(2):  # the second meets held rows
        store.upsert_eod(_staged(spark, [_row(f"C{n % 40}", dt.datetime(2026, 1 + n % 5, 9), bid=float(load), seq=n) for n in range(400)]))
        rows_, how = seen.pop()
        assert _plan(rows_).count("Exchange ") == 1 and how["dealt"]
    assert {(r.contract, str(r.tradetime)[:7]) for r in store.read("option_eod").collect()} == {(f"C{n % 40}", f"2026-0{1 + n % 5}") for n in range(400)}
    assert store.read("option_eod").count() == 40 and store.read("option_eod").where("bid = 1").count() == 40


def test_large_months_are_dealt_to_several_buckets(spark, tmp_path, monkeypatch):
    import optlake.sources.store as S

    monkeypatch.setattr(S, "BUCKET_ROWS", 10)
    store = TableStore(spark, str(tmp_path / "large"))
    store.upsert_eod(_staged(spark, [_row(f"C{n}", dt.datetime(2026, 3, 9), seq=n) for n in range(300)]))
    assert store.read("option_eod").count() == 300 and store.read("option_eod").select("contract").distinct().count() == 300
