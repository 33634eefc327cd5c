"""Streaming twins: late ticks beyond the watermark are dropped from closed
bars; a replayed micro-batch leaves the upserted table unchanged."""

import datetime as dt

from pyspark.sql import functions as F

from optlake.session import scratch_path
from optlake.streaming import jobs as X

TICKS = "contract string, t timestamp, price double, size long, event_id long"


def test_bars_stream_drops_late_ticks(spark, tmp_path):
    """Late rows are filtered with the previous batch's watermark and a
    window is written (append mode) once the current watermark passes its
    end; a tick for an already written window is dropped."""
    import time

    src = tmp_path / "ticks"
    d = dt.datetime(2025, 1, 3)
    files = [
        [("C", d.replace(hour=8, minute=5), 1.0, 1, 1), ("C", d.replace(hour=10, minute=0), 2.0, 1, 2)],
        [("C", d.replace(hour=11, minute=0), 3.0, 1, 3)],
        [("C", d.replace(hour=8, minute=30), 9.0, 5, 4), ("C", d.replace(hour=12, minute=0), 4.0, 1, 5)],
    ]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, TICKS).coalesce(1).write.parquet(str(src / f"b{i}"))
        time.sleep(1.1)  # distinct modification times: files are picked up in order
    schema = spark.read.parquet(str(src / "b0")).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .parquet(str(src / "b*" / "*.parquet")))
    sink, ck = scratch_path(spark, "t-bars"), scratch_path(spark, "t-ck-bars")
    q = X.bars_stream(stream, "1 hour", "30 minutes", sink, ck)
    q.awaitTermination()
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress if p["stateOperators"])
    out = {r.tradetime.hour: r for r in spark.read.parquet(sink).collect()}
    assert sorted(out) == [8, 10]            # 11:00 and 12:00 are still open
    assert out[8].trades == 1 and out[8].last == 1.0
    assert dropped == 1


def test_upsert_stream_replay_is_harmless(spark, tmp_path):
    from optlake.sources.store import TableStore

    store = TableStore(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([
        ("C1", dt.datetime(2025, 1, 3), "SPY", "put", 450.0, 1.0, 1.1, dt.datetime(2025, 1, 3, 20), "a", 1),
        ("C1", dt.datetime(2025, 1, 3), "SPY", "put", 450.0, 1.5, None, dt.datetime(2025, 1, 3, 21), None, 2),
    ], "contract string, tradetime timestamp, underlying_symbol string, option_type string, strike double, "
       "bid double, ask double, fetched_at timestamp, raw_json string, seq int")
    batch = rows.withColumn("seq", F.struct(F.lit(7).cast("long").alias("batch"), F.col("seq").alias("row")))
    store.upsert_eod(batch)
    once = sorted(tuple(r) for r in store.read("option_eod").drop("trade_month").collect())
    store.upsert_eod(batch)  # the same micro-batch delivered again
    twice = sorted(tuple(r) for r in store.read("option_eod").drop("trade_month").collect())
    assert once == twice
    r = store.read("option_eod").collect()[0]
    assert (r.bid, r.ask, r.raw_json) == (1.5, None, "a")


def test_upsert_stream_two_loads_match_oracle(spark, tmp_path):
    """Held rows land first, fresh rows later (two stream runs into one
    table); the table equals the one-shot W1 oracle."""
    import duckdb

    from support import SMALL
    from optlake.plans import fixtures as fx
    from optlake.plans.merge_queries import _eod_rows
    from optlake.plans.oracle_sql import VIEWS
    from optlake.sources.store import TableStore

    rows = _eod_rows(spark, SMALL).drop("src_id")
    for side in ("O", "F"):
        rows.where(F.col("load_side") == side).drop("load_side").write.parquet(str(tmp_path / f"land_{side}"))
    store = TableStore(spark, str(tmp_path / "store"))
    schema = spark.read.parquet(str(tmp_path / "land_O")).schema
    for side in ("O", "F"):
        src = spark.readStream.schema(schema).parquet(str(tmp_path / f"land_{side}"))
        q = X.upsert_stream(src, store, str(tmp_path / f"ck_{side}"))
        q.awaitTermination()
    got = sorted((r.contract, r.tradetime, r.bid, r.ask, r.volatility, r.raw_json, r.strike)
                 for r in store.read("option_eod").collect())
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    sql = f"""
    with contracts_like as ({VIEWS['contracts_like']}), eod_raw_like as ({VIEWS['eod_raw_like']}),
    r as (select e.*, c.strike from eod_raw_like e join contracts_like c on c.contract = e.contract),
    l as (select contract, tradetime, bid, ask, volatility, strike from (
            select *, row_number() over (partition by contract, tradetime order by seq desc) rn from r) x where rn = 1),
    j as (select contract, tradetime, raw_json from (
            select *, row_number() over (partition by contract, tradetime order by seq desc) rn
            from r where raw_json is not null) x where rn = 1)
    select l.contract, l.tradetime, l.bid, l.ask, l.volatility, j.raw_json, l.strike
    from l left join j on j.contract = l.contract and j.tradetime = l.tradetime"""
    want = sorted(con.execute(sql).fetchall())
    assert len(got) == len(want) and got == want
    assert fx is not None


def test_landing_stream_one_page_per_file(spark, tmp_path):
    import json

    land = tmp_path / "land"
    land.mkdir()
    (land / "a.json").write_text(json.dumps({"results": [{"ticker": "C1", "strike_price": 1.0},
                                                         {"ticker": "C2", "strike_price": 2.0}]}))
    (land / "b.json").write_text(json.dumps({"data": [{"id": "x", "type": "t", "attributes": {"contract": "C3"}}]}))
    rows = X.landing_stream(spark, str(land / "*.json"), "contracts", one_page_per_file=True)
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    q = rows.select("page_id", "pos", "contract", "strike").writeStream.format("parquet") \
        .option("path", sink).option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.page_id.rsplit("/", 1)[1], r.pos, r.contract, r.strike) for r in spark.read.parquet(sink).collect())
    assert got == [("a.json", 0, "C1", 1.0), ("a.json", 1, "C2", 2.0), ("b.json", 0, "C3", None)]
