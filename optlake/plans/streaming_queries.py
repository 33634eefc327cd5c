"""Driver queries run as Structured Streaming jobs over the driver's tables
read as file streams (``availableNow``), each with its own checkpoint and
sink under the shared scratch folder; the result is read back from the sink.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from optlake.operators import bars as B
from optlake.plans import fixtures as fx
from optlake.plans.ops_queries import BAR_COLUMNS, TASK_STATE_SQL, bars_sql
from optlake.plans.registry import query
from optlake.session import scratch_path
from optlake.sources.keyed import KeyedTable
from optlake.sources.store import TableStore
from optlake.streaming import jobs as X


def _run(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


CLOSED_BARS_SQL = bars_sql("1 hour") + "where a.tradetime + interval '1 hour' <= (select max(t) from ticks_like)\n"


@query("stream_bars", ["ticks_like"], CLOSED_BARS_SQL)
def q_stream_bars(spark, sf_dir):
    """Hourly bars from a tick stream, watermark 0, append mode: every
    hour the watermark has closed (all but the last open one)."""
    X.use_rocksdb_state(spark)
    ticks = fx.ticks_like(spark, sf_dir, src=fx.table_stream(spark, sf_dir, "events"))
    sink, ck = scratch_path(spark, "stream-bars"), scratch_path(spark, "ck-stream-bars")
    _run(X.bars_stream(ticks, "1 hour", "0 seconds", sink, ck))
    out = spark.read.parquet(sink)
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "tradetime" else F.col(c) for c in BAR_COLUMNS])


@query("stream_bars_batches", ["ticks_like"], CLOSED_BARS_SQL)
def q_stream_bars_batches(spark, sf_dir):
    """X3 in several micro-batches: a time slice lands, then the stream goes on from its
    checkpoint, so bars stay open over batches and close as the watermark moves."""
    X.use_rocksdb_state(spark)
    ticks, land = fx.ticks_like(spark, sf_dir), scratch_path(spark, "landing-ticks")
    span = ticks.agg(F.min("t").alias("a"), F.max("t").alias("b")).first()
    third = (span.b - span.a) / 3
    sink, ck = scratch_path(spark, "stream-bars"), scratch_path(spark, "ck-stream-bars")
    for n in range(3):
        part = ticks.where(F.col("t") >= F.lit(span.a + n * third))
        part = part.where(F.col("t") < F.lit(span.a + (n + 1) * third)) if n < 2 else part
        part.write.parquet(f"{land}/{n}")
        _run(X.bars_stream(spark.readStream.schema(ticks.schema).parquet(f"{land}/*"), "1 hour", "0 seconds", sink, ck))
    out = spark.read.parquet(sink)
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "tradetime" else F.col(c) for c in BAR_COLUMNS])


def _late_ticks(spark, sf_dir, table, changelog=None):
    """Three loads of ticks that each reach over the whole time span: all but the first are late for every bar."""
    ticks, land, ck = fx.ticks_like(spark, sf_dir), scratch_path(spark, "landing-ticks"), scratch_path(spark, "ck-late-bars")
    for n in range(3):
        ticks.where(F.pmod("event_id", F.lit(3)) == n).write.parquet(f"{land}/{n}")
        _run(X.late_bars_stream(spark.readStream.schema(ticks.schema).parquet(f"{land}/*"), "1 hour", table, ck, changelog))


@query("stream_bars_late", ["ticks_like"], bars_sql("1 hour"))
def q_stream_bars_late(spark, sf_dir):
    """X3 with late ticks: two thirds of the ticks come when their bars are long written; the stored
    states take them in, and the bars equal those over all ticks at once."""
    table = X.bar_table(spark, scratch_path(spark, "late-bars"))
    _late_ticks(spark, sf_dir, table)
    out = B.finish_states(table.read())
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "tradetime" else F.col(c) for c in BAR_COLUMNS])


@query("stream_bar_changes", ["ticks_like"], bars_sql("1 hour"))
def q_stream_bar_changes(spark, sf_dir):
    """X3 corrections: the log of retracted and inserted bars of all batches adds up to the bars over all ticks."""
    table, log = X.bar_table(spark, scratch_path(spark, "late-bars")), scratch_path(spark, "bar-changes")
    _late_ticks(spark, sf_dir, table, log)
    rows = spark.read.parquet(f"{log}/v=*").withColumn("tradetime", F.col("tradetime").cast("timestamp_ntz"))
    return rows.groupBy(*BAR_COLUMNS).agg(F.sum("op").alias("n")).where("n <> 0").select(*BAR_COLUMNS)


@query("stream_quota", ["request_log_like"], """
select time_bucket(interval '1 minute', created_at) as minute, count(*) as requests, count(*) * 10 as units,
       cast(sum(row_count) as bigint) as rows, count(*) > 90 as over_rate, count(*) > 1000 as over_vendor_limit
from request_log_like group by 1
having time_bucket(interval '1 minute', created_at) + interval '1 minute'
       <= (select max(created_at) from request_log_like) - interval '10 minutes'
""")
def q_stream_quota(spark, sf_dir):
    """Requests per minute from the request-log stream, 10 minutes of
    lateness allowed; closed minutes only."""
    X.use_rocksdb_state(spark)
    log = fx.request_log_like(spark, sf_dir, src=fx.table_stream(spark, sf_dir, "events"))
    sink, ck = scratch_path(spark, "stream-quota"), scratch_path(spark, "ck-stream-quota")
    _run(X.quota_stream(log, "10 minutes", sink, ck))
    return spark.read.parquet(sink).withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query("stream_dedupe", ["eod_raw_like"], """
select distinct contract, tradetime, cast(substring(contract, 3) as bigint) as part_key, cast(tradetime as timestamp) as at from eod_raw_like
""")
def q_stream_dedupe(spark, sf_dir):
    """One row per (contract, tradetime) within the lateness bound; repeats are equal in every column."""
    X.use_rocksdb_state(spark)
    rows = fx.eod_raw_like(spark, sf_dir, src=fx.table_stream(spark, sf_dir, "lineitem")).select(
        "contract", "tradetime", F.col("part_key").cast("long").alias("part_key"), F.col("tradetime").cast("timestamp").alias("at"))
    sink, ck = scratch_path(spark, "stream-dedupe"), scratch_path(spark, "ck-stream-dedupe")
    _run(X.dedupe_stream(rows, ["contract", "tradetime"], "at", "3650 days", sink, ck))
    return spark.read.parquet(sink).withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("stream_task_state", ["task_events_like"], TASK_STATE_SQL)
def q_stream_task_state(spark, sf_dir):
    """Live task state from the event stream (update mode, upserted)."""
    X.use_rocksdb_state(spark)
    events = fx.task_events_like(spark, sf_dir, src=fx.table_stream(spark, sf_dir, "events"))
    table, ck = KeyedTable(spark, scratch_path(spark, "stream-task-state"), ["task_id"]), scratch_path(spark, "ck-stream-task-state")
    _run(X.task_state_stream(events, table, ck))
    return table.read()


@query("stream_task_state_batches", ["task_events_like"], TASK_STATE_SQL)
def q_stream_task_state_batches(spark, sf_dir):
    """X4 over four loads of events, in event order: each batch writes the tasks it changed."""
    X.use_rocksdb_state(spark)
    events, land, ck = fx.task_events_like(spark, sf_dir), scratch_path(spark, "landing-events"), scratch_path(spark, "ck-task-batches")
    table = KeyedTable(spark, scratch_path(spark, "task-state"), ["task_id"])
    last = events.agg(F.max("seq")).first()[0] or 0
    for n in range(4):
        events.where(F.floor(F.col("seq") * 4 / (last + 1)) == n).write.parquet(f"{land}/{n}")
        _run(X.task_state_stream(spark.readStream.schema(events.schema).parquet(f"{land}/*"), table, ck))
    return table.read()


STREAM_UPSERT_SQL = """
, rows_ as (select r.*, c.underlying_symbol, c.exp_date, c.option_type, c.strike
            from eod_raw_like r join contracts_like c on c.contract = r.contract),
f as (select contract, tradetime, underlying_symbol, exp_date, option_type, strike, volume from (
          select *, row_number() over (partition by contract, tradetime order by seq) as rn from rows_) x where rn = 1),
l as (select contract, tradetime, bid, ask, volatility, delta, fetched_at from (
          select *, row_number() over (partition by contract, tradetime order by seq desc) as rn from rows_) x where rn = 1),
j as (select contract, tradetime, raw_json from (
          select *, row_number() over (partition by contract, tradetime order by seq desc) as rn
          from rows_ where raw_json is not null) x where rn = 1)
select f.contract, f.tradetime, f.underlying_symbol, f.exp_date, f.option_type, f.strike, f.volume,
       l.bid, l.ask, l.volatility, l.delta, l.fetched_at, j.raw_json
from f join l on l.contract = f.contract and l.tradetime = f.tradetime
left join j on j.contract = f.contract and j.tradetime = f.tradetime
"""


@query("stream_upsert", ["eod_raw_like", "contracts_like"], STREAM_UPSERT_SQL)
def q_stream_upsert(spark, sf_dir):
    """Quote rows streamed into the partitioned end-of-day table, each
    micro-batch folded with the W1 upsert (touched months rewritten)."""
    c = fx.contracts_like(spark, sf_dir).select("contract", "underlying_symbol", "exp_date", "option_type", "strike")
    raw = fx.eod_raw_like(spark, sf_dir, src=fx.table_stream(spark, sf_dir, "lineitem")).select(
        "contract", "tradetime", "bid", "ask", "volatility", "delta", "fetched_at", "raw_json", "volume", "seq")
    staged = raw.join(c, "contract")
    store = TableStore(spark, scratch_path(spark, "store"))
    ck = scratch_path(spark, "ck-stream-upsert")
    _run(X.upsert_stream(staged, store, ck))
    t = store.read("option_eod")
    return t.select("contract", F.to_date("tradetime").alias("tradetime"), "underlying_symbol", "exp_date",
                    "option_type", "strike", "volume", "bid", "ask", "volatility", "delta",
                    F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"), "raw_json")


@query("stream_landing", ["contracts_like"], """
select contract, underlying_symbol, exp_date, option_type, strike, exchange from contracts_like
""")
def q_stream_landing(spark, sf_dir):
    """Vendor pages landed as files (one page per line), picked up by a
    file stream and normalised with the batch normaliser."""
    from optlake.plans import landing

    land = scratch_path(spark, "landing")
    landing.contract_pages(spark, sf_dir).select("page_text").write.mode("overwrite").text(land)
    rows = X.landing_stream(spark, f"{land}/*.txt", "contracts", one_page_per_file=False)
    sink, ck = scratch_path(spark, "stream-landing"), scratch_path(spark, "ck-stream-landing")
    q = rows.select("contract", "underlying_symbol", "exp_date", "option_type", "strike", "exchange") \
        .writeStream.format("parquet").outputMode("append").option("path", sink)
    _run(X._start(q, ck, True))
    return spark.read.parquet(sink)


@query("stream_upsert_loads", ["eod_raw_like", "contracts_like"], STREAM_UPSERT_SQL)
def q_stream_upsert_loads(spark, sf_dir):
    """X2 over two loads: the held rows land and stream into the table
    first, the fresh rows later; the second run folds them with the held
    months of the table (pruned read, staged copy, dynamic overwrite)."""
    c = fx.contracts_like(spark, sf_dir).select("contract", "underlying_symbol", "exp_date", "option_type", "strike")
    raw = fx.eod_raw_like(spark, sf_dir).select(
        "contract", "tradetime", "bid", "ask", "volatility", "delta", "fetched_at", "raw_json", "volume", "seq",
        "load_side")
    land = scratch_path(spark, "landing-eod")
    raw.join(c, "contract").write.partitionBy("load_side").parquet(land)
    store = TableStore(spark, scratch_path(spark, "store"))
    for side in ("O", "F"):
        folder = f"{land}/load_side={side}"
        src = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
        _run(X.upsert_stream(src, store, scratch_path(spark, f"ck-upsert-{side}")))
    t = store.read("option_eod")
    return t.select("contract", F.to_date("tradetime").alias("tradetime"), "underlying_symbol", "exp_date",
                    "option_type", "strike", "volume", "bid", "ask", "volatility", "delta",
                    F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"), "raw_json")


@query("stream_upsert_deltas", ["eod_raw_like", "contracts_like"], STREAM_UPSERT_SQL)
def q_stream_upsert_deltas(spark, sf_dir):
    """X2 over two loads into a keyed table: each load is folded once and kept as a delta, held rows are not rewritten."""
    c = fx.contracts_like(spark, sf_dir).select("contract", "underlying_symbol", "exp_date", "option_type", "strike")
    raw = fx.eod_raw_like(spark, sf_dir).select(
        "contract", "tradetime", "bid", "ask", "volatility", "delta", "fetched_at", "raw_json", "volume", "seq", "load_side")
    land, ck = scratch_path(spark, "landing-eod"), scratch_path(spark, "ck-upsert-deltas")
    rows = raw.join(c, "contract")
    table = X.eod_table(spark, scratch_path(spark, "eod-deltas"))
    for side in ("O", "F"):
        part = rows.where(F.col("load_side") == side).drop("load_side")
        part.write.parquet(f"{land}/{side}")
        _run(X.upsert_delta_stream(spark.readStream.schema(part.schema).parquet(f"{land}/*"), table, ck))
    return table.read().select("contract", "tradetime", "underlying_symbol", "exp_date", "option_type", "strike", "volume", "bid",
                               "ask", "volatility", "delta", F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"), "raw_json")
