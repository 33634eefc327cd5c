"""Driver queries: keep-last, merge by name, EOD upsert, change labels,
contract and symbol refreshes."""

from __future__ import annotations

from pyspark.sql import functions as F

from optlake.operators.merge import change_labels, contracts_seen, keep_last, merge_keep_last, symbol_universe, upsert_eod
from optlake.plans import fixtures as fx
from optlake.plans.registry import query


@query("keep_last", ["held_eod"], """
select contract, tradetime, bid, ask, volatility, delta, raw_json from held_eod
""")
def q_keep_last(spark, sf_dir):
    """One row per (contract, tradetime), the highest seq wins."""
    raw = fx.eod_raw_like(spark, sf_dir).select("contract", "tradetime", "bid", "ask", "volatility", "delta", "raw_json", "seq")
    return keep_last(raw, ["contract", "tradetime"])


@query("merge_by_name", ["eod_raw_like"], """
, u as (
  select contract, tradetime, bid, ask, volatility, cast(null as varchar) as raw_json, cast(null as double) as delta,
         0 as side, seq
  from eod_raw_like where load_side = 'O'
  union all
  select contract, tradetime, bid, cast(null as double) as ask, cast(null as double) as volatility, raw_json, delta,
         1 as side, seq
  from eod_raw_like where load_side = 'F')
select contract, tradetime, bid, ask, volatility, raw_json, delta from (
  select *, row_number() over (partition by contract, tradetime order by side desc, seq desc) as rn from u) x
where rn = 1
""")
def q_merge_by_name(spark, sf_dir):
    """U1+U2: held and fresh rows with different column sets, aligned by name."""
    raw = fx.eod_raw_like(spark, sf_dir)
    held = raw.where(F.col("load_side") == "O").select("contract", "tradetime", "bid", "ask", "volatility", "seq")
    fresh = raw.where(F.col("load_side") == "F").select("seq", "raw_json", "delta", "tradetime", "contract", "bid")
    return merge_keep_last(held, fresh, ["contract", "tradetime"]).select(
        "contract", "tradetime", "bid", "ask", "volatility", "raw_json", "delta")


def _eod_rows(spark, sf_dir):
    """Quote rows with their contract identity, as an ingest would stage them."""
    c = fx.contracts_like(spark, sf_dir).select("contract", "underlying_symbol", "exp_date", "option_type", "strike")
    r = fx.eod_raw_like(spark, sf_dir).select(
        "contract", "tradetime", "bid", "ask", "volatility", "delta", "fetched_at", "raw_json", "src_id", "volume",
        "load_side", "seq")
    return r.join(c, "contract")


UPSERT_OUT = ["contract", "tradetime", "underlying_symbol", "exp_date", "option_type", "strike", "src_id", "volume",
              "bid", "ask", "volatility", "delta", "fetched_at", "raw_json"]

_EOD_ROWS_SQL = """
, rows_ as (select r.*, c.underlying_symbol, c.exp_date, c.option_type, c.strike
            from eod_raw_like r join contracts_like c on c.contract = r.contract)
"""


@query("upsert_eod", ["eod_raw_like", "contracts_like"], _EOD_ROWS_SQL + """
, f as (select contract, tradetime, underlying_symbol, exp_date, option_type, strike, src_id, volume from (
          select *, row_number() over (partition by contract, tradetime order by seq) as rn from rows_) x where rn = 1),
l as (select contract, tradetime, bid, ask, volatility, delta, fetched_at from (
          select *, row_number() over (partition by contract, tradetime order by seq desc) as rn from rows_) x where rn = 1),
j as (select contract, tradetime, raw_json from (
          select *, row_number() over (partition by contract, tradetime order by seq desc) as rn
          from rows_ where raw_json is not null) x where rn = 1)
select f.contract, f.tradetime, f.underlying_symbol, f.exp_date, f.option_type, f.strike, f.src_id, f.volume,
       l.bid, l.ask, l.volatility, l.delta, l.fetched_at, j.raw_json
from f join l on l.contract = f.contract and l.tradetime = f.tradetime
left join j on j.contract = f.contract and j.tradetime = f.tradetime
""")
def q_upsert_eod(spark, sf_dir):
    """Held rows ('O') + staged rows ('F'): identity and unwritten columns
    from the first row, quotes from the last (NULLs overwrite), raw_json the
    last non-NULL."""
    rows = _eod_rows(spark, sf_dir)
    held = rows.where(F.col("load_side") == "O").drop("load_side")
    staged = rows.where(F.col("load_side") == "F").drop("load_side")
    return upsert_eod(held, staged, seq="seq").select(*UPSERT_OUT)


@query("upsert_changes", ["eod_raw_like", "contracts_like"], _EOD_ROWS_SQL + """
, b as (select contract, tradetime, bid, ask, volatility, delta from (
          select *, row_number() over (partition by contract, tradetime order by seq desc) as rn
          from rows_ where load_side = 'O') x where rn = 1),
braw as (select contract, tradetime, raw_json from (
          select *, row_number() over (partition by contract, tradetime order by seq desc) as rn
          from rows_ where load_side = 'O' and raw_json is not null) x where rn = 1),
a as (select contract, tradetime, bid, ask, volatility, delta from (
          select *, row_number() over (partition by contract, tradetime order by seq desc) as rn from rows_) x where rn = 1),
araw as (select contract, tradetime, raw_json from (
          select *, row_number() over (partition by contract, tradetime order by seq desc) as rn
          from rows_ where raw_json is not null) x where rn = 1),
touched as (select distinct contract, tradetime from rows_ where load_side = 'F'),
held_keys as (select distinct contract, tradetime from rows_ where load_side = 'O')
select t.contract, t.tradetime,
       case when hk.contract is null then 'inserted'
            when b.bid is not distinct from a.bid and b.ask is not distinct from a.ask
             and b.volatility is not distinct from a.volatility and b.delta is not distinct from a.delta
             and braw.raw_json is not distinct from araw.raw_json then 'unchanged'
            else 'updated' end as change
from touched t
left join held_keys hk on hk.contract = t.contract and hk.tradetime = t.tradetime
left join b on b.contract = t.contract and b.tradetime = t.tradetime
left join braw on braw.contract = t.contract and braw.tradetime = t.tradetime
left join a on a.contract = t.contract and a.tradetime = t.tradetime
left join araw on araw.contract = t.contract and araw.tradetime = t.tradetime
""")
def q_upsert_changes(spark, sf_dir):
    """Inserted / updated / unchanged per key touched by the staged rows."""
    rows = _eod_rows(spark, sf_dir)
    held = rows.where(F.col("load_side") == "O").drop("load_side")
    staged = rows.where(F.col("load_side") == "F").drop("load_side")
    return change_labels(held.drop("fetched_at"), staged.drop("fetched_at"), seq="seq")


@query("contracts_seen", ["eod_raw_like", "contracts_like"], _EOD_ROWS_SQL + """
, seen as (select contract, min(tradetime) as first_seen_at, max(tradetime) as last_seen_at from rows_ group by contract),
ident as (select contract, underlying_symbol, exp_date, option_type, strike from (
          select *, row_number() over (partition by contract order by tradetime desc, seq desc) as rn from rows_) x
          where rn = 1),
raw as (select contract, raw_json from (
          select *, row_number() over (partition by contract order by tradetime desc, seq desc) as rn
          from rows_ where raw_json is not null) x where rn = 1)
select s.contract, i.underlying_symbol, i.exp_date, i.option_type, i.strike, s.first_seen_at, s.last_seen_at, r.raw_json
from seen s join ident i on i.contract = s.contract left join raw r on r.contract = s.contract
""")
def q_contracts_seen(spark, sf_dir):
    """Contracts refresh from end-of-day sightings."""
    obs = _eod_rows(spark, sf_dir).select(
        "contract", "underlying_symbol", "exp_date", "option_type", "strike", "raw_json",
        F.col("tradetime").alias("seen_at"), F.struct("tradetime", "seq").alias("seq"))
    return contracts_seen(obs, seen="seen_at", seq="seq")


@query("symbol_universe", ["eod_raw_like", "contracts_like"], _EOD_ROWS_SQL + """
select underlying_symbol, min(fetched_at) as first_fetched_at, max(fetched_at) as fetched_at
from rows_ group by underlying_symbol
""")
def q_symbol_universe(spark, sf_dir):
    """Underlying symbols with first and latest fetch time."""
    return symbol_universe(_eod_rows(spark, sf_dir).select("underlying_symbol", "fetched_at"))


@query("store_eod_slice", ["eod_raw_like", "contracts_like"], _EOD_ROWS_SQL + """
, f as (select contract, tradetime, underlying_symbol, option_type, strike from (
          select *, row_number() over (partition by contract, tradetime order by seq) as rn from rows_) x where rn = 1),
l as (select contract, tradetime, bid, ask from (
          select *, row_number() over (partition by contract, tradetime order by seq desc) as rn from rows_) x where rn = 1)
select f.contract, f.tradetime, f.strike, l.bid, l.ask
from f join l on l.contract = f.contract and l.tradetime = f.tradetime
where f.underlying_symbol = 'PROMO' and f.option_type = 'put' and f.strike >= 930 and f.strike <= 970
  and f.tradetime >= date '1995-01-01' and f.tradetime <= date '1996-06-30'
""")
def q_store_eod_slice(spark, sf_dir):
    """S4-S6 + API: quote rows upserted into the partitioned end-of-day
    table, then a filtered read (trade months pruned, filters pushed)."""
    from optlake import api
    from optlake.session import scratch_path
    from optlake.sources.store import TableStore

    store = TableStore(spark, scratch_path(spark, "store"))
    store.upsert_eod(_eod_rows(spark, sf_dir).drop("load_side", "src_id"))
    out = api.eod(store, underlying_symbol="PROMO", option_type="put", strike_from=930, strike_to=970,
                  tradetime_from="1995-01-01", tradetime_to="1996-06-30", fields="contract,tradetime,strike,bid,ask")
    return out.withColumn("tradetime", F.to_date("tradetime"))


@query("store_eod_clustered", ["eod_raw_like", "contracts_like"], _EOD_ROWS_SQL + """
, f as (select contract, tradetime, exp_date, strike from (
          select *, row_number() over (partition by contract, tradetime order by seq) as rn from rows_) x where rn = 1),
l as (select contract, tradetime, bid from (
          select *, row_number() over (partition by contract, tradetime order by seq desc) as rn from rows_) x where rn = 1),
t as (select f.*, l.bid from f join l on l.contract = f.contract and l.tradetime = f.tradetime)
select 'strikes' as asked, contract, tradetime, exp_date, strike, bid from t where strike >= 930 and strike <= 970
union all select 'history', contract, tradetime, exp_date, strike, bid from t where contract >= 'O:00000100' and contract < 'O:00000120'
union all select 'expiry', contract, tradetime, exp_date, strike, bid from t where exp_date = date '2002-04-18' and tradetime < date '1994-01-01'
""")
def q_store_eod_clustered(spark, sf_dir):
    """The end-of-day table rewritten along a curve over contract, expiry, strike and trade date; a chain slice,
    a contract history and an expiry read each prune files and give the same rows."""
    from optlake.session import list_folders, scratch_path
    from optlake.sources.store import TableStore

    store = TableStore(spark, scratch_path(spark, "store"))
    store.upsert_eod(_eod_rows(spark, sf_dir).drop("load_side", "src_id"))
    months = [f.split("=", 1)[1] for f in list_folders(spark, store.path("option_eod")) if f.startswith("trade_month=")]
    store.cluster("option_eod", months, ["contract", "exp_date", "strike", "tradetime"], files=2 * len(months))
    t = store.read("option_eod")
    asked = {"strikes": (F.col("strike") >= 930) & (F.col("strike") <= 970),
             "history": (F.col("contract") >= "O:00000100") & (F.col("contract") < "O:00000120"),
             "expiry": (F.col("exp_date") == F.lit("2002-04-18").cast("date")) & (F.col("tradetime") < F.lit("1994-01-01").cast("date"))}
    out = [t.where(how).select(F.lit(name).alias("asked"), "contract", F.to_date("tradetime").alias("tradetime"), "exp_date", "strike", "bid")
           for name, how in asked.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


def _snapshots(spark, sf_dir):
    """Quote snapshots at times of day, several a day for one contract."""
    c = fx.contracts_like(spark, sf_dir, with_part_key=True).select(
        "p_partkey", "contract", "underlying_symbol", "exp_date", "option_type", "strike")
    li = fx.table(spark, sf_dir, "lineitem")
    ts = F.timestamp_seconds(F.unix_date(F.to_date("l_shipdate")).cast("long") * 86400 + F.col("l_linenumber") * 3600)
    return li.join(c, li.l_partkey == c.p_partkey).select(
        "contract", "underlying_symbol", "exp_date", "option_type", "strike", ts.alias("tradetime"),
        F.col("l_extendedprice").alias("bid"), (F.col("l_extendedprice") + F.col("l_quantity")).alias("ask"),
        F.col("l_shipdate").cast("timestamp").alias("fetched_at"), "l_linestatus", "l_returnflag", "l_linenumber",
        F.struct(ts.alias("ts"), "l_orderkey", "l_linenumber", "l_suppkey").alias("seq"))


def _new_store(spark, label: str):
    from optlake.session import scratch_path
    from optlake.sources.store import TableStore

    return TableStore(spark, scratch_path(spark, label))


_SNAPSHOT_SQL = """
, snaps as (
  select c.contract, cast(l_shipdate as date) as tradetime, l_extendedprice as bid, l_extendedprice + l_quantity as ask,
         l_linestatus, l_returnflag, l_linenumber, l_orderkey, l_suppkey
  from lineitem join contracts_like c on c.contract = concat('O:', lpad(cast(l_partkey as varchar), 8, '0')))
"""


@query("upsert_same_day", ["contracts_like"], _SNAPSHOT_SQL + """
select contract, tradetime, bid, ask from (
  select *, row_number() over (partition by contract, tradetime
                               order by l_linestatus, l_linenumber desc, l_orderkey desc, l_suppkey desc) as rn from snaps) x
where rn = 1
""")
def q_upsert_same_day(spark, sf_dir):
    """W1 into the store in two loads, keyed by trade DATE: snapshots of one day are one row with the newest quote."""
    rows, store = _snapshots(spark, sf_dir), _new_store(spark, "same-day")
    for side in ("O", "F"):
        store.upsert_eod(rows.where(F.col("l_linestatus") == side).drop("l_linestatus", "l_returnflag", "l_linenumber"))
    return store.read("option_eod").select("contract", "tradetime", "bid", "ask")


@query("upsert_quarantine", ["contracts_like"], _SNAPSHOT_SQL + """
select 'held' as kind, count(*) as n from (
  select distinct contract, tradetime from snaps where l_linestatus = 'O' or (l_returnflag <> 'R' and l_linenumber < 6)) x
union all
select case when l_returnflag = 'R' and l_linenumber >= 6 then 'contract is null,tradetime is null'
            when l_returnflag = 'R' then 'contract is null' else 'tradetime is null' end as kind, count(*) as n
from snaps where l_linestatus = 'F' and (l_returnflag = 'R' or l_linenumber >= 6) group by 1
""")
def q_upsert_quarantine(spark, sf_dir):
    """V1 in front of W1: rows with a NULL key part go to quarantine with reasons, held rows stay."""
    rows, store = _snapshots(spark, sf_dir), _new_store(spark, "quarantine")
    store.upsert_eod(rows.where("l_linestatus = 'O'").drop("l_linestatus", "l_returnflag", "l_linenumber"))
    bad = rows.where("l_linestatus = 'F'") \
        .withColumn("contract", F.when(F.col("l_returnflag") != "R", F.col("contract"))) \
        .withColumn("tradetime", F.when(F.col("l_linenumber") < 6, F.col("tradetime")))
    store.upsert_eod(bad.drop("l_linestatus", "l_returnflag", "l_linenumber"))
    kept = store.read("option_eod").agg(F.lit("held").alias("kind"), F.count("*").alias("n"))
    out = store.quarantine("option_eod")
    return kept if out is None else kept.unionByName(
        out.groupBy(F.array_join("reasons", ",").alias("kind")).agg(F.count("*").alias("n")))


@query("store_bars_merge", ["ticks_like"], """
, b as (select *, time_bucket(interval '1 hour', t) as bar from ticks_like),
h as (select contract, bar, max(price) as high, min(price) as low, cast(sum(size) as double) as volume from b group by contract, bar)
select contract, cast(bar as timestamp) as tradetime,
       case when contract in ('view', 'click') and hour(bar) < 12 then high * 2 else high end as high, low, volume from h
""")
def q_store_bars_merge(spark, sf_dir):
    """Bars merged into the store in two loads: fresh bars win, other contracts' and hours' held bars stay."""
    from optlake.operators.bars import ticks_to_bars

    bars = ticks_to_bars(fx.ticks_like(spark, sf_dir), "1 hour").drop("notional", "trades").withColumn("seq", F.lit(1))
    store = _new_store(spark, "bars")
    store.upsert_bars(bars)
    fresh = bars.where(F.col("contract").isin("view", "click") & (F.hour("tradetime") < 12))
    store.upsert_bars(fresh.withColumn("high", F.col("high") * 2))
    return store.read("bars").select("contract", "tradetime", "high", "low", "volume")


@query("store_contracts_merge", ["contracts_like", "eod_raw_like"], _EOD_ROWS_SQL + """
, s as (select contract, min(tradetime) as lo, max(tradetime) as hi from rows_ group by contract)
select c.contract, c.underlying_symbol, c.strike, c.exchange,
       least(date '1994-01-01', coalesce(s.lo, date '1994-01-01')) as first_seen, greatest(date '1994-01-01', coalesce(s.hi, date '1994-01-01')) as last_seen
from contracts_like c left join s on s.contract = c.contract
""")
def q_store_contracts_merge(spark, sf_dir):
    """W3 into the store in two loads: sightings without an exchange keep the held one, first and last sighting move."""
    store = _new_store(spark, "contracts")
    listed = fx.contracts_like(spark, sf_dir)
    store.upsert_contracts(listed.withColumn("seen_at", F.lit("1994-01-01").cast("timestamp")).withColumn("seq", F.lit(0)))
    seen = _eod_rows(spark, sf_dir).select("contract", "underlying_symbol", "exp_date", "option_type", "strike",
                                           F.col("tradetime").cast("timestamp").alias("seen_at"), "seq")
    store.upsert_contracts(seen)
    return store.read("contracts").select("contract", "underlying_symbol", "strike", "exchange",
                                          F.to_date("first_seen_at").alias("first_seen"), F.to_date("last_seen_at").alias("last_seen"))


@query("store_symbols_merge", ["contracts_like", "eod_raw_like"], _EOD_ROWS_SQL + """
select underlying_symbol, 'stocks' as market, cast(max(fetched_at) as date) as fetched from rows_ group by 1
""")
def q_store_symbols_merge(spark, sf_dir):
    """W4 into the store in two loads: the latest fetch time; fields a later load lacks stay."""
    store = _new_store(spark, "symbols")
    rows = _eod_rows(spark, sf_dir).select("underlying_symbol", F.col("fetched_at").cast("timestamp").alias("fetched_at"))
    first = rows.groupBy("underlying_symbol").agg(F.min("fetched_at").alias("fetched_at"))
    store.upsert_symbols(first.withColumn("market", F.lit("stocks")).withColumn("active", F.lit(True)))
    store.upsert_symbols(rows)
    return store.read("underlying_symbols").select("underlying_symbol", "market", F.to_date("fetched_at").alias("fetched"))


@query("raw_json_switch", ["contracts_like"], _SNAPSHOT_SQL + """
, n as (select count(*) as n from (select distinct contract, tradetime from snaps) x)
select true as stored, n as rows_, n as with_json from n union all select false, n, 0 from n
""")
def q_raw_json_switch(spark, sf_dir):
    """The same load with and without the vendor's JSON."""
    rows = _snapshots(spark, sf_dir).drop("l_linestatus", "l_returnflag", "l_linenumber").withColumn("raw_json", F.lit("{}"))
    out = None
    for stored in (True, False):
        store = _new_store(spark, "raw-json")
        store.store_raw_json = stored
        held = store.upsert_eod(rows).agg(F.lit(stored).alias("stored"), F.count("*").alias("rows_"), F.count("raw_json").alias("with_json"))
        out = held if out is None else out.unionByName(held)
    return out


@query("file_order", ["ticks_like"], """
select contract, count(distinct time_bucket(interval '1 hour', t)) as bars, cast(0 as bigint) as out_of_order from ticks_like group by contract
""")
def q_file_order(spark, sf_dir):
    """Rows of every file of the bars table stand in (day, contract, time) order."""
    from pyspark.sql import Window

    from optlake.operators.bars import ticks_to_bars

    store = _new_store(spark, "order")
    store.upsert_bars(ticks_to_bars(fx.ticks_like(spark, sf_dir), "1 hour").drop("notional", "trades").withColumn("seq", F.lit(1)))
    here = F.struct("trade_date", "contract", "tradetime")
    rows = store.read("bars").select("contract", here.alias("here"), F.col("_metadata.file_path").alias("file"),
                                     F.col("_metadata.row_index").alias("pos"))
    before = F.lag("here").over(Window.partitionBy("file").orderBy("pos"))
    return (rows.withColumn("wrong", F.coalesce(before > F.col("here"), F.lit(False)))
            .groupBy("contract").agg(F.count("*").alias("bars"), F.count_if("wrong").alias("out_of_order")))
