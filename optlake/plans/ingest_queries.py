"""Driver queries: landed pages -> records -> typed rows (the oracle is the
flat table the pages were built from)."""

from __future__ import annotations

from pyspark.sql import functions as F

from optlake.operators.normalize import normalize_bars, normalize_contracts, normalize_eod, normalize_symbols
from optlake.plans import fixtures as fx
from optlake.plans import landing
from optlake.plans.registry import query
from optlake.sources.pages import page_records, parse_pages


def _records(pages):
    return page_records(parse_pages(pages.drop("shape")))


@query("explode_pages", [], """
with x as (select concat('O:', lpad(cast(p_partkey as varchar), 8, '0')) as contract, p_partkey, p_partkey % 3 as shape,
               case when p_partkey % 3 = 1 then concat('c1-', p_partkey)
                    else concat('c', p_partkey % 3, '-', p_partkey // 300) end as page_id
        from part)
select page_id, cast(row_number() over (partition by page_id order by p_partkey) - 1 as integer) as pos,
       case shape when 0 then 'results' when 1 then 'result' else 'data' end as kind, contract
from x
""")
def q_explode_pages(spark, sf_dir):
    """Records of every page ('results' list / single object / legacy 'data')."""
    recs = _records(landing.contract_pages(spark, sf_dir))
    return normalize_contracts(recs, keep=["page_id", "pos", "kind"]).select("page_id", "pos", "kind", "contract")


@query("normalize_contracts", ["contracts_like"], """
select contract, underlying_symbol, exp_date, option_type, strike, exchange from contracts_like
""")
def q_normalize_contracts(spark, sf_dir):
    """N1+N4: flat and legacy contract records -> contract rows."""
    recs = _records(landing.contract_pages(spark, sf_dir))
    return normalize_contracts(recs).select("contract", "underlying_symbol", "exp_date", "option_type", "strike", "exchange")


@query("normalize_chain", ["eod_raw_like", "contracts_like"], """
select e.contract, cast(e.tradetime as timestamp) as tradetime, c.underlying_symbol, c.exp_date, c.option_type,
       c.strike, e.bid, e.ask, e.volatility, e.delta, e.volume, e.fetched_at as bid_date
from eod_raw_like e join contracts_like c on c.contract = e.contract
""")
def q_normalize_chain(spark, sf_dir):
    """N2+N4+N7: chain snapshot and legacy records -> end-of-day rows."""
    recs = _records(landing.chain_pages(spark, sf_dir))
    rows = normalize_eod(recs, columns=["contract", "tradetime", "underlying_symbol", "exp_date", "option_type",
                                        "strike", "bid", "ask", "volatility", "delta", "volume", "bid_date"])
    return rows.select(
        "contract", F.col("tradetime").cast("timestamp_ntz").alias("tradetime"), "underlying_symbol", "exp_date",
        "option_type", "strike", "bid", "ask", "volatility", "delta", "volume",
        F.col("bid_date").cast("timestamp_ntz").alias("bid_date"))


@query("normalize_bars", ["ticks_like"], """
select case when event_id % 7 = 0 then concat('X:', contract) else contract end as contract,
       make_timestamp((epoch_us(t) // 1000) * 1000) as tradetime, price as open, price as high, price as low, price as last,
       cast(size as double) as volume, price as vwap
from ticks_like
""")
def q_normalize_bars(spark, sf_dir):
    """N3+S2: bar records; the page ticker stamps records without one."""
    recs = _records(landing.bar_pages(spark, sf_dir))
    rows = normalize_bars(recs)
    return rows.select("contract", F.col("tradetime").cast("timestamp_ntz").alias("tradetime"),
                       "open", "high", "low", "last", "volume", "vwap")


@query("normalize_symbols", [], """
select p_brand as underlying_symbol, case when p_partkey % 2 = 1 then 'stocks' end as market,
       case when p_partkey % 2 = 1 then p_size % 2 = 0 end as active
from part
""")
def q_normalize_symbols(spark, sf_dir):
    """Bare symbol strings (legacy list) and ticker objects."""
    recs = _records(landing.symbol_pages(spark, sf_dir))
    return normalize_symbols(recs).select("underlying_symbol", "market", "active")


@query("flatfile_roundtrip", ["ticks_like"], """
select contract, t, price, size, event_id, cast(t as date) as file_date from ticks_like
""")
def q_flatfile_roundtrip(spark, sf_dir):
    """Trades written as daily .csv.gz files, read back with a fixed
    schema; the file date comes from the path."""
    from optlake.session import scratch_path
    from optlake.sources.flatfiles import read_daily_csv, write_daily_csv

    ticks = fx.ticks_like(spark, sf_dir)
    root = scratch_path(spark, "flat")
    write_daily_csv(ticks, root, "t")
    back = read_daily_csv(spark, f"{root}/day=*/*.csv.gz", ticks.schema)
    return back.select("contract", "t", "price", "size", "event_id", "file_date")


def _mixed_files(spark, sf_dir):
    """Trades by day, with four headers: as agreed, reordered, with a column more, with one less (by day of the month)."""
    from optlake.session import scratch_path
    from optlake.sources.flatfiles import write_daily_csv

    ticks = fx.ticks_like(spark, sf_dir).withColumn("turn", F.dayofmonth("t") % 4)
    cols, root = ["contract", "t", "price", "size", "event_id"], scratch_path(spark, "mixed")
    shapes = [cols, cols[::-1], [*cols, "venue"], cols[:-1]]
    for n, shape in enumerate(shapes):
        part = ticks.where(F.col("turn") == n).withColumn("venue", F.lit("X")).withColumn("at", F.col("t")).select(*shape, "at")
        write_daily_csv(part, f"{root}/{n}", "at", drop=["at"])
    return f"{root}/*/day=*/*.csv.gz"


@query("flatfile_mixed", ["ticks_like"], """
select contract, t, price, size, event_id, cast(t as date) as file_date from ticks_like where day(t) % 4 < 2
""")
def q_flatfile_mixed(spark, sf_dir):
    """Files whose headers differ, columns mapped by name; files with unknown or missing columns are kept out."""
    from optlake.sources.flatfiles import read_reconciled_csv

    schema = fx.ticks_like(spark, sf_dir).schema
    return read_reconciled_csv(spark, _mixed_files(spark, sf_dir), schema)[0].select("contract", "t", "price", "size", "event_id", "file_date")


@query("flatfile_quarantine", ["ticks_like"], """
select distinct cast(t as date) as file_date,
       case day(t) % 4 when 2 then 'unknown column venue' else 'missing column event_id' end as reason
from ticks_like where day(t) % 4 >= 2
""")
def q_flatfile_quarantine(spark, sf_dir):
    """The days whose files were kept out, and why."""
    from optlake.sources.flatfiles import read_reconciled_csv

    schema = fx.ticks_like(spark, sf_dir).schema
    bad = read_reconciled_csv(spark, _mixed_files(spark, sf_dir), schema)[1]
    return bad.select("file_date", F.concat_ws(", ", "reasons").alias("reason")).distinct()


@query("file_inventory", ["ticks_like"], """
select cast(cast(t as date) as varchar) as day, true as listed from ticks_like group by 1
""")
def q_file_inventory(spark, sf_dir):
    """The daily trade files of a landing prefix, by day (no file bodies read)."""
    from optlake.session import scratch_path
    from optlake.sources.flatfiles import file_inventory, folder_summary, write_daily_csv

    root = scratch_path(spark, "inventory")
    write_daily_csv(fx.ticks_like(spark, sf_dir), root, "t")
    days = folder_summary(file_inventory(spark, f"{root}/day=*/*.csv.gz"))
    return days.select(F.regexp_extract("folder", "day=(.*)$", 1).alias("day"), (F.col("bytes") > 0).alias("listed"))


@query("flatfile_bars", ["ticks_like"], """
, b as (select contract, date_trunc('minute', t) as bar, price, size, struct_pack(t := t, e := event_id, p := price) as o from ticks_like)
select contract, cast(bar as timestamp) as tradetime, min(o).p as open, max(price) as high, min(price) as low, max(o).p as last,
       cast(sum(size) as double) as volume
from b group by contract, bar
""")
def q_flatfile_bars(spark, sf_dir):
    """Daily minute-aggregate files read with their fixed schema and merged into the bars table, a rerun included."""
    from optlake.operators.bars import ticks_to_bars
    from optlake.session import scratch_path
    from optlake.sources.flatfiles import read_minute_aggregates, write_daily_csv
    from optlake.sources.store import TableStore

    bars = ticks_to_bars(fx.ticks_like(spark, sf_dir), "1 minute")
    files = bars.select(F.col("contract").alias("ticker"), "volume", "open", F.col("last").alias("close"), "high", "low",
                        (F.unix_micros(F.col("tradetime").cast("timestamp")) * 1000).alias("window_start"),
                        F.col("trades").alias("transactions"), "tradetime")
    root = scratch_path(spark, "minutes")
    write_daily_csv(files, root, "tradetime", drop=["tradetime"])
    store = TableStore(spark, scratch_path(spark, "minute-store"))
    for pattern in ("day=*", "day=*-01"):  # all days, then some again
        store.upsert_bars(read_minute_aggregates(spark, f"{root}/{pattern}/*.csv.gz"))
    return store.read("bars").select("contract", F.col("tradetime").cast("timestamp_ntz").alias("tradetime"),
                                     "open", "high", "low", "last", "volume")


@query("page_files", ["contracts_like"], """
select contract, underlying_symbol, exp_date, option_type, strike, exchange from contracts_like
""")
def q_page_files(spark, sf_dir):
    """S3: pages of every shape landed as one JSON file each, read back as whole texts."""
    from optlake.session import scratch_path
    from optlake.sources.pages import read_page_files

    root = scratch_path(spark, "page-files")
    landing.land_page_files(landing.contract_pages(spark, sf_dir), root)
    recs = page_records(parse_pages(read_page_files(spark, root)))
    return normalize_contracts(recs).select("contract", "underlying_symbol", "exp_date", "option_type", "strike", "exchange")


@query("page_chains", [], """
, paged as (select p_type as symbol, p_partkey // 100 as k from part group by all),
linked as (
  select *, concat('https://api.example/contracts?underlying=', symbol, '&cursor=', md5(concat(symbol, '|', k))) as url from paged),
links as (
  select symbol, k, url, coalesce(lead(url) over w, case when symbol like '%COPPER' then first(url) over w end) as next
  from linked window w as (partition by symbol order by k)),
landed as (select url, next from links where not (symbol like 'PROMO%' and k % 11 = 5)),
prev as (select next as url, min(url) as before from landed where next is not null group by next),
walk(url, chain, pos) as (
  select url, url, cast(0 as bigint) from landed where url not in (select url from prev)
  union all
  select l.url, w.chain, w.pos + 1 from walk w join prev p on p.before = w.url join landed l on l.url = p.url),
tails as (
  select w.chain, w.pos + 1 as pages,
         case when l.next is null then 'complete' when l.next in (select url from landed) then 'forked' else 'broken' end as status
  from walk w join landed l on l.url = w.url
  where w.pos = (select max(pos) from walk x where x.chain = w.chain))
select l.url, w.chain, w.pos, coalesce(t.pages, 1) as pages, coalesce(t.status, 'cycle') as status
from landed l left join walk w on w.url = l.url left join tails t on t.chain = w.chain
""".replace(", paged", "with recursive paged", 1))
def q_page_chains(spark, sf_dir):
    """S3: landed pages of every query in link order, with broken chains and cycles told apart."""
    from optlake.operators.page_chains import page_positions
    from optlake.sources.pages import next_link

    pages = parse_pages(landing.linked_pages(spark, sf_dir))
    return page_positions(pages.select("url", next_link(F.col("payload")).alias("next_url")))


@query("generic_values", [], """
select case when p_partkey % 2 = 0 then p_brand end as value, case when p_partkey % 2 = 0 then 'value' else 'fields' end as kind,
       case when p_partkey % 2 = 1 then p_brand end as ticker
from part
""")
def q_generic_values(spark, sf_dir):
    """Records of an endpoint without a normaliser, mixed shapes: scalars become ``value`` rows, objects keep their
    fields as text; every row has a row key."""
    from optlake.operators.normalize import normalize

    rows = normalize(_records(landing.symbol_pages(spark, sf_dir)), "some-endpoint")
    keyed = rows.where(F.length("row_key") == 40)
    return keyed.select("value", F.when(F.col("value").isNotNull(), "value").otherwise("fields").alias("kind"),
                        F.get_json_object("record_json", "$.ticker").alias("ticker"))


@query("row_keys", ["eod_raw_like", "contracts_like"], """
select e.contract, e.tradetime, e.tradetime as event_date, count(*) as n
from eod_raw_like e join contracts_like c on c.contract = e.contract group by all
""")
def q_row_keys(spark, sf_dir):
    """N8+N9: typed composite key and event date of every normalised quote row."""
    from optlake.operators.normalize import row_key

    rows = normalize_eod(_records(landing.chain_pages(spark, sf_dir)), columns=["contract", "tradetime"])
    keyed = rows.select(row_key(rows, "eod").alias("key"), "event_date")
    return keyed.groupBy("key.contract", "key.tradetime", "event_date").agg(F.count("*").alias("n"))
