"""Driver queries: chain slice, nearest put, spread credit, derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from optlake.functions.derived import days_to_expiry, midpoint_fill, vol_oi_ratio
from optlake.operators.filters import FilterSet
from optlake.operators.strategy import CHAIN_KEY, chain_entries, chain_slice, nearest_strike, short_leg, spread_credit
from optlake.plans import fixtures as fx
from optlake.plans.common import chain, held_eod
from optlake.plans.registry import query
from optlake.session import materialize

SLICE = FilterSet(underlying_symbol="PROMO", option_type="put", strike_from=930.0, strike_to=970.0,
                  tradetime_from="1995-01-01", tradetime_to="1996-06-30")


@query("chain_slice", ["chain"], """
select contract, tradetime, underlying_symbol, exp_date, option_type, strike, bid, ask, midpoint
from chain
where underlying_symbol = 'PROMO' and option_type = 'put' and strike >= 930.0 and strike <= 970.0
  and tradetime >= date '1995-01-01' and tradetime <= date '1996-06-30'
""")
def q_chain_slice(spark, sf_dir):
    """one chain slice (underlying, type, strike band, trade-date window)."""
    return chain_slice(chain(spark, sf_dir), SLICE).select(
        "contract", "tradetime", "underlying_symbol", "exp_date", "option_type", "strike", "bid", "ask", "midpoint")


NEAREST_PUT_SQL = """
, cand as (
  select e.underlying_symbol, e.tradetime, e.exp_date, e.spot, 0.9 * e.spot as target,
         c.contract, c.strike, c.midpoint,
         row_number() over (partition by e.underlying_symbol, e.tradetime, e.exp_date
                            order by abs(c.strike - 0.9 * e.spot), c.strike, c.contract) as rn
  from put_entries e join chain c
    on c.underlying_symbol = e.underlying_symbol and c.tradetime = e.tradetime
   and c.exp_date = e.exp_date and c.option_type = 'put')
select underlying_symbol, tradetime, exp_date, spot, target, contract, strike, midpoint from cand where rn = 1
"""


def put_chain(spark, sf_dir):
    """The put chain with the columns the legs need, written once."""
    ch = chain(spark, sf_dir, "put")
    return materialize(ch.select(*CHAIN_KEY, "contract", "strike", "midpoint"), "put-chain")


def nearest_put_df(spark, sf_dir):
    # both branches (entries, legs) read one written copy of the put chain
    ch = put_chain(spark, sf_dir)
    return short_leg(chain_entries(ch, "put"), ch).select(
        "underlying_symbol", "tradetime", "exp_date", "spot", "target", "contract", "strike", "midpoint")


@query("nearest_put", ["put_entries"], NEAREST_PUT_SQL)
def q_nearest_put(spark, sf_dir):
    """G1: per put chain, the put nearest 90 % of the (stand-in) close."""
    return nearest_put_df(spark, sf_dir)


# Shares of a quote row's own strike that make its targets.
TARGET_SHARES = [0.95, 1.0, 1.05]


@query("nearest_put_many", ["eod_raw_like", "chain"], """
, entries as (
  select c.underlying_symbol, e.tradetime, c.exp_date, 'put' as option_type, f.share * c.strike as target
  from eod_raw_like e join contracts_like c on c.contract = e.contract
  cross join (select unnest([0.95::double, 1.0::double, 1.05::double]) as share) f),
points as (select distinct * from entries),
near as (
  select * from (
    select p.*, c.contract, c.strike, c.midpoint,
           row_number() over (partition by p.underlying_symbol, p.tradetime, p.exp_date, p.target
                              order by abs(c.strike - p.target), c.strike, c.contract) as rn
    from points p join chain c on c.underlying_symbol = p.underlying_symbol and c.tradetime = p.tradetime
                              and c.exp_date = p.exp_date and c.option_type = p.option_type) x where rn = 1)
select e.*, n.contract, n.strike, n.midpoint
from entries e join near n on n.underlying_symbol = e.underlying_symbol and n.tradetime = e.tradetime
                          and n.exp_date = e.exp_date and n.target = e.target
""")
def q_nearest_put_many(spark, sf_dir):
    """J5/O4 with many entries a chain: every unmerged quote row asks for the put nearest to its own strike, 5 %
    below and 5 % above; equal entries (several quotes of a contract in a month) stay separate rows."""
    c = fx.contracts_like(spark, sf_dir).select("contract", "underlying_symbol", "exp_date", "strike")
    quotes = fx.eod_raw_like(spark, sf_dir).select("contract", "tradetime").join(c, "contract")
    share = F.explode(F.array(*[F.lit(x) for x in TARGET_SHARES]))
    entries = quotes.withColumn("share", share).select(
        "underlying_symbol", "tradetime", "exp_date", F.lit("put").alias("option_type"), (F.col("share") * F.col("strike")).alias("target"))
    return nearest_strike(entries, put_chain(spark, sf_dir))


@query("spread_credit", ["put_entries"], """
, short_leg as (
  select * from (
    select e.underlying_symbol, e.tradetime, e.exp_date, e.spot,
           c.contract as short_contract, c.strike as short_strike, c.midpoint as short_midpoint,
           row_number() over (partition by e.underlying_symbol, e.tradetime, e.exp_date
                              order by abs(c.strike - 0.9 * e.spot), c.strike, c.contract) as rn
    from put_entries e join chain c
      on c.underlying_symbol = e.underlying_symbol and c.tradetime = e.tradetime
     and c.exp_date = e.exp_date and c.option_type = 'put') x where rn = 1),
long_leg as (
  select * from (
    select s.*, c.contract as long_contract, c.strike as long_strike, c.midpoint as long_midpoint,
           row_number() over (partition by s.underlying_symbol, s.tradetime, s.exp_date
                              order by abs(c.strike - (s.short_strike - 5.0)), c.strike, c.contract) as rn2
    from short_leg s join chain c
      on c.underlying_symbol = s.underlying_symbol and c.tradetime = s.tradetime
     and c.exp_date = s.exp_date and c.option_type = 'put') y where rn2 = 1)
select underlying_symbol, tradetime, exp_date, spot, short_contract, short_strike, short_midpoint,
       short_strike - 5.0 as long_target, long_contract, long_strike, long_midpoint,
       short_midpoint - long_midpoint as credit
from long_leg
""")
def q_spread_credit(spark, sf_dir):
    """G2+G3: long put 5 below the short strike, entry credit per chain."""
    ch = put_chain(spark, sf_dir)  # three consumers: entries, short leg, long leg
    return spread_credit(chain_entries(ch, "put"), ch).select(
        "underlying_symbol", "tradetime", "exp_date", "spot", "short_contract", "short_strike", "short_midpoint",
        "long_target", "long_contract", "long_strike", "long_midpoint", "credit")


@query("derived_columns", ["held_eod", "contracts_like"], """
select h.contract, h.tradetime, cast(datediff('day', h.tradetime, c.exp_date) as integer) as dte,
       case when h.open_interest = 0 then null else h.volume / h.open_interest end as vol_oi_ratio,
       (h.bid + h.ask) / 2.0 as midpoint
from held_eod h join contracts_like c on c.contract = h.contract
""")
def q_derived_columns(spark, sf_dir):
    """Days to expiry, volume / open interest, filled midpoint."""
    h = held_eod(spark, sf_dir)
    c = fx.contracts_like(spark, sf_dir).select("contract", "exp_date")
    return h.join(c, "contract").select(
        "contract", "tradetime",
        days_to_expiry("exp_date", "tradetime").alias("dte"),
        vol_oi_ratio("volume", "open_interest").alias("vol_oi_ratio"),
        midpoint_fill(F.lit(None).cast("double"), "bid", "ask").alias("midpoint"))
