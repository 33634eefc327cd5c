"""Driver queries: filter set, trade-date window, field list, ordered page."""

from __future__ import annotations

from pyspark.sql import functions as F

from optlake.operators.filters import FilterSet, apply_filter_set, numbered_pages, ordered_page, project
from optlake.plans import fixtures as fx
from optlake.plans.common import held_eod
from optlake.plans.registry import query

CONTRACT_FILTER = FilterSet(option_type="put", exp_date_from="2002-04-01", exp_date_to="2002-10-31",
                            strike_from=920, strike_to=980)


@query("contract_filter", ["contracts_like"], """
select * from contracts_like
where option_type = 'put' and exp_date >= date '2002-04-01' and exp_date <= date '2002-10-31'
  and strike >= 920 and strike <= 980
""")
def q_contract_filter(spark, sf_dir):
    """optional filters, only the given ones applied."""
    return apply_filter_set(fx.contracts_like(spark, sf_dir), CONTRACT_FILTER)


# range bounds win over tradetime_*; a digit string is epoch ms (1995-01-01
# 00:00 UTC) and a zoned time is taken in UTC first (-> 1996-01-01).
WINDOW = FilterSet(range_from="788918400000", range_to="1995-12-31T20:00:00-05:00",
                   tradetime_from="1990-01-01", tradetime_to="1990-12-31")


@query("tradetime_window", ["held_eod"], """
select contract, tradetime, bid from held_eod
where tradetime >= date '1995-01-01' and tradetime <= date '1996-01-01'
""")
def q_tradetime_window(spark, sf_dir):
    """window from range bounds, whole days, both ends inclusive."""
    return apply_filter_set(held_eod(spark, sf_dir), WINDOW).select("contract", "tradetime", "bid")


@query("project_fields", ["held_eod"], """
select contract, tradetime, bid, ask from held_eod
""")
def q_project_fields(spark, sf_dir):
    """comma field list with blanks -> projection."""
    return project(held_eod(spark, sf_dir), "contract, tradetime ,bid,, ask")


@query("ordered_page", ["contracts_like"], """
select * from contracts_like order by strike desc nulls last, contract limit 1000
""")
def q_ordered_page(spark, sf_dir):
    """O1+O2: '-strike' order, key tie-break, page size clamped to 1000."""
    return ordered_page(fx.contracts_like(spark, sf_dir), "-strike", ["contract"], limit=5000)


@query("next_page", ["contracts_like"], """
select * from contracts_like where contract > 'O:00000100' order by contract limit 1000
""")
def q_next_page(spark, sf_dir):
    """O2: keyset paging, the page after a given contract code."""
    from optlake.operators.filters import next_page

    return next_page(fx.contracts_like(spark, sf_dir), "contract", "O:00000100")


@query("contract_pages", ["contracts_like"], """
select *, cast(floor((row_number() over (order by strike desc nulls last, contract) - 1) / 1000) as bigint) as page
from contracts_like
""")
def q_contract_pages(spark, sf_dir):
    """O1+O2: all contracts in '-strike' order, 1000 to a page."""
    return numbered_pages(fx.contracts_like(spark, sf_dir), "-strike", ["contract"])


@query("active_symbols", [], """
select c_name as underlying_symbol, lower(c_mktsegment) as market, c_acctbal > 0 as active
from customer where lower(c_mktsegment) = 'building' and c_acctbal > 0
""")
def q_active_symbols(spark, sf_dir):
    """symbol defaults (one market, active only) without the hidden columns."""
    from optlake.operators.filters import drop_hidden, symbol_defaults

    c = fx.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("underlying_symbol"), F.lower("c_mktsegment").alias("market"),
        (F.col("c_acctbal") > 0).alias("active"), F.col("c_custkey").alias("__key"))
    return drop_hidden(symbol_defaults(c, "building", True))
