"""Driver queries: coverage status, gaps, request signatures, slice plan and todo."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from optlake.operators.coverage import (
    cached_rows,
    coverage_status,
    gap_intervals,
    gaps,
    held_slices,
    minimal_requests,
    plan_slices,
    signatures,
    slices_todo,
)
from optlake.plans import fixtures as fx
from optlake.plans.common import chain, held_eod
from optlake.plans.registry import query

TOLERANCE_DAYS = 15


@query("coverage_status", ["requests_like", "held_eod"], """
, span as (select contract, min(tradetime) as first_date, max(tradetime) as last_date from held_eod group by contract)
select r.request_id, r.contract, r.start_date, r.end_date, s.first_date, s.last_date,
       case when s.contract is null then 'miss'
            when s.first_date <= r.start_date + 15 and s.last_date >= r.end_date - 15 then 'hit'
            else 'partial' end as status
from requests_like r left join span s on s.contract = r.contract
""")
def q_coverage_status(spark, sf_dir):
    """C1+C2: hit / partial / miss for every request at once."""
    req = fx.requests_like(spark, sf_dir).select("request_id", "contract", "start_date", "end_date")
    return coverage_status(req, held_eod(spark, sf_dir), ["contract"], tolerance=TOLERANCE_DAYS).select(
        "request_id", "contract", "start_date", "end_date", "first_date", "last_date", "status")


@query("coverage_gaps", ["requests_like", "held_eod"], """
, cal as (select distinct tradetime as day from held_eod)
select r.request_id, r.contract, c.day as missing_day
from requests_like r join cal c on c.day >= r.start_date and c.day <= r.end_date
where not exists (select 1 from held_eod h where h.contract = r.contract and h.tradetime = c.day)
""")
def q_coverage_gaps(spark, sf_dir):
    """Exact missing (request, trade day) pairs against the held calendar."""
    req = fx.requests_like(spark, sf_dir).select("request_id", "contract", "start_date", "end_date")
    return gaps(req, held_eod(spark, sf_dir), ["contract"]).select("request_id", "contract", "missing_day")


_INTERVALS_SQL = """
, cal as (select day, row_number() over (order by day) as at from (select distinct tradetime as day from held_eod) d),
missing as (
  select r.request_id, r.contract, c.day, c.at, c.at - row_number() over (partition by r.request_id order by c.at) as run
  from asked r join cal c on c.day >= r.start_date and c.day <= r.end_date
  where not exists (select 1 from held_eod h where h.contract = r.contract and h.tradetime = c.day)),
intervals as (
  select request_id, contract, min(day) as gap_from, max(day) as gap_to, count(*) as gap_days from missing group by request_id, contract, run)
"""


def _asked(spark, sf_dir):
    """Coverage questions over windows of 30 to 1200 days."""
    return fx.requests_like(spark, sf_dir).select(
        "request_id", "contract", "option_type", "start_date",
        F.date_add("start_date", (F.lit(30) + F.col("request_id") % 1171).cast("int")).alias("end_date"))


_ASKED_SQL = """
, asked as (select request_id, contract, option_type, start_date,
                   cast(start_date + cast(30 + request_id % 1171 as integer) as date) as end_date from requests_like)"""


@query("coverage_intervals", ["requests_like", "held_eod"], _ASKED_SQL + _INTERVALS_SQL + """
select request_id, contract, gap_from, gap_to, gap_days from intervals
""")
def q_coverage_intervals(spark, sf_dir):
    """C3 as intervals: maximal runs of missing trade days of every request (windows minus held islands)."""
    req = _asked(spark, sf_dir).select("request_id", "contract", "start_date", "end_date")
    return gap_intervals(req, held_eod(spark, sf_dir), ["contract"]).select("request_id", "contract", "gap_from", "gap_to", "gap_days")


_HIT_SQL = """
, span as (select contract, min(tradetime) as first_date, max(tradetime) as last_date from held_eod group by contract),
hit as (select r.* from asked r join span s on s.contract = r.contract
        where s.first_date <= r.start_date + 15 and s.last_date >= r.end_date - 15)
"""


@query("cache_rows", ["requests_like", "held_eod"], _ASKED_SQL + _HIT_SQL + """
select r.request_id, h.contract, h.tradetime, h.bid, h.ask
from hit r join held_eod h on h.contract = r.contract and h.tradetime >= r.start_date and h.tradetime <= r.end_date
""")
def q_cache_rows(spark, sf_dir):
    """Tolerance-aware cache lookup: the held rows of every request that they cover within 15 days."""
    rows, _ = cached_rows(_asked(spark, sf_dir), held_eod(spark, sf_dir), ["contract"], tolerance=TOLERANCE_DAYS)
    return rows.select("request_id", "contract", "tradetime", "bid", "ask")


@query("cache_missing", ["requests_like", "held_eod"], _ASKED_SQL + _HIT_SQL + _INTERVALS_SQL + """
select request_id, contract, gap_from, gap_to, gap_days from intervals
where request_id not in (select request_id from hit)
""")
def q_cache_missing(spark, sf_dir):
    """Tolerance-aware cache lookup: what is to be fetched for the requests that held rows do not cover."""
    _, missing = cached_rows(_asked(spark, sf_dir), held_eod(spark, sf_dir), ["contract"], tolerance=TOLERANCE_DAYS)
    return missing.select("request_id", "contract", "gap_from", "gap_to", "gap_days")


@query("minimal_requests", ["requests_like"], _ASKED_SQL + """
, s as (select *, sha1(concat('{"endpoint":"eod","params":{"filter[contract]":"', contract, '"',
             case when option_type is null then '' else concat(',"filter[type]":"', option_type, '"') end, '}}')) as signature from asked)
select request_id, signature, start_date, end_date from s a
where not exists (select 1 from s b where b.signature = a.signature and b.start_date <= a.start_date and b.end_date >= a.end_date
                  and (b.start_date < a.start_date or b.end_date > a.end_date or b.request_id < a.request_id))
""")
def q_minimal_requests(spark, sf_dir):
    """C4: requests without those whose window lies within another's of the same signature."""
    asked = _asked(spark, sf_dir)
    params = {"filter[contract]": F.col("contract"), "filter[type]": F.col("option_type"),
              "filter[tradetime_from]": F.col("start_date").cast("string"), "filter[tradetime_to]": F.col("end_date").cast("string")}
    return minimal_requests(signatures(asked, "eod", params)).select("request_id", "signature", "start_date", "end_date")


@query("request_signature", ["requests_like"], """
, s as (select request_id, sha1(concat('{"endpoint":"eod","params":{"filter[contract]":"', contract, '"',
             case when option_type is null then '' else concat(',"filter[type]":"', option_type, '"') end,
             '}}')) as signature from requests_like)
select request_id, signature, concat('opt_eod_', substr(signature, 1, 24)) as slice_name from s
""")
def q_request_signature(spark, sf_dir):
    """C4: canonical request signature; date filters and paging left out."""
    req = fx.requests_like(spark, sf_dir)
    params = {
        "filter[contract]": F.col("contract"),
        "filter[type]": F.col("option_type"),
        "filter[tradetime_from]": F.col("start_date").cast("string"),
        "filter[tradetime_to]": F.col("end_date").cast("string"),
        "page[limit]": F.lit(1000),
    }
    return signatures(req, "eod", params).select("request_id", "signature", "slice_name")


PLAN_FROM = _dt.date(1995, 1, 1)
PLAN_TO = _dt.date(1996, 12, 1)

_PLAN_SQL = """
, dims as (select underlying_symbol, exp_date,
                  cast(floor(min(strike) / 25) as bigint) * 25 as lo, cast(floor(max(strike) / 25) as bigint) * 25 as hi
           from contracts_like group by underlying_symbol, exp_date),
plan as (
  select d.underlying_symbol, cast(m.trade_date as date) as trade_date, d.exp_date, t.option_type,
         cast(b.band as double) as strike_from, cast(b.band + 25 as double) as strike_to
  from dims d
  cross join (select unnest(generate_series(date '1995-01-01', date '1996-12-01', interval 1 month)) as trade_date) m
  cross join (select unnest(['put', 'call']) as option_type) t
  join lateral (select unnest(generate_series(d.lo, d.hi, 25)) as band) b on true)
"""


def _plan(spark, sf_dir):
    return plan_slices(fx.contracts_like(spark, sf_dir), PLAN_FROM, PLAN_TO)


@query("slice_plan", ["contracts_like"], _PLAN_SQL + """
select * from plan
""")
def q_slice_plan(spark, sf_dir):
    """Symbols x trade months x expiries x types x strike bands."""
    return _plan(spark, sf_dir)


@query("slice_plan_narrow", ["contracts_like"], """
, dims as (select underlying_symbol, exp_date, cast(floor(cast(min(strike) as decimal(18,4)) / 2.5) as bigint) as lo,
                  cast(floor(cast(max(strike) as decimal(18,4)) / 2.5) as bigint) as hi
           from contracts_like group by underlying_symbol, exp_date)
select d.underlying_symbol, date '1995-01-01' as trade_date, d.exp_date, 'put' as option_type,
       cast(b.band * 2.5 as double) as strike_from, cast((b.band + 1) * 2.5 as double) as strike_to
from dims d join lateral (select unnest(generate_series(d.lo, d.hi)) as band) b on true
""")
def q_slice_plan_narrow(spark, sf_dir):
    """Strike bands of 2.5, a width that is no whole number."""
    return plan_slices(fx.contracts_like(spark, sf_dir), PLAN_FROM, PLAN_FROM, option_types=("put",), band=2.5)


_DONE_SQL = """
, done as (select c.underlying_symbol, cast(date_trunc('month', o.o_orderdate) as date) as trade_date, c.exp_date, c.option_type,
                  cast(floor(c.strike / 25) * 25 as double) as strike_from, o.o_orderkey as task_id
           from orders o join contracts_like c on c.contract = concat('O:', lpad(cast(o.o_custkey as varchar), 8, '0'))),
ev as (select * from task_events_like),
agg as (select task_id, count(*) filter (where kind = 'failed') as fails, max(seq) as last_seq from ev group by task_id),
finished as (
  select distinct d.underlying_symbol, d.trade_date, d.exp_date, d.option_type, d.strike_from
  from done d join agg a on a.task_id = d.task_id join ev l on l.task_id = a.task_id and l.seq = a.last_seq
  where l.kind = 'completed' or (l.kind = 'failed' and (a.fails >= 2 or not l.retryable)))
"""


@query("slice_todo_tasks", ["contracts_like", "task_events_like", "chain"], _PLAN_SQL + _DONE_SQL + """
, held as (select distinct underlying_symbol, tradetime as trade_date, exp_date, option_type,
                  cast(floor(strike / 25) * 25 as double) as strike_from from chain)
select p.* from plan p
where not exists (select 1 from held h where h.underlying_symbol = p.underlying_symbol and h.trade_date = p.trade_date
                  and h.exp_date = p.exp_date and h.option_type = p.option_type and h.strike_from = p.strike_from)
  and not exists (select 1 from finished f where f.underlying_symbol = p.underlying_symbol and f.trade_date = p.trade_date
                  and f.exp_date = p.exp_date and f.option_type = p.option_type and f.strike_from = p.strike_from)
""")
def q_slice_todo_tasks(spark, sf_dir):
    """Planned slices without held rows and without a completed or exhausted task (folded task state)."""
    from optlake.operators.tasks import finished_tasks, task_state

    contracts = fx.contracts_like(spark, sf_dir)
    tasks = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("task_id"), F.lit(2).alias("max_retries"),
        fx.contract_code(F.col("o_custkey")).alias("contract"), F.trunc("o_orderdate", "month").alias("tradetime"))
    done = finished_tasks(task_state(fx.task_events_like(spark, sf_dir), tasks=tasks)).join(contracts, "contract")
    return slices_todo(_plan(spark, sf_dir), held_slices(chain(spark, sf_dir)), finished_tasks=held_slices(done))


@query("slice_todo", ["contracts_like", "chain"], _PLAN_SQL + """
, held as (select distinct underlying_symbol, tradetime as trade_date, exp_date, option_type,
                  cast(floor(strike / 25) * 25 as double) as strike_from from chain)
select p.* from plan p
where not exists (select 1 from held h where h.underlying_symbol = p.underlying_symbol and h.trade_date = p.trade_date
                  and h.exp_date = p.exp_date and h.option_type = p.option_type and h.strike_from = p.strike_from)
""")
def q_slice_todo(spark, sf_dir):
    """Planned slices that have no held rows yet (resume)."""
    return slices_todo(_plan(spark, sf_dir), held_slices(chain(spark, sf_dir)))


@query("held_span", ["held_eod"], """
select contract, min(tradetime) as first_date, max(tradetime) as last_date from held_eod group by contract
""")
def q_held_span(spark, sf_dir):
    """A2: first and last held trade date per contract."""
    from optlake.operators.coverage import held_span

    return held_span(held_eod(spark, sf_dir), ["contract"])
