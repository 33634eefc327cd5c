"""DuckDB SQL for every registered query (the correctness oracle).

The fixture views of ``plans/fixtures.py`` are restated here as SQL CTEs over
the driver's pre-registered tables; each oracle names the views it needs.
Ties are broken explicitly, double sums go through DECIMAL, and result
columns carry the same names as the Spark results.
"""

from __future__ import annotations

VIEWS = {
    "contracts_like": """
select concat('O:', lpad(cast(p_partkey as varchar), 8, '0')) as contract, p_type as underlying_symbol,
       make_date(2002, 1 + (p_size % 4) * 3, 18) as exp_date,
       case when p_partkey % 2 = 0 then 'put' else 'call' end as option_type,
       p_retailprice as strike, p_brand as exchange
from part""",
    "eod_raw_like": """
select concat('O:', lpad(cast(l_partkey as varchar), 8, '0')) as contract,
       cast(date_trunc('month', l_shipdate) as date) as tradetime,
       l_extendedprice as bid, l_extendedprice + l_quantity as ask,
       case when l_returnflag = 'N' then null else l_discount end as volatility, l_tax as delta,
       case when l_linestatus = 'F' then concat(l_orderkey, '-', l_linenumber) end as raw_json,
       l_linestatus as load_side, l_quantity as volume, l_quantity - l_linenumber as open_interest,
       l_shipdate as fetched_at, l_orderkey * 8 + l_linenumber as src_id,
       row_number() over (partition by l_partkey, date_trunc('month', l_shipdate)
                          order by l_linestatus desc, l_shipdate, l_orderkey, l_linenumber, l_suppkey) as seq
from lineitem""",
    "ticks_like": """
select event_type as contract, ts as t, value as price, 1 + event_id % 9 as size, event_id from events""",
    "jobs_like": """
select c_custkey as job_id, c_mktsegment as endpoint from customer""",
    "tasks_like": """
select o_orderkey as task_id, o_custkey as job_id,
       case when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'P' then 'running'
            when o_orderpriority = '1-URGENT' then 'failed' else 'pending' end as status,
       cast(substring(o_orderpriority, 1, 1) as int) * 100 as priority, o_orderdate as created_at,
       cast(floor(o_totalprice) as bigint) as rows_inserted, cast(o_orderkey % 7 as bigint) as api_requests_made
from orders""",
    "task_events_like": """
select event_id as seq, cast(floor(event_id / 3) as bigint) as task_id, ts as at,
       case when event_type in ('signup', 'view') then 'claimed'
            when event_type = 'purchase' then 'completed' else 'failed' end as kind,
       event_type = 'error' as retryable, concat('w', cast(user_id % 8 as varchar)) as worker,
       cast(floor(value) as bigint) as rows_inserted, props as message
from events""",
    "request_log_like": """
select event_id as request_id, ts as created_at,
       case when event_type <> 'error' then 200 when event_id % 4 = 0 then 429 when event_id % 4 = 1 then 500
            when event_id % 4 = 2 then 503 else 403 end as status_code,
       cast(floor(value) as bigint) as row_count, cast(user_id % 40 as bigint) as task_id,
       case when event_type in ('view', 'click') then 'eod' when event_type = 'signup' then 'contracts'
            when event_type = 'purchase' then 'bars' else 'underlying-symbols' end as endpoint,
       cast(floor(value * 10) + 5 as bigint) as elapsed_ms
from events""",
    "requests_like": """
select o_orderkey as request_id,
       concat('O:', lpad(cast(case when o_orderkey % 50 = 0 then o_custkey + 90000000 else o_custkey end as varchar), 8, '0')) as contract,
       cast(o_orderdate as date) as start_date,
       cast(cast(o_orderdate as date) + interval '120' day as date) as end_date,
       case when o_orderpriority = '1-URGENT' then 'put' end as option_type
from orders""",
    # keep-last over the raw quote rows, then the chain with identity and midpoint
    "held_eod": """
select contract, tradetime, bid, ask, volatility, delta, raw_json, volume, open_interest, fetched_at from (
  select *, row_number() over (partition by contract, tradetime order by seq desc) as rn from eod_raw_like) r
where rn = 1""",
    "chain": """
select h.contract, h.tradetime, h.bid, h.ask, h.volatility, h.delta, h.volume, h.open_interest,
       c.underlying_symbol, c.exp_date, c.option_type, c.strike, (h.bid + h.ask) / 2.0 as midpoint
from held_eod h join contracts_like c on c.contract = h.contract""",
    "put_entries": """
select underlying_symbol, tradetime, exp_date, 'put' as option_type, (min(strike) + max(strike)) / 1.8 as spot
from chain where option_type = 'put' group by underlying_symbol, tradetime, exp_date""",
}

# which views a view depends on (emitted first)
DEPENDS = {
    "held_eod": ["eod_raw_like"],
    "chain": ["held_eod", "contracts_like"],
    "put_entries": ["chain"],
}


def with_views(names: list[str], body: str) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in order)
    return f"with {ctes}\n{body.strip()}"


ORACLES: dict[str, str] = {}


def oracle(name: str, views: list[str], body: str) -> None:
    ORACLES[name] = with_views(views, body)
