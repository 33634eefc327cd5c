"""Driver queries: tasks and jobs, request log, integrity checks, bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from optlake.operators import bars as B
from optlake.operators import checks as V
from optlake.operators import requests as L
from optlake.operators import tasks as T
from optlake.plans import fixtures as fx
from optlake.plans.registry import query

# ---------------------------------------------------------------- tasks / jobs


@query("job_summary", ["jobs_like", "tasks_like"], """
, per as (
  select job_id, count(*) as requested_tasks,
         count(*) filter (where status = 'completed') as completed_tasks,
         count(*) filter (where status = 'failed') as failed_tasks,
         sum(rows_inserted) as inserted_rows, sum(api_requests_made) as api_requests_made,
         count(*) filter (where status <> 'completed') as unresolved_count,
         min(task_id) filter (where status <> 'completed') as first_unresolved_task
  from tasks_like group by job_id)
select j.job_id, j.endpoint,
       coalesce(p.requested_tasks, 0) as requested_tasks, coalesce(p.completed_tasks, 0) as completed_tasks,
       coalesce(p.failed_tasks, 0) as failed_tasks, cast(coalesce(p.inserted_rows, 0) as bigint) as inserted_rows,
       cast(coalesce(p.api_requests_made, 0) as bigint) as api_requests_made,
       cast(coalesce(p.api_requests_made, 0) * 10 as bigint) as api_call_units_estimated,
       coalesce(p.unresolved_count, 0) as unresolved_count, p.first_unresolved_task
from jobs_like j left join per p on p.job_id = j.job_id
""")
def q_job_summary(spark, sf_dir):
    """A1: summary of every job (jobs without tasks keep a zero row)."""
    return T.job_summary(fx.jobs_like(spark, sf_dir), fx.tasks_like(spark, sf_dir))


@query("unresolved_tasks", ["tasks_like"], """
select job_id, task_id, status from tasks_like where status <> 'completed'
""")
def q_unresolved_tasks(spark, sf_dir):
    """A1 (ids): unresolved tasks of every job as rows."""
    return T.unresolved_tasks(fx.tasks_like(spark, sf_dir))


@query("task_counts", ["jobs_like", "tasks_like"], """
select j.endpoint,
       count(*) filter (where t.status = 'pending') as pending, count(*) filter (where t.status = 'running') as running,
       count(*) filter (where t.status = 'completed') as completed, count(*) filter (where t.status = 'failed') as failed,
       count(*) as tasks, cast(sum(t.rows_inserted) as bigint) as rows_inserted,
       cast(sum(t.api_requests_made) as bigint) as api_requests_made,
       cast(sum(t.api_requests_made) * 10 as bigint) as api_call_units
from tasks_like t join jobs_like j on j.job_id = t.job_id group by j.endpoint
""")
def q_task_counts(spark, sf_dir):
    """A5: tasks by status per endpoint, with requests and call units."""
    t = fx.tasks_like(spark, sf_dir).join(fx.jobs_like(spark, sf_dir), "job_id")
    return T.task_counts(t, ["endpoint"])


@query("enqueue_tasks", [], """
select row_number() over (order by o_custkey, o_orderdate, o_orderkey) as task_id, o_custkey as job_id, 'eod' as endpoint,
       concat('{"filter[contract]":"', concat('O:', lpad(cast(o_custkey as varchar), 8, '0')),
              '","filter[tradetime_eq]":"', cast(cast(o_orderdate as date) as varchar), '"}') as query_params,
       100 + idx as priority, 'pending' as status, 3 as max_retries, 1000 as page_limit
from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as idx from orders) x
""")
def q_enqueue_tasks(spark, sf_dir):
    """One task per planned slice (here: each order date of a customer
    job), priority 100 + position, deterministic ids, sorted-key params."""
    o = fx.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("job_id"), "o_orderdate", "o_orderkey")
    params = {"filter[contract]": fx.contract_code(F.col("job_id")),
              "filter[tradetime_eq]": F.to_date("o_orderdate").cast("string")}
    t = T.enqueue_tasks(o, "eod", params, order=["o_orderdate", "o_orderkey"])
    return t.select("task_id", "job_id", "endpoint", "query_params", "priority", "status", "max_retries", "page_limit")


@query("next_tasks", ["tasks_like"], """
select job_id, task_id, priority, created_at, claim_rank from (
  select *, row_number() over (partition by job_id order by priority, created_at, task_id) as claim_rank
  from tasks_like where status = 'pending') x
where claim_rank <= 2
""")
def q_next_tasks(spark, sf_dir):
    """Next two pending tasks of every job by (priority, created_at)."""
    return T.next_pending(fx.tasks_like(spark, sf_dir), 2, per=["job_id"]).select(
        "job_id", "task_id", "priority", "created_at", "claim_rank")


TASK_STATE_SQL = """
, agg as (
  select task_id, count(*) filter (where kind = 'failed') as retry_count,
         coalesce(sum(rows_inserted) filter (where kind = 'completed'), 0) as rows_inserted,
         max(seq) filter (where kind = 'claimed') as claim_seq,
         max(seq) filter (where kind = 'failed') as fail_seq,
         max(seq) as last_seq, count(*) as events
  from task_events_like group by task_id)
select a.task_id,
       case when l.kind = 'claimed' then 'running' when l.kind = 'completed' then 'completed'
            when a.retry_count >= 3 or not l.retryable then 'failed' else 'pending' end as status,
       a.retry_count, cast(a.rows_inserted as bigint) as rows_inserted,
       case when a.fail_seq > a.claim_seq then null else c.worker end as claimed_by,
       case when a.fail_seq > a.claim_seq then null else c.at end as claimed_at,
       f.message as last_error, l.at as updated_at, a.events
from agg a
join task_events_like l on l.task_id = a.task_id and l.seq = a.last_seq
left join task_events_like c on c.task_id = a.task_id and c.seq = a.claim_seq
left join task_events_like f on f.task_id = a.task_id and f.seq = a.fail_seq
"""


@query("task_state", ["task_events_like"], TASK_STATE_SQL)
def q_task_state(spark, sf_dir):
    """T4: task state folded from the claim / complete / fail event log."""
    return T.task_state(fx.task_events_like(spark, sf_dir))


# ---------------------------------------------------------------- request log


@query("quota_minutes", ["request_log_like"], """
select time_bucket(interval '1 minute', created_at) as minute, count(*) as requests, count(*) * 10 as units,
       cast(sum(row_count) as bigint) as rows, count(*) > 90 as over_rate, count(*) > 1000 as over_vendor_limit
from request_log_like group by 1
""")
def q_quota_minutes(spark, sf_dir):
    """L1: requests and call units per minute against the rate limits."""
    return L.quota_per_minute(fx.request_log_like(spark, sf_dir))


def _peak_sql(unit: str) -> str:
    return f"""
, s as (select endpoint, created_at, count(*) over (partition by endpoint order by created_at
               range between interval '59.999999 seconds' preceding and current row) as n from request_log_like)
select endpoint, date_trunc('{unit}', created_at) as {unit}, max(n) as peak_requests, max(n) * 10 as peak_units, max(n) > 90 as over_rate
from s group by all
"""


@query("peak_minutes", ["request_log_like"], _peak_sql("minute"))
def q_peak_minutes(spark, sf_dir):
    """L1: exact peak rate of every endpoint in any 60 seconds ending in a minute."""
    return L.peak_rate(fx.request_log_like(spark, sf_dir), ["endpoint"], "minute").withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query("peak_days", ["request_log_like"], _peak_sql("day").replace("date_trunc('day', created_at)", "cast(created_at as date)"))
def q_peak_days(spark, sf_dir):
    """L1: exact peak rate of every endpoint in any 60 seconds ending on a day."""
    return L.peak_rate(fx.request_log_like(spark, sf_dir), ["endpoint"], "day").withColumn("day", F.to_date("day"))


@query("quota_days", ["request_log_like"], """
select cast(created_at as date) as day, count(*) as requests, count(*) * 10 as units,
       cast(sum(row_count) as bigint) as rows, 100000 - count(*) * 10 as units_left, count(*) * 10 > 100000 as over_quota
from request_log_like group by 1
""")
def q_quota_days(spark, sf_dir):
    """L1: call units per UTC day against the daily quota."""
    return L.quota_per_day(fx.request_log_like(spark, sf_dir))


@query("request_outcomes", ["request_log_like"], """
, c as (select *, case when status_code between 200 and 299 then 'ok'
                       when status_code in (429, 500, 502, 503, 504) then 'retryable' else 'fatal' end as cls
        from request_log_like),
last as (select task_id, status_code as last_status, cls as outcome from (
           select *, row_number() over (partition by task_id order by request_id desc) as rn from c) x where rn = 1),
a as (select task_id, count(*) as attempts, count(*) filter (where cls = 'ok') as ok,
             count(*) filter (where cls = 'retryable') as retryable, count(*) filter (where cls = 'fatal') as fatal
      from c group by task_id)
select a.task_id, a.attempts, a.ok, a.retryable, a.fatal, l.last_status, l.outcome
from a join last l on l.task_id = a.task_id
""")
def q_request_outcomes(spark, sf_dir):
    """L2: attempts per task by outcome class; the last attempt decides."""
    return L.request_outcomes(fx.request_log_like(spark, sf_dir))


@query("request_latency", ["request_log_like"], """
select endpoint, count(*) as requests, cast(sum(row_count) as bigint) as rows,
       cast(sum(elapsed_ms) as double) / count(elapsed_ms) as avg_ms,
       median(elapsed_ms) as median_ms, cast(quantile_disc(elapsed_ms, 0.95) as double) as p95_ms,
       max(elapsed_ms) as max_ms
from request_log_like group by endpoint
""")
def q_request_latency(spark, sf_dir):
    """L3: latency (mean, exact median and 95th percentile) and rows per endpoint."""
    return L.latency(fx.request_log_like(spark, sf_dir), ["endpoint"])


# ---------------------------------------------------------------- checks


@query("null_keys", ["eod_raw_like"], """
, r as (select case when delta = 0 then null else contract end as contract, tradetime, bid, ask, src_id from eod_raw_like)
select src_id, concat_ws(';', case when contract is null then 'contract is null' end,
                              case when tradetime is null then 'tradetime is null' end,
                              case when bid is null then 'bid is null' end,
                              case when ask < bid then 'ask below bid' end) as reasons
from r where contract is null or tradetime is null or bid is null or ask < bid
""")
def q_null_keys(spark, sf_dir):
    """V1: quarantined quote rows (key nulled where delta = 0) with reasons."""
    r = fx.eod_raw_like(spark, sf_dir).withColumn(
        "contract", F.when(F.col("delta") == 0, F.lit(None)).otherwise(F.col("contract")))
    _, bad = V.validate(r, not_null=["contract", "tradetime", "bid"], rules={"ask below bid": F.col("ask") < F.col("bid")})
    return bad.select("src_id", F.array_join("reasons", ";").alias("reasons"))


@query("duplicate_keys", ["eod_raw_like"], """
select contract, tradetime, count(*) as n from eod_raw_like group by contract, tradetime having count(*) > 1
""")
def q_duplicate_keys(spark, sf_dir):
    """V2: (contract, tradetime) keys held more than once."""
    return V.duplicate_keys(fx.eod_raw_like(spark, sf_dir), ["contract", "tradetime"])


@query("orphan_tasks", ["task_events_like", "tasks_like"], """
, e as (select seq * 2 as task_id from task_events_like)
select task_id, count(*) as events from e
where not exists (select 1 from tasks_like t where t.task_id = e.task_id) group by task_id
""")
def q_orphan_tasks(spark, sf_dir):
    """V3: task events whose task does not exist (events numbered past the last task)."""
    events = fx.task_events_like(spark, sf_dir).withColumn("task_id", F.col("seq") * 2)
    o = V.orphans(events, fx.tasks_like(spark, sf_dir), ["task_id"])
    return o.groupBy("task_id").agg(F.count(F.lit(1)).alias("events"))


@query("orphan_requests", ["requests_like", "contracts_like"], """
select request_id, contract from requests_like r
where not exists (select 1 from contracts_like c where c.contract = r.contract)
""")
def q_orphan_requests(spark, sf_dir):
    """V3: requests naming a contract that is not in the contracts table."""
    return V.orphans(fx.requests_like(spark, sf_dir).select("request_id", "contract"),
                     fx.contracts_like(spark, sf_dir), ["contract"])


@query("bad_values", ["tasks_like", "contracts_like", "eod_raw_like", "request_log_like"], """
select 'tasks' as table_name, 'status not allowed' as rule,
       count(*) filter (where status not in ('pending', 'running', 'completed', 'failed')) as bad_rows from tasks_like
union all select 'tasks', 'priority out of range', count(*) filter (where priority < 100 or priority > 500) from tasks_like
union all select 'tasks', 'negative rows', count(*) filter (where rows_inserted < 0) from tasks_like
union all select 'contracts', 'option_type not allowed', count(*) filter (where option_type not in ('put', 'call')) from contracts_like
union all select 'contracts', 'strike not positive', count(*) filter (where strike <= 0) from contracts_like
union all select 'option_eod', 'ask below bid', count(*) filter (where ask < bid) from eod_raw_like
union all select 'option_eod', 'volatility out of range', count(*) filter (where volatility < 0 or volatility > 5) from eod_raw_like
union all select 'option_eod', 'delta out of range', count(*) filter (where delta < -1 or delta > 1) from eod_raw_like
union all select 'api_request_log', 'status code out of range', count(*) filter (where status_code < 100 or status_code > 599) from request_log_like
""")
def q_bad_values(spark, sf_dir):
    """V4: rows breaking each value rule, per table (zeros included)."""
    c = F.col
    return V.union_all([
        V.rule_counts(fx.tasks_like(spark, sf_dir), {
            "status not allowed": ~c("status").isin(*V.TASK_STATUSES),
            "priority out of range": (c("priority") < 100) | (c("priority") > 500),
            "negative rows": c("rows_inserted") < 0}, "tasks"),
        V.rule_counts(fx.contracts_like(spark, sf_dir), {
            "option_type not allowed": ~c("option_type").isin(*V.OPTION_TYPES),
            "strike not positive": c("strike") <= 0}, "contracts"),
        V.rule_counts(fx.eod_raw_like(spark, sf_dir), {
            "ask below bid": c("ask") < c("bid"),
            "volatility out of range": (c("volatility") < 0) | (c("volatility") > 5),
            "delta out of range": (c("delta") < -1) | (c("delta") > 1)}, "option_eod"),
        V.rule_counts(fx.request_log_like(spark, sf_dir), {
            "status code out of range": (c("status_code") < 100) | (c("status_code") > 599)}, "api_request_log"),
    ])


# ---------------------------------------------------------------- bars

BAR_COLUMNS = ["contract", "tradetime", "open", "high", "low", "last", "volume", "vwap", "trades"]


def bars_sql(interval: str) -> str:
    return f"""
, b as (select *, time_bucket(interval '{interval}', t) as tradetime from ticks_like),
f as (select contract, tradetime, price as open from (
        select *, row_number() over (partition by contract, tradetime order by t, event_id) as rn from b) x where rn = 1),
l as (select contract, tradetime, price as last from (
        select *, row_number() over (partition by contract, tradetime order by t desc, event_id desc) as rn from b) x
      where rn = 1),
a as (select contract, tradetime, max(price) as high, min(price) as low, cast(sum(size) as double) as volume,
             cast(sum(cast(price as decimal(18,4)) * size) as double) / cast(sum(size) as double) as vwap,
             count(*) as trades
      from b group by contract, tradetime)
select a.contract, a.tradetime, f.open, a.high, a.low, l.last, a.volume, a.vwap, a.trades
from a join f on f.contract = a.contract and f.tradetime = a.tradetime
join l on l.contract = a.contract and l.tradetime = a.tradetime
"""


@query("bars_15m", ["ticks_like"], bars_sql("15 minutes"))
def q_bars_15m(spark, sf_dir):
    """A3: 15-minute OHLCV/VWAP bars from trades."""
    return B.ticks_to_bars(fx.ticks_like(spark, sf_dir), "15 minutes").select(*BAR_COLUMNS)


@query("bars_1h", ["ticks_like"], bars_sql("1 hour"))
def q_bars_1h(spark, sf_dir):
    """A3: hourly bars."""
    return B.ticks_to_bars(fx.ticks_like(spark, sf_dir), "1 hour").select(*BAR_COLUMNS)


@query("bars_1d", ["ticks_like"], bars_sql("1 day"))
def q_bars_1d(spark, sf_dir):
    """A3: daily bars."""
    return B.ticks_to_bars(fx.ticks_like(spark, sf_dir), "1 day").select(*BAR_COLUMNS)


def _calendar_sql(start: str) -> str:
    return f"""
, b as (select *, {start} as bar from ticks_like),
o as (select contract, bar, min(struct_pack(t := t, e := event_id, p := price)) as first_,
             max(struct_pack(t := t, e := event_id, p := price)) as last_, max(price) as high, min(price) as low,
             cast(sum(size) as double) as volume from b group by contract, bar)
select contract, cast(bar as timestamp) as tradetime, first_.p as open, high, low, last_.p as last, volume from o
"""


WEEK_COLUMNS = ["contract", "tradetime", "open", "high", "low", "last", "volume"]


@query("bars_1w", ["ticks_like"], _calendar_sql("date_trunc('week', t)"))
def q_bars_1w(spark, sf_dir):
    """A3: weekly bars; weeks start on Monday."""
    return B.ticks_to_bars(fx.ticks_like(spark, sf_dir), B.width(1, "week")).select(*WEEK_COLUMNS)


@query("bars_1q", ["ticks_like"], _calendar_sql("date_trunc('quarter', t)"))
def q_bars_1q(spark, sf_dir):
    """A3+A4: quarterly bars re-barred from monthly bars."""
    monthly = B.ticks_to_bars(fx.ticks_like(spark, sf_dir), B.width(1, "month"))
    return B.rebar(monthly, B.width(1, "quarter")).select(*WEEK_COLUMNS)


@query("rebar_1h_1d", ["ticks_like"], bars_sql("1 day"))
def q_rebar_1h_1d(spark, sf_dir):
    """A4: daily bars re-barred from hourly bars (must equal daily from trades)."""
    hourly = B.ticks_to_bars(fx.ticks_like(spark, sf_dir), "1 hour")
    return B.rebar(hourly, "1 day").select(*BAR_COLUMNS)


@query("create_jobs", [], """
select row_number() over (order by c_nationkey, c_custkey) as job_id, 'eod' as endpoint, c_name as underlying_symbol,
       case when c_acctbal < 0 then 'put' end as option_type, c_nationkey, c_custkey, 'pending' as status
from customer
""")
def q_create_jobs(spark, sf_dir):
    """One backfill job per config row, ids in config order."""
    cfg = fx.table(spark, sf_dir, "customer").select(
        F.lit("eod").alias("endpoint"), F.col("c_name").alias("underlying_symbol"),
        F.when(F.col("c_acctbal") < 0, F.lit("put")).alias("option_type"), "c_nationkey", "c_custkey")
    return T.create_jobs(cfg, order=["c_nationkey", "c_custkey"])


@query("create_jobs_null_split", [], """
select row_number() over (order by grp nulls first, c_custkey) as job_id, grp, c_custkey, 'pending' as status
from (select case when c_nationkey > 2 then c_nationkey end as grp, c_custkey from customer) x
""")
def q_create_jobs_null_split(spark, sf_dir):
    """T1 on a config column that is NULL for most rows: no row is lost, one group is no task of its own."""
    cfg = fx.table(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") > 2, F.col("c_nationkey")).alias("grp"), "c_custkey")
    return T.create_jobs(cfg, order=["grp", "c_custkey"])


_TASKS_SQL = """
, plain as (select o_orderkey as task_id, o_custkey as job_id, cast(1 + o_orderkey % 3 as integer) as max_retries from orders),
ev as (select seq, task_id, "at", kind, retryable, worker, message, rows_inserted,
              rows_inserted + seq % 5 as rows_received, 1 + seq % 3 as api_requests_made
       from task_events_like),
agg as (
  select task_id, count(*) filter (where kind = 'failed') as retry_count,
         coalesce(sum(rows_received) filter (where kind = 'completed'), 0) as rows_received,
         coalesce(sum(rows_inserted) filter (where kind = 'completed'), 0) as rows_inserted,
         coalesce(sum(api_requests_made) filter (where kind = 'completed'), 0) as api_requests_made,
         max(seq) filter (where kind = 'failed') as fail_seq, max(seq) as last_seq, count(*) as events
  from ev group by task_id),
state as (
  select t.task_id, t.job_id, t.max_retries,
         case when l.kind is null then 'pending' when l.kind = 'claimed' then 'running' when l.kind = 'completed' then 'completed'
              when a.retry_count >= t.max_retries or not l.retryable then 'failed' else 'pending' end as status,
         coalesce(a.retry_count, 0) as retry_count, cast(coalesce(a.rows_received, 0) as bigint) as rows_received,
         cast(coalesce(a.rows_inserted, 0) as bigint) as rows_inserted,
         cast(coalesce(a.api_requests_made, 0) as bigint) as api_requests_made,
         f.message as last_error, l.at as updated_at, coalesce(a.events, 0) as events
  from plain t left join agg a on a.task_id = t.task_id
  left join ev l on l.task_id = a.task_id and l.seq = a.last_seq
  left join ev f on f.task_id = a.task_id and f.seq = a.fail_seq)
"""


def _folded_tasks(spark, sf_dir):
    tasks = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("task_id"), F.col("o_custkey").alias("job_id"),
        (F.lit(1) + F.col("o_orderkey") % 3).cast("int").alias("max_retries"))
    events = fx.task_events_like(spark, sf_dir)
    events = events.withColumn("rows_received", F.col("rows_inserted") + F.col("seq") % 5) \
        .withColumn("api_requests_made", F.lit(1) + F.col("seq") % 3)
    return T.task_state(events, tasks=tasks)


@query("task_state_full", ["task_events_like"], _TASKS_SQL + "select * from state")
def q_task_state_full(spark, sf_dir):
    """T4 over the task table: three counters, each task's own max_retries, 'pending' without events."""
    return _folded_tasks(spark, sf_dir).drop("claimed_by", "claimed_at")


@query("job_summary_folded", ["jobs_like", "task_events_like"], _TASKS_SQL + """
select j.job_id, j.endpoint, count(s.task_id) as requested_tasks,
       count(*) filter (where s.status = 'completed') as completed_tasks,
       count(*) filter (where s.status = 'failed') as failed_tasks,
       cast(coalesce(sum(s.rows_inserted), 0) as bigint) as inserted_rows,
       cast(coalesce(sum(s.api_requests_made), 0) as bigint) as api_requests_made,
       cast(coalesce(sum(s.api_requests_made), 0) * 10 as bigint) as api_call_units_estimated,
       count(*) filter (where s.status <> 'completed') as unresolved_count,
       min(s.task_id) filter (where s.status <> 'completed') as first_unresolved_task
from jobs_like j left join state s on s.job_id = j.job_id group by j.job_id, j.endpoint
""")
def q_job_summary_folded(spark, sf_dir):
    """A1 on the folded task state (T4)."""
    return T.job_summary(fx.jobs_like(spark, sf_dir), _folded_tasks(spark, sf_dir))


@query("job_status", [], """
select job_id, status, updated_at from (
  select o_custkey as job_id,
         case o_orderstatus when 'F' then 'completed' when 'O' then 'running' else 'paused' end as status,
         o_orderdate as updated_at,
         row_number() over (partition by o_custkey order by o_orderkey desc) as rn
  from orders) x where rn = 1
""")
def q_job_status(spark, sf_dir):
    """T5: job status = its last status event (events keyed by order)."""
    o = fx.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("job_id"), F.col("o_orderkey").alias("seq"), F.col("o_orderdate").alias("at"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "running")
        .otherwise("paused").alias("status"))
    return T.job_status(o)


SKETCH_SHARES = [0.5, 0.95, 0.99]


@query("latency_sketch", ["request_log_like"], """
select endpoint, cast(unnest([0.5, 0.95, 0.99]) as double) as share, count(*) as requests,
       cast(max(elapsed_ms) as bigint) as max_ms, true as within
from request_log_like group by endpoint
""")
def q_latency_sketch(spark, sf_dir):
    """L3 as stored state: a sketch per endpoint and day, kept in two loads, merged over all days; ``within``: the
    merged percentile's exact rank is within the stated error of its share."""
    from optlake.session import materialize, scratch_path
    from optlake.sources.keyed import KeyedTable

    log = fx.request_log_like(spark, sf_dir).withColumn("day", F.to_date("created_at"))
    key = ["endpoint", "day"]
    table = KeyedTable(spark, scratch_path(spark, "latency"), key, fold=L.merge_latency)
    for n in range(2):
        table.apply(L.latency_sketches(log.where(F.pmod("request_id", F.lit(2)) == n), key), n)
    found = materialize(L.sketch_percentiles(L.merge_latency(table.read(), ["endpoint"]), SKETCH_SHARES), "latency-shares")
    ms = F.col("elapsed_ms")
    ranks = log.select("endpoint", ms).join(found.select("endpoint", "share", "ms"), "endpoint").groupBy("endpoint", "share").agg(
        (F.count_if(ms < F.col("ms")) / F.count(ms)).alias("below"), (F.count_if(ms <= F.col("ms")) / F.count(ms)).alias("upto"))
    within = (F.col("below") <= F.col("share") + L.SKETCH_ERROR) & (F.col("upto") >= F.col("share") - L.SKETCH_ERROR)
    return found.join(ranks, ["endpoint", "share"]).select("endpoint", "share", "requests", "max_ms", within.alias("within"))
