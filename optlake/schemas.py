"""Fixed table schemas (option data, job/task bookkeeping, request log).

Column lists follow the durable tables of the options store; ``bars`` is ours
(the vendor field names mapped to readable ones).  Prices and greeks are
doubles, counters ints/longs, JSON kept as text in files.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(name, dtype=StringType(), nullable=True):
    return StructField(name, dtype, nullable)


def _d(name, nullable=True):
    return StructField(name, DoubleType(), nullable)


# market / active / name are kept so the universe defaults (market = stocks,
# active only) can be applied to held rows.
UNDERLYING_SYMBOLS = StructType([
    _s("underlying_symbol", nullable=False),
    _s("market"),
    StructField("active", BooleanType(), True),
    _s("name"),
    StructField("fetched_at", TimestampType(), True),
])

CONTRACTS = StructType([
    _s("contract", nullable=False),
    _s("underlying_symbol", nullable=False),
    StructField("exp_date", DateType(), True),
    _s("expiration_type"),
    _s("option_type", nullable=False),
    _d("strike"),
    _s("exchange"),
    _s("currency"),
    StructField("first_seen_at", TimestampType(), False),
    StructField("last_seen_at", TimestampType(), False),
    _s("raw_json"),
])

# The nine quote columns an upsert overwrites (nulls included).
EOD_QUOTE_COLUMNS = ["bid", "ask", "midpoint", "volatility", "delta", "gamma", "theta", "vega", "rho"]
# Identity columns kept from the first insert of a key.
EOD_IDENTITY_COLUMNS = ["underlying_symbol", "exp_date", "option_type", "strike"]
EOD_KEY = ["contract", "tradetime"]

OPTION_EOD = StructType([
    _s("contract", nullable=False),
    StructField("tradetime", DateType(), False),
    _s("underlying_symbol", nullable=False),
    StructField("exp_date", DateType(), True),
    _s("expiration_type"),
    _s("option_type", nullable=False),
    _d("strike"),
    _s("exchange"),
    _s("currency"),
    _d("open"), _d("high"), _d("low"), _d("last"), _d("last_size"), _d("previous"),
    StructField("previous_date", DateType(), True),
    _d("bid"),
    StructField("bid_date", TimestampType(), True),
    _d("bid_size"),
    _d("ask"),
    StructField("ask_date", TimestampType(), True),
    _d("ask_size"),
    _d("midpoint"), _d("moneyness"), _d("volume"), _d("open_interest"), _d("volatility"), _d("theoretical"),
    _d("delta"), _d("gamma"), _d("theta"), _d("vega"), _d("rho"),
    StructField("dte", IntegerType(), True),
    _d("vol_oi_ratio"),
    StructField("fetched_at", TimestampType(), False),
    _s("raw_json"),
])

BARS = StructType([
    _s("contract", nullable=False),
    StructField("tradetime", TimestampType(), False),
    _d("open"), _d("high"), _d("low"), _d("last"), _d("volume"), _d("vwap"),
])

BACKFILL_JOBS = StructType([
    StructField("job_id", LongType(), False),
    _s("endpoint", nullable=False),
    _s("status", nullable=False),
    _s("underlying_symbol"), _s("contract"), _s("option_type"),
    StructField("exp_date_eq", DateType()), StructField("exp_date_from", DateType()), StructField("exp_date_to", DateType()),
    StructField("tradetime_eq", DateType()), StructField("tradetime_from", DateType()), StructField("tradetime_to", DateType()),
    _d("strike_eq"), _d("strike_from"), _d("strike_to"),
    StructField("page_limit", IntegerType(), False),
    StructField("max_pages_per_task", IntegerType(), True),
    StructField("max_retries_per_task", IntegerType(), False),
    _s("fields"), _s("sort"),
    StructField("created_at", TimestampType(), True),
    StructField("updated_at", TimestampType(), True),
])

BACKFILL_TASKS = StructType([
    StructField("task_id", LongType(), False),
    StructField("job_id", LongType(), False),
    _s("endpoint", nullable=False),
    _s("query_params", nullable=False),
    _s("status", nullable=False),
    StructField("priority", IntegerType(), False),
    StructField("retry_count", IntegerType(), False),
    StructField("max_retries", IntegerType(), False),
    StructField("page_offset", IntegerType(), False),
    StructField("page_limit", IntegerType(), False),
    StructField("max_pages", IntegerType(), True),
    StructField("rows_received", LongType(), False),
    StructField("rows_inserted", LongType(), False),
    StructField("api_requests_made", LongType(), False),
    _s("last_error"), _s("claimed_by"),
    StructField("claimed_at", TimestampType(), True),
    StructField("created_at", TimestampType(), True),
    StructField("updated_at", TimestampType(), True),
])

API_REQUEST_LOG = StructType([
    StructField("request_id", LongType(), False),
    StructField("job_id", LongType(), True),
    StructField("task_id", LongType(), True),
    _s("endpoint", nullable=False),
    _s("url_without_token", nullable=False),
    StructField("status_code", IntegerType(), True),
    StructField("row_count", LongType(), True),
    StructField("elapsed_ms", LongType(), True),
    _s("error_message"),
    StructField("created_at", TimestampType(), True),
])

JOB_RESULT = StructType([
    StructField("job_id", LongType(), False),
    _s("endpoint"), _s("status"),
    StructField("requested_tasks", LongType(), False),
    StructField("completed_tasks", LongType(), False),
    StructField("failed_tasks", LongType(), False),
    StructField("inserted_rows", LongType(), False),
    StructField("updated_rows", LongType(), False),
    StructField("skipped_existing_rows", LongType(), False),
    StructField("api_requests_made", LongType(), False),
    StructField("api_call_units_estimated", LongType(), False),
    StructField("unresolved_tasks", ArrayType(LongType()), False),
])

TABLES = {
    "underlying_symbols": UNDERLYING_SYMBOLS,
    "contracts": CONTRACTS,
    "option_eod": OPTION_EOD,
    "bars": BARS,
    "backfill_jobs": BACKFILL_JOBS,
    "backfill_tasks": BACKFILL_TASKS,
    "api_request_log": API_REQUEST_LOG,
}

# Primary keys, checked by operators.checks.
TABLE_KEYS = {
    "underlying_symbols": ["underlying_symbol"],
    "contracts": ["contract"],
    "option_eod": EOD_KEY,
    "bars": ["contract", "tradetime"],
    "backfill_jobs": ["job_id"],
    "backfill_tasks": ["task_id"],
    "api_request_log": ["request_id"],
}


def not_null_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
