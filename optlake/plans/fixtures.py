"""The driver's generic tables re-read as option data (DataFrame API).

Each view is a plain projection of one driver table (plus a join for the
chain), so its size grows with the table it reads.  The same views exist as
DuckDB SQL in ``plans/oracle_sql.py``; the two must stay in step.

Mapping (see FIXTURES.md, part B):
  contracts_like    part      -> one contract per part
  eod_raw_like      lineitem  -> unmerged end-of-day quote rows, duplicates per key
  ticks_like        events    -> trades behind intraday bars
  jobs_like         customer  -> backfill jobs
  tasks_like        orders    -> backfill tasks
  task_events_like  events    -> claim / complete / fail events of tasks
  request_log_like  events    -> vendor request log
  requests_like     orders    -> coverage questions (contract, window)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same table as a file stream (a glob, since a stream source must
    name a folder or a pattern, not a single file)."""
    r = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet")


def contract_code(key_col) -> F.Column:
    """'O:' + 8-digit zero-padded number."""
    return F.concat(F.lit("O:"), F.lpad(key_col.cast("string"), 8, "0"))


def contracts_like(spark: SparkSession, sf_dir: str, with_part_key: bool = False) -> DataFrame:
    p = table(spark, sf_dir, "part")
    extra = [F.col("p_partkey")] if with_part_key else []
    return p.select(
        *extra,
        contract_code(F.col("p_partkey")).alias("contract"),
        F.col("p_type").alias("underlying_symbol"),
        F.make_date(F.lit(2002), F.lit(1) + (F.col("p_size") % 4) * 3, F.lit(18)).alias("exp_date"),
        F.when(F.col("p_partkey") % 2 == 0, F.lit("put")).otherwise(F.lit("call")).alias("option_type"),
        F.col("p_retailprice").alias("strike"),
        F.col("p_brand").alias("exchange"),
    )


def eod_raw_like(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    """Unmerged quote rows.  ``load_side`` 'O' = already held, 'F' = fresh.

    ``seq`` orders the rows of one key: held rows first, then by ship date and
    line id.  It is a struct (compared field by field), unique within a key, so
    no ranking window is needed to build it.  ``src_id`` is the source line id
    (order x 8 + line number); it is not unique in the driver's data.
    """
    li = src if src is not None else table(spark, sf_dir, "lineitem")
    return li.select(
        contract_code(F.col("l_partkey")).alias("contract"),
        F.trunc(F.col("l_shipdate"), "month").alias("tradetime"),
        F.col("l_extendedprice").alias("bid"),
        (F.col("l_extendedprice") + F.col("l_quantity")).alias("ask"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("double")).otherwise(F.col("l_discount")).alias("volatility"),
        F.col("l_tax").alias("delta"),
        F.when(F.col("l_linestatus") == "F", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))).alias("raw_json"),
        F.col("l_linestatus").alias("load_side"),
        F.col("l_quantity").alias("volume"),
        (F.col("l_quantity") - F.col("l_linenumber")).alias("open_interest"),
        F.col("l_shipdate").alias("fetched_at"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("src_id"),
        F.struct(
            F.when(F.col("l_linestatus") == "O", F.lit(0)).otherwise(F.lit(1)).alias("side"),
            F.col("l_shipdate").alias("shipdate"),
            F.col("l_orderkey").alias("orderkey"),
            F.col("l_linenumber").alias("line"),
            F.col("l_suppkey").alias("supp"),
        ).alias("seq"),
        F.col("l_partkey").alias("part_key"),
    )


def ticks_like(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    e = src if src is not None else table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("contract"),
        F.col("ts").alias("t"),
        F.col("value").alias("price"),
        (F.lit(1) + F.col("event_id") % 9).alias("size"),
        F.col("event_id"),
    )


def jobs_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("job_id"), F.col("c_mktsegment").alias("endpoint"))


def tasks_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("task_id"),
        F.col("o_custkey").alias("job_id"),
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "P", "running")
        .when(F.col("o_orderpriority") == "1-URGENT", "failed")
        .otherwise("pending").alias("status"),
        (F.substring("o_orderpriority", 1, 1).cast("int") * 100).alias("priority"),
        F.col("o_orderdate").alias("created_at"),
        F.floor("o_totalprice").cast("bigint").alias("rows_inserted"),
        (F.col("o_orderkey") % 7).cast("bigint").alias("api_requests_made"),
    )


def task_events_like(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    e = src if src is not None else table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("seq"),
        F.floor(F.col("event_id") / 3).cast("bigint").alias("task_id"),
        F.col("ts").alias("at"),
        F.when(F.col("event_type").isin("signup", "view"), "claimed")
        .when(F.col("event_type") == "purchase", "completed")
        .otherwise("failed").alias("kind"),
        (F.col("event_type") == "error").alias("retryable"),
        F.concat(F.lit("w"), (F.col("user_id") % 8).cast("string")).alias("worker"),
        F.floor("value").cast("bigint").alias("rows_inserted"),
        F.col("props").alias("message"),
    )


def request_log_like(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    e = src if src is not None else table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").alias("created_at"),
        F.when(F.col("event_type") != "error", 200)
        .when(F.col("event_id") % 4 == 0, 429)
        .when(F.col("event_id") % 4 == 1, 500)
        .when(F.col("event_id") % 4 == 2, 503)
        .otherwise(403).alias("status_code"),
        F.floor("value").cast("bigint").alias("row_count"),
        (F.col("user_id") % 40).cast("bigint").alias("task_id"),
        F.when(F.col("event_type").isin("view", "click"), "eod")
        .when(F.col("event_type") == "signup", "contracts")
        .when(F.col("event_type") == "purchase", "bars")
        .otherwise("underlying-symbols").alias("endpoint"),
        (F.floor(F.col("value") * 10) + 5).cast("bigint").alias("elapsed_ms"),
    )


def requests_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    cust = F.when(F.col("o_orderkey") % 50 == 0, F.col("o_custkey") + 90000000).otherwise(F.col("o_custkey"))
    start = F.to_date("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("request_id"),
        contract_code(cust).alias("contract"),
        start.alias("start_date"),
        F.date_add(start, 120).alias("end_date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("put")).alias("option_type"),
    )


VIEWS = {
    "contracts_like": contracts_like,
    "eod_raw_like": eod_raw_like,
    "ticks_like": ticks_like,
    "jobs_like": jobs_like,
    "tasks_like": tasks_like,
    "task_events_like": task_events_like,
    "request_log_like": request_log_like,
    "requests_like": requests_like,
}
