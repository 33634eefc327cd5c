"""Backfill jobs and tasks as tables: creation, enqueue, next pending, state
folded from an event log, job status and summaries.

The mutable job/task rows of a queue database become an append-only event
log plus folds: every fold is a grouped aggregation keyed by task (or job)
with mergeable aggregates, so it is correct under any partitioning and a
replayed event changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from optlake.functions.keys import sorted_json
from optlake.session import materialize

# Task statuses, defaults of a task row, start priority,
# call units per vendor request.
TASK_STATUSES = ["pending", "running", "completed", "failed"]
DEFAULT_MAX_RETRIES = 3
DEFAULT_PAGE_LIMIT = 1000
START_PRIORITY = 100
CALL_UNITS_PER_REQUEST = 10


def global_index(df: DataFrame, order: list[str | Column], name: str = "idx") -> DataFrame:
    """0-based position of every row in ``order`` (names: ascending, NULLs first), over the whole frame.

    Rows are range-partitioned by the order columns and sorted within their
    partition, so no key, however frequent or NULL, is sorted by one task.  The
    sorted copy is written once (a second evaluation could be partitioned
    differently); offsets are running sums over its partitions' row counts, one
    row per partition.  ``order`` must be unique, or ties are broken by chance.
    """
    by = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    row = F.monotonically_increasing_id()  # partition number, then position in the partition
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__row", row)
    kept = materialize(dealt, "index").withColumn("__part", F.shiftright("__row", 33))
    counts = kept.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    place = F.col("__off") + F.col("__row").bitwiseAND(F.lit((1 << 33) - 1))
    return kept.join(offsets, "__part").withColumn(name, place.cast("long")).drop("__part", "__row", "__off")


def create_jobs(configs: DataFrame, order: list[str], max_held_job_id: int | Column = 0) -> DataFrame:
    """Job configs -> job rows with status 'pending'; ids follow the
    config order after the highest id already held."""
    held = max_held_job_id if isinstance(max_held_job_id, Column) else F.lit(max_held_job_id)
    ranked = global_index(configs, order, "__idx")
    return ranked.select(
        (held + F.col("__idx") + F.lit(1)).cast("long").alias("job_id"),
        *[c for c in configs.columns],
        F.lit("pending").alias("status"),
    )


def enqueue_tasks(slices: DataFrame, endpoint: Column | str, params: dict[str, Column], order: list[str],
                  job: str = "job_id", start_priority: int = START_PRIORITY, max_retries: int = DEFAULT_MAX_RETRIES,
                  page_limit: int = DEFAULT_PAGE_LIMIT, max_pages: int | None = None,
                  max_held_task_id: int | Column = 0) -> DataFrame:
    """One pending task per planned slice.

    task_id runs over all jobs in (job, ``order``) order after the highest id
    already held, so ids never collide and a rerun on the same slices gives the
    same ids; priority = start + position in the job's slice order;
    query_params = the slice parameters as sorted-key JSON.
    """
    held = max_held_task_id if isinstance(max_held_task_id, Column) else F.lit(max_held_task_id)
    idx = global_index(slices, [job, *order], "__idx")
    first = idx.groupBy(F.col(job).alias("__job")).agg(F.min("__idx").alias("__first"))
    idx = idx.join(first, F.col(job).eqNullSafe(F.col("__job")))
    place = F.col("__idx") - F.col("__first")
    ep = F.lit(endpoint) if isinstance(endpoint, str) else endpoint
    return idx.select(
        (held + F.col("__idx") + F.lit(1)).cast("long").alias("task_id"),
        F.col(job).cast("long").alias("job_id"),
        ep.alias("endpoint"),
        sorted_json(params).alias("query_params"),
        (F.lit(start_priority) + place).cast("long").alias("priority"),
        F.lit("pending").alias("status"),
        F.lit(0).alias("retry_count"),
        F.lit(max_retries).alias("max_retries"),
        F.lit(0).alias("page_offset"),
        F.lit(page_limit).alias("page_limit"),
        F.lit(max_pages).cast("int").alias("max_pages"),
    )


def next_pending(tasks: DataFrame, n: int = 1, per: list[str] | None = None) -> DataFrame:
    """The next ``n`` pending tasks by (priority, created_at, task_id),
    per group (e.g. per job) or overall.

    Per group it is a ``row_number() <= n`` filter, which Spark plans with a
    map-side partial window-group limit; overall it is a top-k."""
    pending = tasks.where(F.col("status") == "pending")
    order = [F.col("priority").asc_nulls_last(), F.col("created_at").asc_nulls_last(), F.col("task_id").asc()]
    if not per:
        return pending.orderBy(*order).limit(n)
    w = Window.partitionBy(*per).orderBy(*order)
    return pending.withColumn("claim_rank", F.row_number().over(w).cast("long")).where(F.col("claim_rank") <= n)


# Counters of a completion event that add up to a task's totals.
TASK_COUNTERS = ["rows_received", "rows_inserted", "api_requests_made"]


def task_state(events: DataFrame, max_retries: int = DEFAULT_MAX_RETRIES, tasks: DataFrame | None = None) -> DataFrame:
    """T4: current state of every task from its event log.

    events: task_id, seq (unique per task), at, kind in
    {'claimed','completed','failed'}, worker, retryable, message, and those of
    TASK_COUNTERS the log has.  ``tasks`` (task_id, max_retries, and any other
    columns, which are kept) adds the tasks without events, as 'pending', and
    each task's own ``max_retries``.
      * retry_count = number of failures; counters = sums over completions;
      * status from the last event: claimed -> running, completed ->
        completed, failed -> failed when retry_count >= max_retries or not
        retryable, else pending again;
      * claimed_by / claimed_at from the last claim, cleared by a later
        failure (a completion keeps them);
      * last_error = message of the last failure; updated_at = last event time.
    """
    kind = F.col("kind")
    counters = [c for c in TASK_COUNTERS if c in events.columns]
    g = events.groupBy("task_id").agg(
        F.count_if(kind == "failed").cast("long").alias("retry_count"),
        *[F.coalesce(F.sum(F.when(kind == "completed", F.col(c))), F.lit(0)).cast("long").alias(c) for c in counters],
        F.max_by(F.struct("kind", "retryable", "at"), F.col("seq")).alias("__last"),
        F.max_by(F.struct("worker", "at"), F.when(kind == "claimed", F.col("seq"))).alias("__claim"),
        F.max(F.when(kind == "claimed", F.col("seq"))).alias("__claim_seq"),
        F.max(F.when(kind == "failed", F.col("seq"))).alias("__fail_seq"),
        F.max_by(F.col("message"), F.when(kind == "failed", F.col("seq"))).alias("last_error"),
        F.count(F.lit(1)).alias("events"),
    )
    limit, kept = F.lit(max_retries), []
    if tasks is not None:
        g = tasks.join(g, "task_id", "left")
        limit = F.coalesce(F.col("max_retries"), F.lit(max_retries))
        kept = [c for c in tasks.columns if c != "task_id"]
    zero = F.lit(0).cast("long")
    last_kind = F.col("__last.kind")
    status = (F.when(last_kind == "claimed", F.lit("running"))
              .when(last_kind == "completed", F.lit("completed"))
              .when((F.col("retry_count") >= limit) | ~F.col("__last.retryable"), F.lit("failed"))
              .otherwise(F.lit("pending")))
    cleared = F.col("__fail_seq") > F.col("__claim_seq")
    return g.select(
        "task_id", *kept, status.alias("status"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in ["retry_count", *counters]],
        F.when(cleared, F.lit(None)).otherwise(F.col("__claim.worker")).alias("claimed_by"),
        F.when(cleared, F.lit(None)).otherwise(F.col("__claim.at")).alias("claimed_at"),
        "last_error", F.col("__last.at").alias("updated_at"), F.coalesce(F.col("events"), zero).alias("events"),
    )


def finished_tasks(state: DataFrame) -> DataFrame:
    """Tasks that planning skips: completed, or failed for good."""
    return state.where(F.col("status").isin("completed", "failed"))


def job_status(job_events: DataFrame) -> DataFrame:
    """T5: job status = the status of the job's last event (by seq)."""
    return job_events.groupBy("job_id").agg(
        F.max_by(F.struct("status", "at"), F.col("seq")).alias("__s")).select(
        "job_id", F.col("__s.status").alias("status"), F.col("__s.at").alias("updated_at"))


def job_summary(jobs: DataFrame, tasks: DataFrame, with_ids: bool = False) -> DataFrame:
    """A1: per job (all jobs at once): tasks requested / completed / failed,
    rows inserted, requests, call units (requests x 10) and unresolved tasks
    (every status other than completed).

    Pre-aggregates tasks by job before the join (jobs without tasks keep a
    row with zeros).  ``with_ids`` adds the sorted array of unresolved task
    ids, whose size is that job's task count; ``unresolved_tasks()`` gives
    the same ids as rows with no per-job collection.
    """
    st = F.col("status")
    aggs = [
        F.count(F.lit(1)).alias("requested_tasks"),
        F.count_if(st == "completed").alias("completed_tasks"),
        F.count_if(st == "failed").alias("failed_tasks"),
        F.sum("rows_inserted").alias("inserted_rows"),
        F.sum("api_requests_made").alias("api_requests_made"),
        F.count_if(st != "completed").alias("unresolved_count"),
        F.min(F.when(st != "completed", F.col("task_id"))).alias("first_unresolved_task"),
    ]
    if with_ids:
        aggs.append(F.sort_array(F.collect_list(F.when(st != "completed", F.col("task_id")))).alias("unresolved_tasks"))
    per_job = tasks.groupBy("job_id").agg(*aggs)
    j = jobs.join(per_job, "job_id", "left")
    zero = F.lit(0).cast("long")
    out = [
        *[F.col(c) for c in jobs.columns],
        F.coalesce(F.col("requested_tasks"), zero).alias("requested_tasks"),
        F.coalesce(F.col("completed_tasks"), zero).alias("completed_tasks"),
        F.coalesce(F.col("failed_tasks"), zero).alias("failed_tasks"),
        F.coalesce(F.col("inserted_rows"), zero).cast("long").alias("inserted_rows"),
        F.coalesce(F.col("api_requests_made"), zero).cast("long").alias("api_requests_made"),
        (F.coalesce(F.col("api_requests_made"), zero) * F.lit(CALL_UNITS_PER_REQUEST)).cast("long").alias("api_call_units_estimated"),
        F.coalesce(F.col("unresolved_count"), zero).alias("unresolved_count"),
        F.col("first_unresolved_task"),
    ]
    if with_ids:
        out.append(F.coalesce(F.col("unresolved_tasks"), F.array().cast("array<long>")).alias("unresolved_tasks"))
    return j.select(*out)


def unresolved_tasks(tasks: DataFrame) -> DataFrame:
    """Unresolved task ids of every job, one row each."""
    return tasks.where(F.col("status") != "completed").select("job_id", "task_id", "status")


def task_counts(tasks: DataFrame, by: list[str]) -> DataFrame:
    """A5: tasks by status, one column per status of the fixed list (a pivot
    written as conditional counts, so it is one pass with the totals), plus
    requests, call units and rows per group."""
    out = tasks.groupBy(*by).agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in TASK_STATUSES],
        F.count(F.lit(1)).alias("tasks"),
        F.sum("rows_inserted").cast("long").alias("rows_inserted"),
        F.sum("api_requests_made").cast("long").alias("api_requests_made"),
    )
    return out.withColumn("api_call_units", F.col("api_requests_made") * F.lit(CALL_UNITS_PER_REQUEST))


def job_result(jobs: DataFrame, tasks: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """The job result record: job summary (A1) with the task id list, plus
    updated / unchanged row counts from change labels (W2) carrying a
    ``job_id`` (zeros without them).  ``jobs`` needs job_id, endpoint,
    status."""
    s = job_summary(jobs, tasks, with_ids=True)
    zero = F.lit(0).cast("long")
    if changes is not None:
        c = changes.groupBy("job_id").agg(
            F.count_if(F.col("change") == "updated").alias("updated_rows"),
            F.count_if(F.col("change") == "unchanged").alias("skipped_existing_rows"))
        s = s.join(c, "job_id", "left")
        upd, skip = F.coalesce(F.col("updated_rows"), zero), F.coalesce(F.col("skipped_existing_rows"), zero)
    else:
        upd, skip = zero, zero
    return s.select(
        F.col("job_id").cast("long").alias("job_id"), "endpoint", "status", "requested_tasks", "completed_tasks",
        "failed_tasks", "inserted_rows", upd.alias("updated_rows"), skip.alias("skipped_existing_rows"),
        "api_requests_made", "api_call_units_estimated", "unresolved_tasks")
