"""Vendor request log rollups: quota use, outcome classes, latency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Vendor quota and configured rate, call units per request,
# and the status codes a retry may fix.
VENDOR_REQUESTS_PER_MINUTE = 1000
VENDOR_UNITS_PER_DAY = 100_000
CONFIGURED_REQUESTS_PER_MINUTE = 90
CALL_UNITS_PER_REQUEST = 10
RETRYABLE_STATUS = [429, 500, 502, 503, 504]
RETRYABLE_ERROR_WORDS = ["timeout", "timed out", "reset"]


def outcome_class(status_code: Column, error_message: Column | None = None) -> Column:
    """L2: 'ok' (2xx), 'retryable' (429/5xx listed, time-outs, resets) or 'fatal'."""
    msg = F.lower(F.coalesce(error_message, F.lit(""))) if error_message is not None else F.lit("")
    transient = F.lit(False)
    for w in RETRYABLE_ERROR_WORDS:
        transient = transient | msg.contains(w)
    return (F.when(status_code.between(200, 299), F.lit("ok"))
            .when(status_code.isin(*RETRYABLE_STATUS) | (status_code.isNull() & transient), F.lit("retryable"))
            .otherwise(F.lit("fatal")))


def quota_per_minute(log: DataFrame, ts: str = "created_at",
                     rate_limit: int = CONFIGURED_REQUESTS_PER_MINUTE,
                     vendor_limit: int = VENDOR_REQUESTS_PER_MINUTE) -> DataFrame:
    """L1: requests, call units and rows per minute, flagged against the
    configured rate and the vendor limit."""
    g = log.groupBy(F.window(F.col(ts), "1 minute").alias("__w")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("row_count").cast("long").alias("rows"))
    return g.select(
        F.col("__w.start").alias("minute"), "requests", (F.col("requests") * CALL_UNITS_PER_REQUEST).alias("units"), "rows",
        (F.col("requests") > rate_limit).alias("over_rate"),
        (F.col("requests") > vendor_limit).alias("over_vendor_limit"))


def quota_per_day(log: DataFrame, ts: str = "created_at", unit_limit: int = VENDOR_UNITS_PER_DAY) -> DataFrame:
    """L1: requests and call units per UTC day against the daily unit quota."""
    g = log.groupBy(F.to_date(F.col(ts)).alias("day")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("row_count").cast("long").alias("rows"))
    units = F.col("requests") * CALL_UNITS_PER_REQUEST
    return g.select("day", "requests", units.alias("units"), "rows",
                    (F.lit(unit_limit) - units).alias("units_left"), (units > unit_limit).alias("over_quota"))


# Seconds of a part of the log in which a sliding count runs.
PART_SECONDS = 600


def sliding_counts(log: DataFrame, by: list[str], ts: str = "created_at", seconds: int = 60) -> DataFrame:
    """(by, at, requests): for every request time, the requests in the ``seconds`` that end with it.

    Requests of one time are counted first.  The log is then cut into parts of time, so a hot endpoint is worked on by
    many tasks; a part also gets the last ``seconds`` of the one before it (its halo), which only count and are not
    reported.  Times are exact to the microsecond; a request leaves the count ``seconds`` after it was made."""
    part_us, span_us = max(PART_SECONDS, seconds) * 1_000_000, seconds * 1_000_000
    per_time = log.where(F.col(ts).isNotNull()).groupBy(*by, F.unix_micros(F.col(ts).cast("timestamp")).alias("__at")).agg(
        F.count(F.lit(1)).alias("__n"))
    at = F.col("__at")
    own = F.floor(at / part_us)
    spread = F.when(F.pmod(at, F.lit(part_us)) > part_us - span_us, F.array(own, own + 1)).otherwise(F.array(own))
    line = Window.partitionBy(*by, "__part").orderBy("__at").rangeBetween(1 - span_us, Window.currentRow)
    counted = per_time.withColumn("__part", F.explode(spread)).withColumn("requests", F.sum("__n").over(line))
    return counted.where(F.col("__part") == own).select(*by, F.timestamp_micros("__at").alias("at"), "requests")


def peak_rate(log: DataFrame, by: list[str], unit: str, ts: str = "created_at", seconds: int = 60,
              rate_limit: int = CONFIGURED_REQUESTS_PER_MINUTE) -> DataFrame:
    """L1: the most requests in any ``seconds`` ending within each ``unit`` ('minute', 'day'), and their call units.

    Unlike counts per clock minute, a burst that spans two minutes is seen whole."""
    peaks = sliding_counts(log, by, ts, seconds).groupBy(*by, F.date_trunc(unit, "at").alias(unit)).agg(
        F.max("requests").alias("peak_requests"))
    return peaks.select(*by, unit, "peak_requests", (F.col("peak_requests") * CALL_UNITS_PER_REQUEST).alias("peak_units"),
                        (F.col("peak_requests") > rate_limit).alias("over_rate"))


def request_outcomes(log: DataFrame, key: str = "task_id") -> DataFrame:
    """L2: attempts per task and how they ended; the last attempt decides."""
    cls = outcome_class(F.col("status_code"), F.col("error_message") if "error_message" in log.columns else None)
    rows = log.withColumn("__class", cls)
    g = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("__class") == "ok").alias("ok"),
        F.count_if(F.col("__class") == "retryable").alias("retryable"),
        F.count_if(F.col("__class") == "fatal").alias("fatal"),
        F.max_by(F.struct(F.col("status_code"), F.col("__class")), F.col("request_id")).alias("__last"))
    return g.select(key, "attempts", "ok", "retryable", "fatal",
                    F.col("__last.status_code").alias("last_status"), F.col("__last.__class").alias("outcome"))


def latency(log: DataFrame, by: list[str], ms: str = "elapsed_ms", exact: bool = True) -> DataFrame:
    """L3: requests, rows, mean / median / 95th percentile latency per group.

    Exact percentiles come from counts per (group, millisecond value): requests
    are counted map-side first, then the counts are cumulated in value order,
    so no task holds a group's requests.  ``exact=False`` uses ``percentile_approx``.
    """
    m = F.col(ms)
    totals = [F.count(F.lit(1)).alias("requests"), F.sum("row_count").cast("long").alias("rows"),
              (F.sum(m).cast("double") / F.count(m).cast("double")).alias("avg_ms")]
    if not exact:
        return log.groupBy(*by).agg(*totals, F.percentile_approx(m, 0.5).cast("double").alias("median_ms"),
                                    F.percentile_approx(m, 0.95).cast("double").alias("p95_ms"), F.max(m).alias("max_ms"))
    counts = log.groupBy(*by, ms).agg(F.count(F.lit(1)).alias("__n"), F.sum("row_count").alias("__rows"))
    known = F.when(m.isNotNull(), F.col("__n")).otherwise(0)
    group = Window.partitionBy(*by)
    upto = group.orderBy(m.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = counts.withColumn("__cum", F.sum(known).over(upto)).withColumn("__all", F.sum(known).over(group))

    def value_at(place):
        return F.min(F.when(F.col("__cum") >= place, m))

    low, high = F.floor((F.col("__all") + 1) / 2), F.floor((F.col("__all") + 2) / 2)
    return cum.groupBy(*by).agg(
        F.sum("__n").alias("requests"), F.sum("__rows").cast("long").alias("rows"),
        (F.sum(m * F.col("__n")).cast("double") / F.sum(known).cast("double")).alias("avg_ms"),
        ((value_at(low) + value_at(high)) / 2).cast("double").alias("median_ms"),
        value_at(F.ceil(F.col("__all") * F.lit(0.95).cast("decimal(3,2)"))).cast("double").alias("p95_ms"), F.max(m).alias("max_ms"))


# Size parameter of a latency sketch, and the rank error it stays within (99 % of the time, normalised).
SKETCH_K = 800
SKETCH_ERROR = 0.01


def latency_sketches(log: DataFrame, by: list[str], ms: str = "elapsed_ms", k: int = SKETCH_K) -> DataFrame:
    """L3 as stored state: per group (endpoint and day, say) counts, sums and a KLL quantile sketch of the latencies.

    Sketches of any parts of a log merge into that of the whole (``merge_latency``), so days are read once and any
    window of them is answered from a few kilobytes a day."""
    m = F.col(ms).cast("long")
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"), F.count(m).alias("timed"), F.sum(m).alias("total_ms"),
                                F.max(m).alias("max_ms"), F.kll_sketch_agg_bigint(m, k).alias("sketch"))


def merge_latency(sketches: DataFrame, by: list[str], seq: str | None = None) -> DataFrame:
    """Sketch rows -> one per group.  The order they came in (``seq``) does not matter."""
    return sketches.groupBy(*by).agg(F.sum("requests").alias("requests"), F.sum("timed").alias("timed"),
                                     F.sum("total_ms").alias("total_ms"), F.max("max_ms").alias("max_ms"),
                                     F.kll_merge_agg_bigint("sketch").alias("sketch"))


def sketch_percentiles(sketches: DataFrame, shares: list[float]) -> DataFrame:
    """The sketches' group columns and requests, with mean, maximum and one row for each share (``share``, ``ms``)."""
    keys = [c for c in sketches.columns if c not in ("requests", "timed", "total_ms", "max_ms", "sketch")]
    wanted = F.array(*[F.lit(float(x)) for x in shares])
    met = F.arrays_zip(wanted.alias("share"), F.kll_sketch_get_quantile_bigint("sketch", wanted).alias("ms"))
    return sketches.where("timed > 0").select(
        *keys, "requests", (F.col("total_ms").cast("double") / F.col("timed")).alias("avg_ms"), "max_ms", F.inline(met))
