"""Coverage of requests by held rows, exact gaps, request signatures, slice
planning and what is still to load.

All questions are answered for many requests at once by joins on the key
(never a per-request loop).  Gaps use a trade calendar bucketed by month, so
a request expands only to the trade days inside its window.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from optlake.functions.dates import tolerance_days
from optlake.functions.keys import request_signature, slice_name
from optlake.session import materialize


def held_span(held: DataFrame, key: list[str], date_col: str = "tradetime") -> DataFrame:
    """First and last held trade date per key (A2)."""
    d = F.to_date(F.col(date_col))
    return held.groupBy(*key).agg(F.min(d).alias("first_date"), F.max(d).alias("last_date"))


def covers(first: Column, last: Column, start: Column, end: Column, tolerance: int = 0) -> Column:
    """Do held dates [first, last] cover [start, end] within the tolerance?

    No rows -> not covered.  No bounds -> covered if any row.  Each bound is
    tested on its own; interior holes are not looked at (see ``gaps``).
    """
    tol = tolerance_days(tolerance)
    has_rows = first.isNotNull() | last.isNotNull()
    start_ok = start.isNull() | (first.isNotNull() & (first <= F.date_add(start, tol)))
    end_ok = end.isNull() | (last.isNotNull() & (last >= F.date_sub(end, tol)))
    return has_rows & start_ok & end_ok


def coverage_status(requests: DataFrame, held: DataFrame, key: list[str], start: str = "start_date",
                    end: str = "end_date", tolerance: int = 0, date_col: str = "tradetime") -> DataFrame:
    """C2: 'hit' (covered), 'partial' (rows held, not covering), 'miss' (none)."""
    span = held_span(held, key, date_col)
    j = requests.join(span, key, "left")
    ok = covers(F.col("first_date"), F.col("last_date"), F.col(start), F.col(end), tolerance)
    status = (F.when(F.col("first_date").isNull() & F.col("last_date").isNull(), F.lit("miss"))
              .when(ok, F.lit("hit")).otherwise(F.lit("partial")))
    return j.withColumn("status", status)


def trade_calendar(held: DataFrame, date_col: str = "tradetime") -> DataFrame:
    """Expected trade days when no calendar is given: the distinct held dates."""
    return held.select(F.to_date(F.col(date_col)).alias("day")).distinct()


def _month_buckets(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month")))


def gaps(requests: DataFrame, held: DataFrame, key: list[str], calendar: DataFrame | None = None,
         start: str = "start_date", end: str = "end_date", date_col: str = "tradetime") -> DataFrame:
    """Every (request, expected trade day) inside the window with no held row.

    The request side is expanded by month bucket and equi-joined to the
    calendar on the bucket, so only real trade days are generated; then an
    anti-join on (key, day) against the held rows.
    """
    cal = (calendar if calendar is not None else trade_calendar(held, date_col))
    cal = cal.select(F.col("day"), F.trunc("day", "month").alias("__month"))
    req = requests.select("*", _month_buckets(F.col(start), F.col(end)).alias("__month"))
    cand = (req.join(cal, "__month")
            .where((F.col("day") >= F.col(start)) & (F.col("day") <= F.col(end)))
            .drop("__month"))
    have = held.select(*key, F.to_date(F.col(date_col)).alias("day")).distinct()
    return cand.join(have, key + ["day"], "left_anti").withColumnRenamed("day", "missing_day")


# Trade days of one bucket of the interval join.
BUCKET_DAYS = 64


def numbered_calendar(days: DataFrame) -> DataFrame:
    """(day, at): trade days and their place in the calendar.

    The calendar is small (some 250 rows a year): the numbering sorts it in one task."""
    return days.select("day").distinct().where("day is not null").select(
        "day", (F.row_number().over(Window.orderBy("day")) - 1).alias("at"))


def held_islands(held: DataFrame, key: list[str], calendar: DataFrame, date_col: str = "tradetime") -> DataFrame:
    """(key, lo, hi): runs of consecutive held trade days, as calendar places.

    A held day starts an island when the day before it is not held, and ends one when the day after it is not.  Only the
    edges are kept, in the order they are sorted in: the edge after a start is the end of its island."""
    days = held.select(*key, F.to_date(F.col(date_col)).alias("day")).distinct().join(calendar, "day")
    line = Window.partitionBy(*key).orderBy("at")
    starts = F.coalesce(F.col("at") - F.lag("at").over(line) > 1, F.lit(True))
    ends = F.coalesce(F.lead("at").over(line) - F.col("at") > 1, F.lit(True))
    edges = days.withColumn("__starts", starts).withColumn("__ends", ends).where("__starts or __ends")
    hi = F.when(F.col("__ends"), F.col("at")).otherwise(F.lead("at").over(line))
    return edges.withColumn("hi", hi).where("__starts").select(*key, F.col("at").alias("lo"), "hi")


def _places(requests: DataFrame, calendar: DataFrame, start: str, end: str, request: str) -> DataFrame:
    """Requests with the first (``__from``) and the last (``__to``) calendar place inside their window."""
    month = F.explode(F.sequence(F.trunc(F.col(start), "month"), F.trunc(F.col(end), "month"), F.expr("interval 1 month")))
    per_month = calendar.groupBy(F.trunc("day", "month").alias("__month")).agg(F.sort_array(F.collect_list(F.struct("day", "at"))).alias("__days"))
    # the trade days of the window's first and last month that has any lie on the window's edges: only those are looked at
    edges = requests.where(F.col(start) <= F.col(end)).select(F.col(request), F.col(start), F.col(end), month.alias("__month")).join(per_month, "__month")
    inside = F.filter("__days", lambda d: (d["day"] >= F.col(start)) & (d["day"] <= F.col(end)))
    span = edges.select(request, inside.alias("__in")).where(F.size("__in") > 0).groupBy(request).agg(
        F.min(F.element_at("__in", 1)["at"]).alias("__from"), F.max(F.element_at("__in", -1)["at"]).alias("__to"))
    return requests.join(span, request)


def gap_intervals(requests: DataFrame, held: DataFrame, key: list[str], request: str = "request_id", calendar: DataFrame | None = None,
                  start: str = "start_date", end: str = "end_date", date_col: str = "tradetime") -> DataFrame:
    """C3 as interval algebra: the requested window minus the islands of held trade days.

    One row per maximal run of missing trade days of a request: its columns, ``gap_from``, ``gap_to`` and ``gap_days``
    (trade days in it).  Windows and islands are intervals of calendar places; both are dealt into buckets of
    BUCKET_DAYS places and joined on (key, bucket), a pair counted in the first bucket it shares.  The islands that
    meet a window are at most half its days, so what lies between them is found in order per request.
    ``request`` is unique per request; requests with a NULL key have nothing held.
    """
    cal = numbered_calendar(calendar if calendar is not None else trade_calendar(held, date_col))
    cal = materialize(cal, "calendar")  # read by every branch
    asked = _places(requests, cal, start, end, request)
    names = {k: f"__key_{n}" for n, k in enumerate(key)}

    def bucket(at):
        return F.floor(at / BUCKET_DAYS)

    islands = held_islands(held, key, cal, date_col).select(
        *[F.col(k).alias(n) for k, n in names.items()], "lo", "hi",
        F.explode(F.sequence(bucket(F.col("lo")), bucket(F.col("hi")))).alias("__bucket"))
    windows = asked.select(request, *key, "__from", "__to",
                           F.explode(F.sequence(bucket(F.col("__from")), bucket(F.col("__to")))).alias("bucket"))
    same = [F.col(k) == F.col(n) for k, n in names.items()] + [F.col("bucket") == F.col("__bucket")]
    met = windows.join(islands, same).where(
        (F.col("lo") <= F.col("__to")) & (F.col("hi") >= F.col("__from"))
        & (F.col("bucket") == F.greatest(bucket(F.col("lo")), bucket(F.col("__from"))))).select(
        request, F.greatest("lo", "__from").alias("lo"), F.least("hi", "__to").alias("hi"))
    # a window starts after an island that ends before it, and ends before one that starts after it
    walls = asked.select(request, (F.col("__from") - 1).alias("hi"), F.lit(None).cast("int").alias("lo")).unionByName(
        asked.select(request, F.lit(None).cast("int").alias("hi"), (F.col("__to") + 1).alias("lo")))
    line = Window.partitionBy(request).orderBy(F.coalesce("hi", "lo"))
    open_ = met.select(request, "hi", "lo").unionByName(walls.select(request, "hi", "lo")).select(
        request, (F.lag("hi").over(line) + 1).alias("__a"), (F.col("lo") - 1).alias("__b")).where("__a <= __b")
    first = cal.select(F.col("at").alias("__a"), F.col("day").alias("gap_from"))
    last = cal.select(F.col("at").alias("__b"), F.col("day").alias("gap_to"))
    found = open_.join(first, "__a").join(last, "__b").select(
        request, "gap_from", "gap_to", (F.col("__b") - F.col("__a") + 1).cast("long").alias("gap_days"))
    return requests.join(found, request)


def cached_rows(requests: DataFrame, held: DataFrame, key: list[str], tolerance: int = 0, request: str = "request_id",
                calendar: DataFrame | None = None, start: str = "start_date", end: str = "end_date",
                date_col: str = "tradetime") -> tuple[DataFrame, DataFrame]:
    """Answers many requests from held rows: (rows, to_fetch).

    ``rows`` are the held rows inside the windows of the requests that are covered within ``tolerance`` days, with the
    request's id; ``to_fetch`` are the missing intervals (``gap_intervals``) of all others."""
    status = coverage_status(requests, held, key, start, end, tolerance, date_col).select(request, F.col("status").alias("__status"))
    tagged = materialize(requests.join(status, request), "cache-status")
    covered = tagged.where("__status = 'hit'").select(request, *key, F.col(start).alias("__start"), F.col(end).alias("__end"))
    day = F.to_date(F.col(date_col))
    rows = held.join(covered, key).where((F.col("__start").isNull() | (day >= F.col("__start"))) & (F.col("__end").isNull() | (day <= F.col("__end"))))
    calendar = calendar if calendar is not None else trade_calendar(held, date_col)
    missing = gap_intervals(tagged.where("__status <> 'hit'").drop("__status"), held, key, request, calendar, start, end, date_col)
    return rows.drop("__start", "__end"), missing


def minimal_requests(requests: DataFrame, signature: str = "signature", start: str = "start_date", end: str = "end_date",
                     request: str = "request_id") -> DataFrame:
    """C4: the requests whose window does not lie within another's of the same signature.

    Of requests with equal windows the one with the least id stays.  An open (NULL) bound reaches without end.  Requests
    of one signature and start are folded first (the longest window, then the least id), so what is sorted per signature
    is at most one row a start date; a running maximum of the ends before a row then tells whether it is within one.
    """
    far, early = F.lit("9999-12-31").cast("date"), F.lit("0001-01-01").cast("date")
    a, b = F.coalesce(F.col(start).cast("date"), early), F.coalesce(F.col(end).cast("date"), far)
    cols = requests.columns
    longest = requests.groupBy(signature, a.alias("__a")).agg(
        F.max(b).alias("__b"), F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(b, -F.col(request))).alias("__row"))
    before = Window.partitionBy(signature).orderBy("__a").rowsBetween(Window.unboundedPreceding, -1)
    kept = longest.withColumn("__reach", F.max("__b").over(before)).where(F.col("__reach").isNull() | (F.col("__reach") < F.col("__b")))
    return kept.select("__row.*")


def signatures(requests: DataFrame, endpoint: str, params: dict[str, Column]) -> DataFrame:
    """C4: request signature (SHA-1 of the canonical request) and slice name."""
    sig = request_signature(endpoint, params)
    return requests.withColumn("signature", sig).withColumn("slice_name", slice_name(endpoint, F.col("signature")))


BAND_TYPE = "decimal(18,4)"


def band_index(strike: Column, band: float) -> Column:
    """Number of the strike band of true width ``band`` (exact, any width)."""
    return F.floor(strike.cast(BAND_TYPE) / F.lit(str(band)).cast(BAND_TYPE)).cast("bigint")


def band_edge(index: Column, band: float) -> Column:
    """Lower strike of a band."""
    return (index * F.lit(str(band)).cast(BAND_TYPE)).cast("double")


def plan_slices(chains: DataFrame, trade_from: _dt.date, trade_to: _dt.date, option_types=("put", "call"),
                band: float = 25.0, step: str = "1 month") -> DataFrame:
    """Slice plan = (underlying, expiry) held in ``chains`` x trade dates x
    types x strike bands.  Each factor is an array exploded within its row, so
    the plan is built without a cross join.

    ``chains`` has underlying_symbol, exp_date, strike (one row per contract).
    """
    strike = F.col("strike")
    dims = chains.groupBy("underlying_symbol", "exp_date").agg(
        band_index(F.min(strike), band).alias("__lo"), band_index(F.max(strike), band).alias("__hi"))
    dates = F.sequence(F.lit(trade_from), F.lit(trade_to), F.expr(f"interval {step}"))
    return dims.select(
        "*", F.explode(dates).alias("trade_date"),
    ).select(
        "*", F.explode(F.array(*[F.lit(t) for t in option_types])).alias("option_type"),
    ).select(
        "underlying_symbol", "exp_date", "trade_date", "option_type",
        F.explode(F.sequence("__lo", "__hi")).alias("__band"),
    ).select(
        "underlying_symbol", "trade_date", "exp_date", "option_type",
        band_edge(F.col("__band"), band).alias("strike_from"),
        band_edge(F.col("__band") + 1, band).alias("strike_to"),
    )


def held_slices(chain: DataFrame, band: float = 25.0) -> DataFrame:
    """Slices that already have rows: (underlying, trade date, expiry, type, band)."""
    return chain.select(
        "underlying_symbol", F.to_date("tradetime").alias("trade_date"), "exp_date", "option_type",
        band_edge(band_index(F.col("strike"), band), band).alias("strike_from"),
    ).distinct()


def slices_todo(planned: DataFrame, done: DataFrame,
                on=("underlying_symbol", "trade_date", "exp_date", "option_type", "strike_from"),
                finished_tasks: DataFrame | None = None) -> DataFrame:
    """Planned slices with no held rows and, when ``finished_tasks``
    is given (slice columns of tasks that completed or used up their
    retries), without a finished task."""
    out = planned.join(done, list(on), "left_anti")
    if finished_tasks is not None:
        out = out.join(finished_tasks.select(*on).distinct(), list(on), "left_anti")
    return out
