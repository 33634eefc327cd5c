"""OHLCV bars from trades, and coarser bars from finer ones.

``groupBy(contract, window(ts, width))`` with mergeable aggregates: partial
aggregation map-side, one shuffle.  Open and close are ``min_by`` /
``max_by`` on (time, tie id), so equal timestamps resolve the same way
everywhere.  The notional (price x size) is summed as DECIMAL, so vwap does
not depend on the order partial sums meet; bars carry it for re-barring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bar width units of the time-series request and their defaults.
TIMESPANS = {"second": "second", "minute": "minute", "hour": "hour", "day": "day", "week": "week",
             "month": "month", "quarter": "quarter", "year": "year"}
# Months of the spans that have no fixed length; their bars start on the first of a month, counted from year 0.
MONTHS = {"month": 1, "quarter": 3, "year": 12}
DEFAULT_MULTIPLIER = 15
DEFAULT_TIMESPAN = "minute"
NOTIONAL_TYPE = "decimal(38,4)"


def width(multiplier: int = DEFAULT_MULTIPLIER, timespan: str = DEFAULT_TIMESPAN) -> str:
    if timespan not in TIMESPANS:
        raise ValueError(f"timespan must be one of {sorted(TIMESPANS)}")
    if int(multiplier) < 1:
        raise ValueError("multiplier must be >= 1")
    return f"{int(multiplier)} {TIMESPANS[timespan]}s"


def bar_start(ts: Column, bar_width: str) -> Column:
    """Start of the bar a time falls in.  Weeks start on Monday, months on the first."""
    count, unit = bar_width.split()
    unit = unit.rstrip("s")
    if unit in MONTHS:
        step = int(count) * MONTHS[unit]
        index = F.year(ts) * 12 + F.month(ts) - 1
        first = index - index % step
        return F.make_date(F.floor(first / 12).cast("int"), (first % 12 + 1).cast("int"), F.lit(1)).cast("timestamp")
    return F.window(ts, bar_width, startTime="4 days").start if unit == "week" else F.window(ts, bar_width).start


def ticks_to_bars(ticks: DataFrame, bar_width: str, key: str = "contract", ts: str = "t",
                  price: str = "price", size: str = "size", tie: str = "event_id") -> DataFrame:
    """A3: bars of ``bar_width`` ('15 minutes', '1 hour', '1 day') per contract."""
    order = F.struct(F.col(ts), F.col(tie))
    notional = F.col(price).cast("decimal(18,4)") * F.col(size)
    # grouping by the window struct (not its start) keeps the event-time
    # column visible to a streaming watermark
    unit = bar_width.split()[1].rstrip("s")
    if unit in MONTHS:
        bar = F.struct(bar_start(F.col(ts), bar_width).alias("start"))
    else:
        bar = F.window(F.col(ts), bar_width, startTime="4 days" if unit == "week" else None)
    g = ticks.groupBy(F.col(key).alias("contract"), bar.alias("__w")).agg(
        F.min_by(F.col(price), order).alias("open"),
        F.max(F.col(price)).alias("high"),
        F.min(F.col(price)).alias("low"),
        F.max_by(F.col(price), order).alias("last"),
        F.sum(F.col(size)).alias("__vol"),
        F.sum(notional).cast(NOTIONAL_TYPE).alias("notional"),
        F.count(F.lit(1)).alias("trades"),
    )
    return g.select(
        "contract", F.col("__w.start").alias("tradetime"), "open", "high", "low", "last",
        F.col("__vol").cast("double").alias("volume"),
        (F.col("notional").cast("double") / F.col("__vol").cast("double")).alias("vwap"),
        "notional", "trades")


# Columns of a bar state besides its key (contract, tradetime).
STATE_COLUMNS = ["first", "last", "high", "low", "volume", "notional", "trades"]


def bar_states(ticks: DataFrame, bar_width: str, key: str = "contract", ts: str = "t", price: str = "price",
               size: str = "size", tie: str = "event_id") -> DataFrame:
    """Mergeable states of bars: one row per (contract, bar start) with the first and the last trade as (time, id,
    price), high, low, and the sums.  States of any parts of the ticks fold into the states of all (``merge_states``)."""
    trade = F.struct(F.col(ts).alias("t"), F.col(tie).alias("id"), F.col(price).alias("price"))
    return ticks.groupBy(F.col(key).alias("contract"), bar_start(F.col(ts), bar_width).alias("tradetime")).agg(
        F.min(trade).alias("first"), F.max(trade).alias("last"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.sum(size).cast("long").alias("volume"),
        F.sum(F.col(price).cast("decimal(18,4)") * F.col(size)).cast(NOTIONAL_TYPE).alias("notional"),
        F.count(F.lit(1)).alias("trades"))


def merge_states(states: DataFrame, key: list[str] = ("contract", "tradetime"), seq: str | None = None) -> DataFrame:
    """Partial bar states -> one state per bar.  The order they came in (``seq``) does not matter."""
    return states.groupBy(*key).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.sum("volume").alias("volume"), F.sum("notional").cast(NOTIONAL_TYPE).alias("notional"), F.sum("trades").alias("trades"))


def finish_states(states: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Bar states -> bars, with the columns of ``ticks_to_bars`` and those of ``keep``."""
    volume = F.col("volume").cast("double")
    return states.select("contract", "tradetime", F.col("first.price").alias("open"), "high", "low",
                         F.col("last.price").alias("last"), volume.alias("volume"),
                         (F.col("notional").cast("double") / volume).alias("vwap"), "notional", "trades", *keep)


def rebar(bars: DataFrame, bar_width: str) -> DataFrame:
    """A4: coarser bars: first open, last close, max/min, summed volume, and
    volume-weighted vwap (from the notional when bars carry it, else
    vwap x volume)."""
    notional = (F.col("notional") if "notional" in bars.columns
                else (F.col("vwap") * F.col("volume")).cast(NOTIONAL_TYPE))
    trades = F.sum("trades") if "trades" in bars.columns else F.count(F.lit(1))
    g = bars.groupBy("contract", bar_start(F.col("tradetime"), bar_width).alias("__t")).agg(
        F.min_by("open", "tradetime").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("last", "tradetime").alias("last"),
        F.sum("volume").alias("volume"),
        F.sum(notional).cast(NOTIONAL_TYPE).alias("notional"),
        trades.alias("trades"),
    )
    return g.select(
        "contract", F.col("__t").alias("tradetime"), "open", "high", "low", "last", "volume",
        (F.col("notional").cast("double") / F.col("volume")).alias("vwap"), "notional", "trades")


def bars_in_range(bars: DataFrame, contract: str, start, end) -> DataFrame:
    """Held bars of one contract between two UTC dates (inclusive)."""
    d = F.to_date("tradetime")
    out = bars.where(F.col("contract") == contract)
    if start is not None:
        out = out.where(d >= F.lit(start))
    if end is not None:
        out = out.where(d <= F.lit(end))
    return out
