"""User-facing calls over a table store: symbols, contracts, end-of-day rows
and bars with the request filter set, plus coverage of many requests.

Each call returns a lazy DataFrame; nothing is collected.  Trade-date
windows also constrain the partition column, so only the touched trade
months (or days, for bars) are listed and read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from optlake.operators import bars as B
from optlake.operators.coverage import cached_rows, coverage_status, minimal_requests
from optlake.operators.filters import (
    FilterSet,
    apply_filter_set,
    resolve_window,
    sort_columns,
    symbol_defaults,
)
from optlake.sources.store import TableStore

# Held bar width in minutes (the store keeps 1-minute bars).
HELD_BAR_MINUTES = 1


def _finish(df: DataFrame, fs: FilterSet, key: list[str]) -> DataFrame:
    """The whole result in order.  ``limit`` is a request's page size: it never
    cuts the result (``ordered_page`` gives single pages)."""
    return df.orderBy(*sort_columns(fs.sort, df.columns, key))


def symbols(store: TableStore, market: str | None = "stocks", active: bool | None = True) -> DataFrame:
    """Underlying symbols with the universe defaults, by symbol."""
    return symbol_defaults(store.read("underlying_symbols"), market, active).orderBy("underlying_symbol")


def contracts(store: TableStore, **filters) -> DataFrame:
    """Contracts matching the given filters (None = not applied)."""
    fs = FilterSet(**filters)
    return _finish(apply_filter_set(store.read("contracts"), fs), fs, ["contract"])


def eod(store: TableStore, **filters) -> DataFrame:
    """End-of-day rows matching the filters and trade-date window."""
    fs = FilterSet(**filters)
    held = store.read("option_eod")
    start, end = resolve_window(fs)
    if start is not None:
        held = held.where(F.col("trade_month") >= F.trunc(F.lit(start), "month"))
    if end is not None:
        held = held.where(F.col("trade_month") <= F.lit(end))
    out = apply_filter_set(held, fs).drop("trade_month")
    return _finish(out, fs, ["contract", "tradetime"])


def bars(store: TableStore, contract: str, start, end, multiplier: int = B.DEFAULT_MULTIPLIER,
         timespan: str = B.DEFAULT_TIMESPAN, sort: str = "asc", limit: int | None = None) -> DataFrame:
    """All bars of one contract between two dates at ``multiplier x timespan``,
    re-barred from the held bars; a span finer than those raises.  ``limit`` is
    the request's page size and does not cut the result."""
    fs = FilterSet(range_from=start, range_to=end)
    s, e = resolve_window(fs)
    if timespan == "second" and int(multiplier) < 60 * HELD_BAR_MINUTES:
        raise ValueError(f"held bars are {HELD_BAR_MINUTES}-minute bars; {multiplier} second bars cannot be made from them")
    held = store.read("bars")
    if s is not None:
        held = held.where(F.col("trade_date") >= F.lit(s))
    if e is not None:
        held = held.where(F.col("trade_date") <= F.lit(e))
    rows = B.bars_in_range(held.drop("trade_date"), contract, s, e)
    if not (timespan == "minute" and int(multiplier) == HELD_BAR_MINUTES):
        rows = B.rebar(rows, B.width(multiplier, timespan)).drop("notional", "trades")
    return rows.orderBy(F.col("tradetime").desc() if sort == "desc" else F.col("tradetime").asc())


def coverage(store: TableStore, requests: DataFrame, tolerance_days: int = 0) -> DataFrame:
    """hit / partial / miss for many (contract, start_date, end_date) requests."""
    return coverage_status(requests, store.read("option_eod"), ["contract"], tolerance=tolerance_days)


def cached(store: TableStore, requests: DataFrame, tolerance_days: int = 0, calendar: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Answers (request_id, contract, start_date, end_date) requests from what is held: (rows, to_fetch).

    ``rows``: held rows of the requests that are covered within the tolerance, with their request_id.  ``to_fetch``:
    for the others, the windows of missing trade days (gap_from, gap_to) of each, less those that lie within another
    window of the same contract, so that nothing is asked for twice."""
    held = store.read("option_eod").drop("trade_month")
    rows, missing = cached_rows(requests, held, ["contract"], tolerance_days, calendar=calendar)
    asked = missing.select("request_id", "contract", "gap_from", "gap_to", "gap_days")
    return rows, minimal_requests(asked, "contract", "gap_from", "gap_to")
