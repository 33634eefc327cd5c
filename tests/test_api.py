"""User-facing calls over a table store (contracts, symbols, bars)."""

import datetime as dt

from pyspark.sql import functions as F

from optlake import api
from optlake.sources.store import TableStore


def _store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "api"))
    seen = dt.datetime(2025, 1, 2)
    contracts = spark.createDataFrame([
        ("C1", "SPY", dt.date(2025, 1, 17), "put", 450.0, seen, seen),
        ("C2", "SPY", dt.date(2025, 2, 21), "call", 460.0, seen, seen),
        ("C3", "QQQ", dt.date(2025, 1, 17), "put", 400.0, seen, seen),
    ], "contract string, underlying_symbol string, exp_date date, option_type string, strike double, "
       "first_seen_at timestamp, last_seen_at timestamp")
    store.replace("contracts", contracts)
    symbols = spark.createDataFrame([("SPY", "stocks", True), ("QQQ", "stocks", False), ("XYZ", "otc", True)],
                                    "underlying_symbol string, market string, active boolean")
    store.replace("underlying_symbols", symbols.withColumn("fetched_at", F.lit(seen)))
    minutes = [("C1", dt.datetime(2025, 1, 3, 14, 30) + dt.timedelta(minutes=i), 1.0 + i, 2.0 + i, 0.5 + i,
                1.5 + i, 10.0, 1.2 + i) for i in range(30)]
    bars = spark.createDataFrame(minutes, "contract string, tradetime timestamp, open double, high double, "
                                          "low double, last double, volume double, vwap double")
    store.overwrite_partitions("bars", bars)
    return store


def test_contracts_filters_and_sort(spark, tmp_path):
    store = _store(spark, tmp_path)
    out = api.contracts(store, underlying_symbol="SPY", exp_date_to="2025-01-31")
    assert [r.contract for r in out.collect()] == ["C1"]
    out = api.contracts(store, option_type="put", sort="-strike")
    assert [r.contract for r in out.collect()] == ["C1", "C3"]
    out = api.contracts(store, strike_from=455, fields="contract,strike")
    assert out.columns == ["contract", "strike"] and [r.contract for r in out.collect()] == ["C2"]


def test_symbols_defaults(spark, tmp_path):
    store = _store(spark, tmp_path)
    assert [r.underlying_symbol for r in api.symbols(store).collect()] == ["SPY"]
    assert [r.underlying_symbol for r in api.symbols(store, market=None, active=None).collect()] == ["QQQ", "SPY", "XYZ"]


def test_bars_rebar_15_minutes(spark, tmp_path):
    store = _store(spark, tmp_path)
    out = api.bars(store, "C1", "2025-01-03", "2025-01-03", multiplier=15, timespan="minute").collect()
    assert [r.tradetime for r in out] == [dt.datetime(2025, 1, 3, 14, 30), dt.datetime(2025, 1, 3, 14, 45)]
    first = out[0]
    assert (first.open, first.high, first.low, first.last, first.volume) == (1.0, 16.0, 0.5, 15.5, 150.0)
    assert abs(first.vwap - (sum(1.2 + i for i in range(15)) / 15)) < 1e-9
    one = api.bars(store, "C1", "2025-01-03", "2025-01-03", multiplier=1, timespan="minute", sort="desc").collect()
    assert [r.last for r in one] == [30.5 - i for i in range(30)]
    none = api.bars(store, "C1", "2025-01-04", "2025-01-05").collect()
    assert none == []


def test_readme_landing_to_store_flow(spark, tmp_path):
    import json

    from optlake.operators.normalize import normalize_eod
    from optlake.sources.pages import page_records, parse_pages, read_page_files

    def page(ask):
        stamp = int(dt.datetime(2026, 3, 9, 15, tzinfo=dt.timezone.utc).timestamp()) * 10**9
        return {"results": [{"details": {"ticker": "O:KLMN261218P00040000", "contract_type": "put", "expiration_date": "2026-12-18",
                                         "strike_price": 40.0}, "underlying_asset": {"ticker": "KLMN"},
                             "day": {"last_updated": stamp}, "last_quote": {"bid": ask - 0.25, "ask": ask}}]}

    for n, ask in enumerate((2.5, 2.75)):
        (tmp_path / f"p{n}.json").write_text(json.dumps(page(ask)))
    store = TableStore(spark, str(tmp_path / "store"))
    pages = page_records(parse_pages(read_page_files(spark, str(tmp_path / "p*.json"))))
    rows = normalize_eod(pages, keep=["page_id", "pos"])
    store.upsert_eod(rows.withColumn("fetched_at", F.lit("2026-03-10 21:00:00").cast("timestamp"))
                         .withColumn("seq", F.struct("page_id", "pos")).drop("page_id", "pos"))
    out = api.eod(store, underlying_symbol="KLMN", option_type="put", exp_date_eq="2026-12-18",
                  tradetime_from="2026-03-09", tradetime_to="2026-03-12", sort="-strike").collect()
    assert len(out) == 1 and (out[0].bid, out[0].ask, out[0].tradetime) == (2.5, 2.75, dt.date(2026, 3, 9))


def test_results_are_whole(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "whole"))
    seen = dt.datetime(2026, 1, 2)
    store.replace("contracts", spark.range(3000).select(
        F.format_string("C%05d", "id").alias("contract"), F.lit("KLMN").alias("underlying_symbol"), F.lit("put").alias("option_type"),
        (F.col("id") % 7).cast("double").alias("strike"), F.lit(seen).alias("first_seen_at"), F.lit(seen).alias("last_seen_at")))
    assert api.contracts(store).count() == api.contracts(store, limit=2500).count() == 3000
    store.upsert_bars(spark.range(60_000).select(
        F.lit("C").alias("contract"), F.timestamp_seconds(F.lit(1_772_000_000) + F.col("id") * 60).alias("tradetime"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "last", "volume", "vwap")], F.col("id").alias("seq")))
    assert api.bars(store, "C", "2026-01-01", "2026-12-31", 1, "minute").count() == 60_000


def test_cursor_reaches_every_row(spark):
    from optlake.operators.filters import ordered_page

    rows = spark.range(2600).select(F.format_string("C%05d", "id").alias("contract"),
                                    F.when(F.col("id") % 5 > 0, (F.col("id") % 11).cast("double")).alias("strike"))
    for sort in ("-strike", "strike", None, "contract"):
        got, after = [], None
        while page := ordered_page(rows, sort, ["contract"], after=after).collect():
            got += page
            after = page[-1].asDict()
        whole = rows.orderBy(*([F.col("strike").desc_nulls_last()] if sort == "-strike" else
                               [F.col("strike").asc_nulls_last()] if sort == "strike" else []), "contract").collect()
        assert got == whole


def test_calendar_and_fine_bars(spark, tmp_path):
    store = _store(spark, tmp_path)
    week, = api.bars(store, "C1", "2025-01-01", "2025-01-31", 1, "week").collect()
    assert week.tradetime == dt.datetime(2024, 12, 30) and week.volume == 300.0  # a Monday
    for span, start in (("month", (2025, 1, 1)), ("quarter", (2025, 1, 1)), ("year", (2025, 1, 1))):
        bar, = api.bars(store, "C1", "2025-01-01", "2025-01-31", 1, span).collect()
        assert bar.tradetime == dt.datetime(*start) and bar.open == 1.0
    two, = api.bars(store, "C1", "2025-01-01", "2025-01-31", 2, "month").collect()
    assert two.tradetime == dt.datetime(2025, 1, 1)
    import pytest
    with pytest.raises(ValueError):
        api.bars(store, "C1", "2025-01-03", "2025-01-03", 30, "second")


def test_cached_answers_or_tells_what_to_fetch(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "cache"))
    days = [dt.date(2025, 1, d) for d in (2, 3, 6, 7, 8, 9)]
    schema = ("contract string, tradetime timestamp, underlying_symbol string, option_type string, strike double, bid double, "
              "fetched_at timestamp, seq int")
    held = [("C1", d) for d in days] + [("C2", d) for d in (days[0], days[3])]
    store.upsert_eod(spark.createDataFrame([(c, dt.datetime(d.year, d.month, d.day, 15), "SPY", "put", 1.0, 2.0, dt.datetime(2025, 1, 10), i)
                                            for i, (c, d) in enumerate(held)], schema))
    asked = spark.createDataFrame([(1, "C1", days[1], days[4]), (2, "C2", days[0], days[5]), (3, "C2", days[0], days[4]), (4, "C9", days[0], days[5]),
                                   (5, "C9", days[1], days[3])], "request_id long, contract string, start_date date, end_date date")
    rows, fetch = api.cached(store, asked)
    assert sorted((r.request_id, r.tradetime) for r in rows.collect()) == [(1, d) for d in days[1:5]]
    assert sorted((r.contract, r.gap_from, r.gap_to, r.gap_days) for r in fetch.collect()) == [
        ("C2", days[1], days[2], 2), ("C2", days[4], days[5], 2), ("C9", days[0], days[5], 6)]
    rows, _ = api.cached(store, asked, tolerance_days=3)
    assert {r.request_id for r in rows.collect()} == {1, 2, 3}
