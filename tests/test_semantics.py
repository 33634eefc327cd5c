"""
without a vendor)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from optlake.functions.dates import parse_bound, parse_date_arg
from optlake.functions.keys import first_non_empty, request_signature
from optlake.operators.coverage import coverage_status
from optlake.operators.filters import FilterSet, apply_filter_set, ordered_page, resolve_window, sort_columns
from optlake.operators.merge import keep_last, merge_keep_last
from optlake.operators.normalize import normalize_contracts, normalize_eod, normalize_symbols
from optlake.operators.tasks import task_state
from optlake.sources.pages import page_records, parse_pages
from support import rows


def _recs(spark, page):
    df = spark.createDataFrame([("p", json.dumps(page))], "page_id string, page_text string")
    return page_records(parse_pages(df))


def test_q1_first_load_is_deduped(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 1), ("a", 1, 2.0, 2)], "k string, t int, v double, seq int")
    assert rows(keep_last(df, ["k", "t"]), "k", "v") == [("a", 2.0)]


def test_q3_contracts_keep_one_row_per_contract(spark):
    recs = [{"ticker": "C1", "underlying_ticker": "SPY"}, {"ticker": "C2", "underlying_ticker": "SPY"}]
    out = normalize_contracts(_recs(spark, {"results": recs})).withColumn("seq", F.lit(1))
    assert sorted(r.contract for r in keep_last(out, ["contract"]).collect()) == ["C1", "C2"]


def test_q4_window_does_not_filter_expiry(spark):
    c = spark.createDataFrame([("C1", dt.date(2030, 1, 1))], "contract string, exp_date date")
    assert apply_filter_set(c, FilterSet(tradetime_from="2025-01-01", tradetime_to="2025-01-31")).count() == 1


def test_q6_contract_filter_applies(spark):
    df = spark.createDataFrame([("C1", dt.date(2025, 1, 3)), ("C2", dt.date(2025, 1, 3))], "contract string, tradetime date")
    assert apply_filter_set(df, FilterSet(contract="C2")).collect()[0].contract == "C2"


def test_q7_fields_project(spark):
    df = spark.createDataFrame([("C1", 1.0, 2.0)], "contract string, bid double, ask double")
    assert apply_filter_set(df, FilterSet(fields=" bid, ,contract")).columns == ["bid", "contract"]


def test_q8_sort_direction_honoured(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", None)], "contract string, tradetime int")
    out = [r.contract for r in ordered_page(df, "-tradetime", ["contract"]).collect()]
    assert out == ["b", "a", "c"]
    assert len(sort_columns(None, ["tradetime", "contract"], ["contract"])) == 2


def test_q9_inclusive_whole_days(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 3, 23, 59),), (dt.datetime(2025, 1, 4, 0, 0),)], "tradetime timestamp")
    assert apply_filter_set(df, FilterSet(tradetime_eq="2025-01-03")).count() == 1


def test_q10_zoned_bound_converted_to_utc_first():
    assert parse_date_arg("2025-01-03T23:00:00-05:00") == dt.date(2025, 1, 4)
    assert resolve_window(FilterSet(range_from="2025-01-03T23:00:00-05:00"))[0] == dt.date(2025, 1, 4)


def test_q11_digit_string_is_epoch_ms():
    assert parse_bound("1735914600000") == dt.date(2025, 1, 3)
    assert parse_bound(1735914600000) == dt.date(2025, 1, 3)
    with pytest.raises(ValueError):
        parse_date_arg("no date")


def test_q13_q14_coverage_status(spark):
    held = spark.createDataFrame([("C1", dt.date(2025, 1, 3)), ("C1", dt.date(2025, 1, 31))], "contract string, tradetime date")
    req = spark.createDataFrame([
        (1, "C1", dt.date(2025, 1, 3), dt.date(2025, 1, 31)),
        (2, "C1", dt.date(2025, 1, 1), dt.date(2025, 1, 31)),
        (3, "C9", dt.date(2025, 1, 1), dt.date(2025, 1, 2)),
        (4, "C1", None, None)], "request_id int, contract string, start_date date, end_date date")
    got = {r.request_id: r.status for r in coverage_status(req, held, ["contract"]).collect()}
    assert got == {1: "hit", 2: "partial", 3: "miss", 4: "hit"}
    got = {r.request_id: r.status for r in coverage_status(req, held, ["contract"], tolerance=2).collect()}
    assert got[2] == "hit"


def test_q16_q18_empty_result_is_typed(spark):
    out = normalize_eod(_recs(spark, {"results": []}))
    assert out.count() == 0 and "contract" in out.columns and not [c for c in out.columns if c.startswith("__")]


def test_q17_presence_decides(spark):
    out = normalize_eod(_recs(spark, {"results": [{"bid": 1.0, "last_quote": {"bid": None}}]})).collect()[0]
    assert out.bid is None


def test_q19_upsert_null_overwrites_quote_keeps_raw(spark):
    from optlake.operators.merge import upsert_eod
    held = spark.createDataFrame([("C", 1, 1.0, "old", 450.0)], "contract string, tradetime int, bid double, raw_json string, strike double")
    staged = spark.createDataFrame([("C", 1, None, None, 451.0, 5)],
                                   "contract string, tradetime int, bid double, raw_json string, strike double, seq int")
    r = upsert_eod(held, staged, stamp=None).collect()[0]
    assert (r.bid, r.raw_json, r.strike) == (None, "old", 450.0)


def test_fresh_beats_held_in_merge(spark):
    held = spark.createDataFrame([("C", 1, 9.0, 99)], "contract string, tradetime int, bid double, seq int")
    fresh = spark.createDataFrame([("C", 1, 1.0, 1)], "contract string, tradetime int, bid double, seq int")
    assert merge_keep_last(held, fresh, ["contract", "tradetime"]).collect()[0].bid == 1.0


def test_q22_option_type_or_type(spark):
    df = spark.createDataFrame([("", "put"), (None, "call"), ("put", "call")], "a string, b string")
    assert [r.x for r in df.select(first_non_empty(F.col("a"), F.col("b")).alias("x")).collect()] == ["put", "call", "put"]


def test_q24_q25_task_state_rules(spark):
    ev = spark.createDataFrame([
        (1, 1, "claimed", True, "w1", 0, None), (1, 2, "failed", True, "w1", 0, "boom"),        # retry -> pending
        (2, 1, "claimed", True, "w2", 0, None), (2, 2, "failed", False, "w2", 0, "fatal"),      # not retryable
        (3, 1, "claimed", True, "w3", 0, None), (3, 2, "completed", True, "w3", 50, None),      # completed keeps claim
        (4, 1, "failed", True, "w", 0, "a"), (4, 2, "failed", True, "w", 0, "b"), (4, 3, "failed", True, "w", 0, "c"),
    ], "task_id int, seq int, kind string, retryable boolean, worker string, rows_inserted long, message string")
    ev = ev.withColumn("at", F.to_timestamp(F.lit("2025-01-03")) + F.make_interval(mins=F.col("seq")))
    got = {r.task_id: r for r in task_state(ev).collect()}
    assert got[1].status == "pending" and got[1].claimed_by is None and got[1].retry_count == 1
    assert got[2].status == "failed" and got[2].last_error == "fatal"
    assert got[3].status == "completed" and got[3].claimed_by == "w3" and got[3].rows_inserted == 50
    assert got[4].status == "failed" and got[4].retry_count == 3 and got[4].last_error == "c"


def test_q29_ticker_objects_give_symbol(spark):
    out = normalize_symbols(_recs(spark, {"results": [{"ticker": "AAPL", "market": "stocks", "active": True}]})).collect()[0]
    assert (out.underlying_symbol, out.market, out.active) == ("AAPL", "stocks", True)


def test_c4_signature_matches_canonical_json(spark):
    import hashlib
    df = spark.createDataFrame([("C1", None)], "contract string, t string")
    sig = df.select(request_signature("eod", {"filter[contract]": F.col("contract"), "filter[type]": F.col("t"),
                                              "page[limit]": F.lit(1000),
                                              "filter[tradetime_eq]": F.lit("2025-01-03")}).alias("s")).collect()[0].s
    payload = json.dumps({"endpoint": "eod", "params": {"filter[contract]": "C1"}}, sort_keys=True, separators=(",", ":"))
    assert sig == hashlib.sha1(payload.encode()).hexdigest()


def test_q2_typed_key_dedupes_date_and_midnight_text(spark):
    recs = [{"contract": "C1", "tradetime": "2025-01-03", "bid": 1.0},
            {"contract": "C1", "tradetime": "2025-01-03 00:00:00", "bid": 2.0}]
    rows = normalize_eod(_recs(spark, {"results": recs}), keep=["pos"]).withColumnRenamed("pos", "seq")
    out = keep_last(rows.select("contract", "tradetime", "bid", "seq"), ["contract", "tradetime"]).collect()
    assert [(r.contract, r.bid) for r in out] == [("C1", 2.0)]


def test_q20_bad_rows_quarantined_with_reasons(spark):
    from optlake.operators.checks import OPTION_TYPES, validate

    df = spark.createDataFrame([("C1", "put", 1.0), (None, "put", 1.0), ("C3", "straddle", None)],
                               "contract string, option_type string, bid double")
    good, bad = validate(df, not_null=["contract"], allowed={"option_type": OPTION_TYPES},
                         rules={"bid missing": F.col("bid").isNull()})
    assert [r.contract for r in good.collect()] == ["C1"]
    got = sorted((r.contract or "", list(r.reasons)) for r in bad.collect())
    assert got == [("", ["contract is null"]), ("C3", ["option_type not allowed", "bid missing"])]
