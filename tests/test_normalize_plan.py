"""F8: the chain normaliser runs as compiled code and keeps its rules for odd records."""

import contextlib
import datetime as dt
import io
import json
import re

from optlake.operators.normalize import normalize_eod
from optlake.sources.pages import page_records, parse_pages

COLUMNS = ["contract", "tradetime", "underlying_symbol", "exp_date", "option_type", "strike", "bid", "ask", "volatility",
           "delta", "volume", "bid_date"]
JVM_COMPILES = 8000  # bytes of a method; longer ones stay in the JVM's interpreter


def _rows(spark, *pages, columns=COLUMNS):
    df = spark.createDataFrame([(f"p{n}", json.dumps(page)) for n, page in enumerate(pages)], "page_id string, page_text string")
    return normalize_eod(page_records(parse_pages(df)), columns=columns)


def test_chain_methods_are_short_enough_for_the_compiler(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            _rows(spark, {"results": [{"contract": "C"}]}).select(*COLUMNS).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) <= JVM_COMPILES


def test_odd_members_of_chain_records(spark):
    utc = dt.datetime.fromisoformat
    pages = [
        {"results": [
            # members that are no objects; the record's own fields remain
            {"contract": "A", "details": "text", "greeks": [1], "day": 7, "last_quote": None, "bid": 1.5, "delta": 0.25},
            # a present null wins over a lower candidate, also among candidates of one converter
            {"contract": "B", "details": {"ticker": None, "strike_price": None, "strike": 9}, "strike": 8,
             "last_quote": {"bid": None, "last_updated": None}, "bid": 3, "bid_date": "2024-01-02", "greeks": {"delta": None}},
            # lower candidates of another converter are used when the named one is absent
            {"contract": "C", "day": {"volume": 2}, "tradetime": "01/31/2024", "last_quote": {"ask": 4}, "bid_date": 1704153600000000000},
            # nanoseconds before 1970 go down
            {"contract": "D", "day": {"last_updated": -1}, "last_quote": {"last_updated": -1001}},
            # legacy: attributes only, whatever else the record has
            {"contract": "no", "details": {"ticker": "no"}, "day": {"last_updated": 5}, "strike": 1, "implied_volatility": 2,
             "attributes": {"contract": "E", "option_type": "", "type": "put", "tradetime": "20240131", "bid_date": "x"}},
        ]},
        {"results": {"contract": "F", "attributes": None, "volatility": "0.5", "implied_volatility": "n/a"}},
        {"results": None, "data": [{"contract": "G", "option_type": "", "attributes": 3}, 5, None]},
        {"results": {}, "data": [{"contract": "unused"}]},
    ]
    got = {r.contract: r for r in _rows(spark, *pages).where("contract is not null").collect()}
    assert sorted(got) == ["A", "C", "D", "E", "F", "G"]
    assert (got["A"].bid, got["A"].delta, got["A"].tradetime, got["A"].bid_date) == (1.5, 0.25, None, None)
    c = got["C"]
    assert (c.volume, c.tradetime, c.ask, c.bid, c.bid_date) == (2.0, dt.date(2024, 1, 31), 4.0, None, utc("2024-01-02T00:00:00"))
    assert (got["D"].tradetime, got["D"].bid_date) == (dt.date(1969, 12, 31), utc("1969-12-31T23:59:59.999998"))
    e = got["E"]
    assert (e.option_type, e.tradetime, e.bid_date, e.strike, e.volatility) == ("put", dt.date(2024, 1, 31), None, None, None)
    assert (got["F"].volatility, got["G"].option_type) == (None, "")
    nameless = [r for r in _rows(spark, *pages).where("contract is null").collect()]
    # B, whose ticker is a present null; 5, null and {}
    assert len(nameless) == 4 and all(getattr(r, c) is None for r in nameless for c in COLUMNS)


def test_a_member_read_as_value_and_as_object(spark):
    from pyspark.sql import functions as F

    from optlake.operators.normalize import Keys, with_objects

    keys = Keys()
    inner, whole = keys.field("day", "open"), keys.field("rec", "day")
    df = spark.createDataFrame([('{"day": {"open": 2}}',)], "t string").select(F.parse_json("t").alias("record"))
    out = with_objects(df, "record", {"rec": "$", "day": "$.day"}, keys).select(inner.cast("int"), F.to_json(whole)).collect()
    assert [tuple(r) for r in out] == [(2, '{"open":2}')]
