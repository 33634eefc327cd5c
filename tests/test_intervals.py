"""Interval algebra of coverage, request subsumption, sliding peaks, as-of legs and page chains against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from optlake.operators import coverage as C
from optlake.operators import requests as L
from optlake.operators import strategy as G
from optlake.operators.filters import after_cursor, numbered_pages, ordered_page
from optlake.operators.page_chains import page_positions
from support import rows

DAY0 = dt.date(2025, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


@pytest.fixture
def coverage(spark):
    r = random.Random(3)
    trade = [n for n in range(200) if n % 7 not in (5, 6)]
    held = [(f"C{c}", day(n)) for c in range(5) for n in trade if r.random() < (0.2, 0.5, 0.9, 1.0, 0.0)[c]]
    held += held[:40]  # repeated rows
    asked = [(i, r.choice([f"C{c}" for c in range(6)] + [None]), day(a), day(a + r.choice([0, 3, 20, 150])))
             for i, a in ((i, r.randrange(-20, 200)) for i in range(120))]
    asked.append((999, "C1", day(50), day(40)))  # an empty window
    frame = spark.createDataFrame(held, "contract string, tradetime date")
    return frame, spark.createDataFrame(asked, "request_id long, contract string, start_date date, end_date date"), \
        spark.createDataFrame([(day(n),) for n in trade], "day date"), held, asked, trade


@pytest.mark.parametrize("bucket", [64, 3])
def test_gap_intervals(coverage, monkeypatch, bucket):
    monkeypatch.setattr(C, "BUCKET_DAYS", bucket)
    held_df, asked_df, cal, held, asked, trade = coverage
    got = rows(C.gap_intervals(asked_df, held_df, ["contract"], calendar=cal), "request_id", "gap_from", "gap_to", "gap_days")
    have, want = set(held), []
    for i, c, a, b in asked:
        run = []
        for d in [day(n) for n in trade if a <= day(n) <= b] + [None]:
            if d is not None and (c, d) not in have:
                run.append(d)
            elif run:
                want.append((i, run[0], run[-1], len(run)))
                run = []
    assert got == sorted(want)


def test_gap_intervals_expand_to_gaps(coverage):
    held_df, asked_df, cal, *_ = coverage
    spans = C.gap_intervals(asked_df, held_df, ["contract"], calendar=cal)
    days = spans.join(cal, F.col("day").between(F.col("gap_from"), F.col("gap_to")))
    named = asked_df.where("contract is not null")
    want = C.gaps(named.where("start_date <= end_date"), held_df, ["contract"], calendar=cal)
    assert rows(days.where("contract is not null"), "request_id", "day") == rows(want, "request_id", "missing_day")


def test_cached_rows_answer_or_tell_what_to_fetch(spark, coverage):
    held_df, _, cal, held, *_ = coverage
    asked = spark.createDataFrame([(1, "C3", day(0), day(30)), (2, "C0", day(-90), day(30)), (3, "C9", day(0), day(4)), (4, "C3", None, None)],
                                  "request_id long, contract string, start_date date, end_date date")
    got, missing = C.cached_rows(asked, held_df, ["contract"], tolerance=2, calendar=cal)
    inside = [d for c, d in held if c == "C3" and d <= day(30)]
    assert rows(got.where("request_id = 1"), "tradetime") == sorted((d,) for d in inside)
    assert got.where("request_id = 4").count() == len([1 for c, _ in held if c == "C3"])
    assert {r.request_id for r in got.collect()} == {1, 4} and {r.request_id for r in missing.collect()} == {2, 3}
    assert rows(missing.where("request_id = 3"), "gap_from", "gap_to") == [(day(0), day(4))]


def test_minimal_requests(spark):
    r = random.Random(5)
    asked = [(i, r.choice("ab"), day(a), day(a + r.randrange(0, 40))) for i, a in ((i, r.randrange(0, 60)) for i in range(150))]
    asked += [(200, "c", None, day(9)), (201, "c", day(0), day(9)), (202, "c", day(3), None), (203, "c", None, day(9)), (204, "d", day(1), day(1))]
    df = spark.createDataFrame(asked, "request_id long, signature string, start_date date, end_date date")
    low, high = dt.date.min, dt.date.max
    span = {i: (s, a or low, b or high) for i, s, a, b in asked}

    def within(i, j):
        (s, a, b), (t, c, d) = span[i], span[j]
        return s == t and c <= a and b <= d and ((c, d) != (a, b) or j < i)

    want = sorted(i for i in span if not any(within(i, j) for j in span if j != i))
    assert [i for i, in rows(C.minimal_requests(df), "request_id")] == want


def test_sliding_peaks(spark, monkeypatch):
    r = random.Random(7)
    t0 = dt.datetime(2025, 1, 3, 9)
    log = [(r.choice(["x", "y"]), t0 + dt.timedelta(microseconds=r.randrange(0, 1800 * 10**6))) for _ in range(300)]
    log += [("x", t0 + dt.timedelta(seconds=600 + s)) for s in (-60, -59, -1, 0, 0, 0, 59, 60)] + [("z", None)]
    df = spark.createDataFrame(log, "endpoint string, created_at timestamp")
    for part in (600, 60, 3600):
        monkeypatch.setattr(L, "PART_SECONDS", part)
        got = {(e, at): n for e, at, n in rows(L.sliding_counts(df, ["endpoint"]), "endpoint", "at", "requests")}
        want = {(e, at): sum(1 for f, b in log if f == e and b and at - dt.timedelta(seconds=60) < b <= at) for e, at in log if at}
        assert got == want
    peaks = {(e, m): n for e, m, n in rows(L.peak_rate(df, ["endpoint"], "minute"), "endpoint", "minute", "peak_requests")}
    assert all(n == max(k for (f, at), k in want.items() if f == e and at.replace(second=0, microsecond=0) == m) for (e, m), n in peaks.items())


CHAIN = "underlying_symbol string, tradetime date, exp_date date, option_type string, contract string, strike double, midpoint double"


@pytest.mark.parametrize("part", [500_000, 7])
def test_nearest_strike(spark, monkeypatch, part):
    """Every entry row keeps its own leg: equal rows, ties in distance, equal strikes, targets outside the chain."""
    monkeypatch.setattr(G, "PART_ENTRIES", part)
    r = random.Random(9)
    chain = [(s, DAY0, day(90), "put", f"{s}{k:02d}", float(r.randrange(10, 40)), k / 4) for s in "AB" for k in range(25)]
    chain += [("A", DAY0, day(90), "put", "A99", None, 1.0), (None, DAY0, day(90), "put", "N", 12.0, 1.0)]
    entries = [(r.choice("ABZ"), DAY0, day(90), "put", i % 50, r.choice([r.randrange(0, 100) / 2, 25.0])) for i in range(120)]
    entries += [entries[0]] * 5 + [("A", DAY0, day(90), "put", 1, None), (None, DAY0, day(90), "put", 1, 12.0)]
    e = spark.createDataFrame(entries, "underlying_symbol string, tradetime date, exp_date date, option_type string, n int, target double")
    got = rows(G.nearest_strike(e, spark.createDataFrame(chain, CHAIN)), "underlying_symbol", "n", "target", "contract", "strike", "midpoint")
    want = []
    for s, _, _, _, n, target in entries:
        legs = [(abs(k - target), k, c, m) for u, _, _, _, c, k, m in chain if u == s and s and k is not None] if target is not None else []
        if legs:
            _, k, c, m = min(legs)
            want.append((s, n, target, c, k, m))
    assert got == sorted(want)


def test_page_chains(spark):
    nxt = {}
    for c, n in enumerate([1, 2, 7, 33]):  # whole chains, names in no order
        urls = [f"u{hash((c, i)) % 10**9}-{c}-{i}" for i in range(n)]
        nxt.update(zip(urls, [*urls[1:], None]))
        if c == 3:
            long = urls
    nxt |= {"b0": "b1", "b1": "b2", "b3": None}                # b2 never landed, b3 is a chain of its own
    nxt |= {"c0": "c1", "c1": "c2", "c2": "c0", "s": "s"}      # cycles
    nxt |= {"f1": "f9", "f2": "f9", "f9": None}                # two pages name one next page
    df = spark.createDataFrame(list(nxt.items()) + [(None, "b0")], "url string, next_url string")
    got = {r.url: r for r in page_positions(df).collect()}
    assert set(got) == set(nxt)
    assert [(got[u].chain, got[u].pos, got[u].pages, got[u].status) for u in long] == [(long[0], i, 33, "complete") for i in range(33)]
    assert [(got[u].chain, got[u].pos, got[u].status) for u in ("b0", "b1", "b3")] == [("b0", 0, "broken"), ("b0", 1, "broken"), ("b3", 0, "complete")]
    assert all((got[u].chain, got[u].pos, got[u].status) == (None, None, "cycle") for u in ("c0", "c1", "c2", "s"))
    assert [(got[u].chain, got[u].pos, got[u].status) for u in ("f1", "f9", "f2")] == [("f1", 0, "complete"), ("f1", 1, "complete"), ("f2", 0, "forked")]
    assert page_positions(spark.createDataFrame([], "url string, next_url string")).count() == 0


def test_pages_are_those_of_the_cursor(spark):
    df = spark.createDataFrame([(f"K{i % 40:02d}", None if i % 9 == 0 else float(i % 7)) for i in range(40)], "contract string, strike double")
    got = {(r.contract): r.page for r in numbered_pages(df, "-strike", ["contract"], limit=15).collect()}
    after = None
    for n in range(3):
        page = ordered_page(df, "-strike", ["contract"], limit=15, after=after).collect()
        assert {r.contract for r in page} == {c for c, p in got.items() if p == n}
        after = page[-1].asDict()
    assert df.where(after_cursor("-strike", df.columns, ["contract"], after)).count() == 0


def test_islands_are_found_without_an_aggregate_over_them(spark):
    from optlake.operators.coverage import held_islands, numbered_calendar
    from optlake.session import materialize

    day = lambda n: dt.date(2026, 3, 1) + dt.timedelta(days=n)
    cal = materialize(numbered_calendar(spark.createDataFrame([(day(n),) for n in range(12)], "day date")), "calendar")
    places = {"A": [0, 1, 2, 5, 7, 8, 11], "B": [3], None: [1, 2]}
    held = spark.createDataFrame([(k, day(n)) for k, at in places.items() for n in at + at[:1]], "contract string, tradetime date")
    found = held_islands(held, ["contract"], cal)
    plan = found._jdf.queryExecution().executedPlan().toString()
    got = sorted(((r.contract or "", r.lo, r.hi) for r in found.collect()))
    assert got == [("", 1, 2), ("A", 0, 2), ("A", 5, 5), ("A", 7, 8), ("A", 11, 11), ("B", 3, 3)]
    assert plan.count("HashAggregate") == 2  # both halves of the distinct days
