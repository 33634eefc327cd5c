"""Curve layout, files with differing headers, latency sketches."""

import datetime as dt
import gzip
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from optlake.operators import layout as Y
from optlake.operators import requests as L
from optlake.sources.flatfiles import read_reconciled_csv
from support import rows

EOD = "contract string, tradetime date, exp_date date, strike double, n int"
DAY0 = dt.date(2025, 1, 1)


def _quotes(spark):
    r = random.Random(4)
    data = [(f"C{c:04d}", DAY0 + dt.timedelta(days=d), DAY0 + dt.timedelta(days=100 + 30 * (c % 12)), float(r.randrange(50, 150)), c * 40 + d)
            for c in range(300) for d in range(40)]
    r.shuffle(data)
    return spark.createDataFrame(data + [(None, None, None, None, -1)], EOD)


def _groups_read(path, column, low, high):
    """Row groups whose statistics leave a value in [low, high] possible, and all row groups."""
    hit = total = 0
    for f in path.glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            total += 1
            hit += s.has_min_max and s.min <= high and s.max >= low
    return hit, total


ASKED = [("contract", "C0100", "C0110"), ("tradetime", DAY0, DAY0 + dt.timedelta(days=2)), ("exp_date", DAY0 + dt.timedelta(days=130), DAY0 + dt.timedelta(days=130)),
         ("strike", 60.0, 64.0)]


def test_every_filter_skips_row_groups(spark, tmp_path):
    quotes, columns = _quotes(spark), ["contract", "tradetime", "exp_date", "strike"]
    Y.with_curve(quotes, columns).write.parquet(str(tmp_path / "curved"))
    Y.along_curve(spark.read.parquet(str(tmp_path / "curved")), columns, 64).write.parquet(str(tmp_path / "laid"))
    quotes.repartitionByRange(64, *columns).sortWithinPartitions(*columns).write.parquet(str(tmp_path / "sorted"))
    assert sorted(rows(spark.read.parquet(str(tmp_path / "laid")), "n")) == sorted(rows(quotes, "n"))
    laid = [_groups_read(tmp_path / "laid", *a) for a in ASKED]
    plain = [_groups_read(tmp_path / "sorted", *a) for a in ASKED]
    assert all(hit <= 0.7 * total for hit, total in laid), laid
    assert sum(hit / total > 0.9 for hit, total in plain) >= 2, plain
    assert max(hit / total for hit, total in laid) < max(hit / total for hit, total in plain)


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(0b101, 0b011)], "a int, b int")
    assert df.select(Y.interleave([F.col("a"), F.col("b")], 3).alias("z")).first().z == 0b100111
    with pytest.raises(ValueError):
        Y.interleave([F.col("a")] * 8, 8)
    got = Y.with_curve(spark.createDataFrame([(1.0, "x"), (None, "y"), (3.0, None)], "a double, b string"), ["a", "b"], bits=2)
    assert len(rows(got, "__curve")) == 3


def test_mixed_headers(spark, tmp_path):
    def put(day, name, text):
        d = tmp_path / f"day={day}"
        d.mkdir(exist_ok=True)
        with gzip.open(d / name, "wt") as f:
            f.write(text)

    put("2025-01-01", "a.csv.gz", "ticker,volume,close\nA,1,2.5\nB,2,\n")
    put("2025-01-01", "b.csv.gz", ' Close ,"TICKER",volume\n3.5,"A, Inc",x\n')
    put("2025-01-02", "c.csv.gz", "ticker,close\nC,9.0\n")
    put("2025-01-02", "d.csv.gz", "ticker,volume,close,venue\nD,1,1.0,N\n")
    put("2025-01-03", "e.csv.gz", "ticker,ticker,close\nE,E,1.0\n")
    put("2025-01-03", "f.csv.gz", "ticker,volume,close\n")
    schema = spark.createDataFrame([], "ticker string, volume long, close double").schema
    got, bad = read_reconciled_csv(spark, str(tmp_path / "day=*/*.csv.gz"), schema)
    assert rows(got, "ticker", "volume", "close") == [("A", 1, 2.5), ("A, Inc", None, 3.5), ("B", 2, None)]
    why = {r.file.rsplit("/", 1)[1]: (r.reasons, str(r.file_date)) for r in bad.collect()}
    assert why == {"c.csv.gz": (["missing column volume"], "2025-01-02"), "d.csv.gz": (["unknown column venue"], "2025-01-02"),
                   "e.csv.gz": (["missing column volume", "repeated column"], "2025-01-03")}
    some, rest = read_reconciled_csv(spark, str(tmp_path / "day=*/*.csv.gz"), schema, required=["ticker", "close"])
    assert ("C", None, 9.0) in [tuple(r) for r in some.select("ticker", "volume", "close").collect()] and rest.count() == 2


def test_sketches_merge_within_their_error(spark):
    r = random.Random(6)
    log = [(r.choice("xy"), d, int(r.lognormvariate(4, 1))) for d in range(5) for _ in range(8000)] + [("x", 0, None), ("z", 1, None)]
    df = spark.createDataFrame(log, "endpoint string, day int, elapsed_ms long")
    per_day = L.latency_sketches(df, ["endpoint", "day"])
    merged, whole = L.merge_latency(per_day, ["endpoint"]), L.latency_sketches(df, ["endpoint"])
    facts = ["endpoint", "requests", "timed", "total_ms", "max_ms"]
    assert rows(merged, *facts[:2], *facts[2:3]) == rows(whole, *facts[:2], *facts[2:3])
    shares = [0.01, 0.25, 0.5, 0.9, 0.99]
    for frame in (merged, whole, L.merge_latency(per_day.where("day < 3"), ["endpoint"])):
        days = 3 if frame is not merged and frame is not whole else 5
        for row in L.sketch_percentiles(frame, shares).collect():
            values = [m for e, d, m in log if e == row.endpoint and m is not None and d < days]
            below, upto = (sum(m < row.ms for m in values) / len(values), sum(m <= row.ms for m in values) / len(values))
            assert below <= row.share + L.SKETCH_ERROR and upto >= row.share - L.SKETCH_ERROR, (row, below, upto)
            assert row.max_ms == max(values)
    assert {r.endpoint for r in L.sketch_percentiles(merged, shares).collect()} == {"x", "y"}


def test_curve_steps_need_no_shuffle_of_the_rows(spark):
    from optlake.operators.layout import scaled_ranks, step_bounds, step_of, with_curve

    df = spark.range(0, 900, 1, 3).select(F.concat(F.lit("O:"), (F.col("id") * 7 % 500).cast("string")).alias("c"),
                                          F.when(F.col("id") % 9 != 0, (F.col("id") % 31) / 4).alias("x"),
                                          F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("d"))
    assert "Exchange" not in with_curve(df, ["c", "x", "d"], bits=4)._jdf.queryExecution().executedPlan().toString()
    for c in df.columns:
        step = step_of(F.col(c), step_bounds(df, c, 4), df.schema[c].dataType)
        exact = {r.value: r.step for r in scaled_ranks(df, c, 4).collect()} | {None: 0}
        assert all(exact[r.v] == r.s for r in df.select(F.col(c).alias("v"), step.alias("s")).collect())
