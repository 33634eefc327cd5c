"""Hand-written vendor records (made up for these tests) and the rows they
must give: record shapes, trade windows, bars, symbols, the upsert rules, task
summaries and edge pages."""

import datetime as dt
import json
import os

import pytest

from optlake.operators.filters import FilterSet, apply_filter_set
from optlake.operators.merge import upsert_eod
from optlake.operators.normalize import normalize_bars, normalize_contracts, normalize_eod, normalize_symbols
from optlake.operators.tasks import job_summary
from optlake.sources.pages import page_records, parse_pages

CALL = "O:KLMN261218C00072500"
UTC = dt.timezone.utc


def _records(spark, *pages):
    df = spark.createDataFrame([(f"p{i}", json.dumps(p)) for i, p in enumerate(pages)], "page_id string, page_text string")
    return page_records(parse_pages(df))


def _nanos(*when):
    return int(dt.datetime(*when, tzinfo=UTC).timestamp()) * 10**9


def _millis(*when):
    return int(dt.datetime(*when, tzinfo=UTC).timestamp()) * 1000


def test_legacy_record(spark):
    attributes = {"contract": CALL, "underlying_symbol": "KLMN", "exp_date": "2026-12-18", "type": "call", "strike": 72.5,
                  "bid": 3.05, "ask": 3.45, "midpoint": 3.25, "tradetime": "2026-03-09"}
    page = {"data": [{"id": "row-17", "type": "quotes", "attributes": attributes}], "links": {}}
    r, = normalize_eod(_records(spark, page)).collect()
    assert (r.response_id, r.response_type, r.contract, r.option_type) == ("row-17", "quotes", CALL, "call")
    assert (r.tradetime, r.exp_date) == (dt.date(2026, 3, 9), dt.date(2026, 12, 18))
    assert (r.bid, r.ask, r.midpoint, r.strike) == (3.05, 3.45, 3.25, 72.5)


def _snapshot(when, midpoint):
    return {"details": {"ticker": CALL, "contract_type": "call", "expiration_date": "2026-12-18", "strike_price": 72.5},
            "underlying_asset": {"ticker": "KLMN"}, "day": {"last_updated": _nanos(*when)}, "last_quote": {"midpoint": midpoint}}


def test_trade_window(spark):
    days = [((2026, 3, 9, 15), 3.2), ((2026, 3, 11, 0, 0, 1), 4.1), ((2026, 3, 12, 23, 59, 59), 4.4)]
    rows = normalize_eod(_records(spark, {"results": [_snapshot(w, m) for w, m in days]}))
    for first, last, want in (("2026-03-09", "2026-03-09", [3.2]), ("2026-03-10", "2026-03-12", [4.1, 4.4]),
                              ("2026-03-01", "2026-03-11", [3.2, 4.1]), ("2026-03-13", "2026-04-01", [])):
        got = apply_filter_set(rows, FilterSet(tradetime_from=first, tradetime_to=last)).orderBy("tradetime")
        assert [r.midpoint for r in got.collect()] == want
    assert {(r.contract, r.underlying_symbol, r.option_type, r.strike) for r in rows.collect()} == {(CALL, "KLMN", "call", 72.5)}


def test_bars_page(spark):
    results = [{"o": 3.0, "h": 3.9, "l": 2.8, "c": 3.6, "t": _millis(2026, 3, 9, 15, 0), "v": 41, "vw": 3.3},
               {"o": 3.6, "h": 3.7, "l": 3.1, "c": 3.2, "t": _millis(2026, 3, 9, 15, 5), "v": 8, "vw": 3.5}]
    out = normalize_bars(_records(spark, {"ticker": CALL, "results": results})).orderBy("tradetime").collect()
    assert [(r.contract, r.tradetime, r.open, r.high, r.low, r.last, r.volume, r.vwap) for r in out] == [
        (CALL, dt.datetime(2026, 3, 9, 15, 0), 3.0, 3.9, 2.8, 3.6, 41.0, 3.3),
        (CALL, dt.datetime(2026, 3, 9, 15, 5), 3.6, 3.7, 3.1, 3.2, 8.0, 3.5)]


def test_bad_bar_times_become_null(spark):
    results = [{"o": 1, "t": t} for t in (10**17, -10**18, 10**30, "soon", None, _millis(2026, 3, 9))]
    out = normalize_bars(_records(spark, {"ticker": CALL, "results": results})).collect()
    assert len(out) == 6 and [r.tradetime for r in out if r.tradetime] == [dt.datetime(2026, 3, 9)]


def test_symbols(spark):
    out = normalize_symbols(_records(spark, {"data": ["KLMN", "OPQ"]}, {"results": [{"ticker": "RST", "market": "otc"}]}))
    assert sorted((r.underlying_symbol, r.market) for r in out.collect()) == [("KLMN", None), ("OPQ", None), ("RST", "otc")]


def test_unknown_keys_stay_in_raw_json(spark):
    page = {"ticker": CALL, "results": [{"o": 1.5, "t": _millis(2026, 3, 9), "otc": True}]}
    bar, = normalize_bars(_records(spark, page), raw=True).collect()
    symbol, = normalize_symbols(_records(spark, {"results": [{"ticker": "RST", "sic": "7"}]}), raw=True).collect()
    assert json.loads(bar.raw_json)["otc"] is True and json.loads(symbol.raw_json)["sic"] == "7"


def test_flat_contract(spark):
    rec = {"ticker": CALL, "underlying_ticker": "KLMN", "contract_type": "call", "expiration_date": "2026-12-18", "strike_price": 72.5}
    r, = normalize_contracts(_records(spark, {"results": [rec]})).collect()
    assert (r.contract, r.underlying_symbol, r.option_type, r.exp_date, r.strike) == (CALL, "KLMN", "call", dt.date(2026, 12, 18), 72.5)


def test_upsert_rules(spark):
    """Identity from the first row, quotes from the last (NULLs too), raw_json the last non-NULL."""
    schema = ("contract string, tradetime date, underlying_symbol string, exp_date date, option_type string, "
              "strike double, bid double, ask double, midpoint double, raw_json string, seq int")
    day = dt.date(2026, 3, 9)

    def row(seq, strike, bid, ask, raw):
        return CALL, day, "KLMN", dt.date(2026, 12, 18), "call", strike, bid, ask, None, raw, seq

    loads = [row(10, 72.5, 3.0, 3.4, "first"), row(20, 72.5, 3.1, None, "second"), row(30, 99.0, None, 3.9, None)]
    wants = [(72.5, 3.0, 3.4, "first"), (72.5, 3.1, None, "second"), (72.5, None, 3.9, "second")]
    for n, want in enumerate(wants, 1):
        r, = upsert_eod(None, spark.createDataFrame(loads[:n], schema), stamp=None).collect()
        assert (r.strike, r.bid, r.ask, r.raw_json) == want


def _tasks(spark, rows):
    return spark.createDataFrame(rows, "task_id long, job_id long, status string, rows_inserted long, api_requests_made long")


def test_job_summary(spark):
    jobs = spark.createDataFrame([(5, "bars"), (6, "eod"), (8, "eod")], "job_id long, endpoint string")
    tasks = _tasks(spark, [(501, 5, "completed", 31, 2), (502, 5, "running", 0, 1), (503, 5, "failed", 7, 4), (601, 6, "completed", 9, 1)])
    got = {r.job_id: (r.requested_tasks, r.completed_tasks, r.failed_tasks, r.inserted_rows, r.api_requests_made,
                      r.api_call_units_estimated, list(r.unresolved_tasks)) for r in job_summary(jobs, tasks, with_ids=True).collect()}
    assert got == {5: (3, 1, 1, 38, 7, 70, [502, 503]), 6: (1, 1, 0, 9, 1, 10, []), 8: (0, 0, 0, 0, 0, 0, [])}


def test_edge_pages(spark):
    single = {"results": {"details": {"ticker": "ONE"}, "day": {"last_updated": _nanos(2026, 3, 9)}}}
    out = normalize_eod(_records(spark, single, {"message": "no rows"})).collect()
    assert [r.contract for r in out] == ["ONE"]


def test_json_null_wins_by_presence(spark):
    rec = {"ask": 8.0, "last_quote": {"ask": None, "bid": 7.5}, "details": {"ticker": "N"}}
    r, = normalize_eod(_records(spark, {"results": [rec]})).collect()
    assert (r.ask, r.bid) == (None, 7.5)


def test_date_forms(spark):
    forms = {"zone": ("2026-03-09T21:30:00-04:00", dt.date(2026, 3, 10)), "bad": ("someday", None),
             "plain": ("2026-03-11", dt.date(2026, 3, 11)), "slash": ("2026/03/12", dt.date(2026, 3, 12)),
             "space": ("2026-03-13 08:15:00", dt.date(2026, 3, 13))}
    recs = [{"contract": k, "tradetime": text} for k, (text, _) in forms.items()]
    out = {r.contract: r.event_date for r in normalize_eod(_records(spark, {"results": recs})).collect()}
    assert out == {k: day for k, (_, day) in forms.items()}


def test_empty_page_list_is_typed(spark):
    empty = spark.createDataFrame([], "page_id string, page_text string")
    out = normalize_eod(page_records(parse_pages(empty)))
    types = dict(out.dtypes)
    assert out.count() == 0 and (types["tradetime"], types["strike"]) == ("date", "double")
    assert not [c for c in out.columns if c.startswith("__")]


def test_page_files(spark, tmp_path):
    from optlake.sources.pages import read_page_files

    (tmp_path / "1.json").write_text(json.dumps({"results": [{"ticker": "LEFT", "strike_price": 2.5}]}))
    (tmp_path / "2.json").write_text(json.dumps({"data": [{"id": "z", "type": "c", "attributes": {"contract": "RIGHT"}}]}))
    recs = page_records(parse_pages(read_page_files(spark, str(tmp_path / "*.json"))))
    assert sorted(r.contract for r in normalize_contracts(recs).collect()) == ["LEFT", "RIGHT"]


def test_page_files_are_written_by_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from optlake.plans.landing import land_page_files
    from optlake.sources.pages import read_page_files

    pages = spark.range(0, 400, 1, 1).select(F.col("id").cast("string").alias("page_id"), F.concat(F.lit('{"n":'), "id", F.lit("}")).alias("page_text"))
    land_page_files(pages, str(tmp_path / "land"))
    files = list((tmp_path / "land").glob("folder=*/part-*.txt"))
    assert len(files) == 400 and not list((tmp_path / "land").glob("part-*"))
    assert len({f.name.split("-")[1] for f in files}) > 40  # the tasks that wrote them
    back = read_page_files(spark, str(tmp_path / "land"))
    assert sorted(json.loads(r.page_text)["n"] for r in back.collect()) == list(range(400))
    assert back.columns == ["page_id", "page_text"]


def _texts(spark, path):
    from pyspark.sql import functions as F

    from optlake.sources.pages import read_page_files

    plain = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path"), F.hex("value"))
    got = read_page_files(spark, path).select("page_id", F.hex("page_text"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    return got.count()


def test_page_files_cost_no_more_than_a_file(spark, tmp_path):
    """No checksum files (and no chmod processes) when landed, no list of all files on the driver when read."""
    from pyspark.sql import functions as F

    from optlake.plans.landing import land_page_files
    from optlake.sources.pages import read_page_files

    pages = spark.range(0, 300, 1, 3).select((F.col("id") % 90).cast("string").alias("page_id"), F.when(F.col("id") != 7, F.concat(F.lit("p\u00e9"), "id")).alias("page_text"))
    root = tmp_path / "land"
    land_page_files(pages, f"file://{root}")
    files = [p for p in root.rglob("*") if p.is_file()]
    assert not [p for p in files if p.suffix == ".crc"]
    assert sorted(p.read_text() for p in files) == sorted("\n" if i == 7 else f"p\u00e9{i}\n" for i in range(300))
    assert all(p.parent.parent == root and p.name.startswith("part-") for p in files) and not (root / "_temporary").exists()
    back = read_page_files(spark, str(root))
    assert len(back.inputFiles()) < 100
    assert _texts(spark, f"file://{root}/") == back.count() == 300
    (root / "folder=0").mkdir(exist_ok=True)
    (root / "folder=0" / "late.txt").write_text("landed after the files were listed")
    assert back.count() == 300 and _texts(spark, str(root)) == 301


def test_landed_pages_of_a_lost_attempt_are_left_out(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from optlake.plans import landing

    moved, rename = [], os.rename

    def stray(at, to):  # an attempt that Spark does not count left files, too
        lost = os.path.join(os.path.dirname(os.path.dirname(at)), "lost", os.path.basename(at))
        os.makedirs(lost)
        with open(f"{lost}/part-00000-lost.txt", "w") as f:
            f.write("twice")
        moved.append(rename(at, to))

    monkeypatch.setattr(landing.os, "rename", stray)
    pages = spark.range(40).select(F.col("id").cast("string").alias("page_id"), F.col("id").cast("string").alias("page_text"))
    landing.land_page_files(pages, str(tmp_path / "land"))
    found = sorted(int(p.read_text()) for p in (tmp_path / "land").rglob("*") if p.is_file())
    assert moved and found == list(range(40))


def test_odd_folders_of_page_files(spark, tmp_path):
    """The rows of Spark's reader, whatever the folder holds."""
    import gzip

    from optlake.sources.pages import read_page_files

    def land(name, **files):
        for at, text in files.items():
            to = tmp_path / name / at.replace("__", "/")
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_bytes(text)
        return str(tmp_path / name)

    (tmp_path / "none").mkdir()
    assert _texts(spark, str(tmp_path / "none")) == 0
    flat = land("flat", **{"a.json": b"A\xff\r\n\x00", "b.json": b"", "_b.json": b"h", ".c.json": b"h", "x=1.json": b"X", "_temporary__d.json": b"t"})
    assert _texts(spark, flat) == _texts(spark, f"file:{flat}") == _texts(spark, f"{flat}//") == 2
    assert _texts(spark, land("days", **{"day=1__a": b"1", "day=x.2__a": b"2", "_SUCCESS": b"", "day=3___x": b"h"})) == 2
    assert _texts(spark, land("loose", **{"day=1__a": b"1", "top": b"not read"})) == 1
    assert _texts(spark, land("deep", **{"day=1__a": b"1", "day=1__hour=2__b": b"2"}) + "/day=1/hour=2") == 1
    assert _texts(spark, land("two", **{"day=1__hour=2__b": b"2", "day=1__hour=3__b": b"3"})) == 2
    assert _texts(spark, land("sub", **{"a": b"1", "more__b": b"not read"})) == 1
    assert _texts(spark, land("packed", **{"a.json.gz": gzip.compress(b"packed"), "b": b"1"})) == 2
    assert _texts(spark, land("names", **{"a b%41.json": b"1", "c": b"2", "_k=1": b"3", "d._COPYING_": b"4"})) == 3
    assert _texts(spark, land("a space", **{"c": b"2"})) == 1
    spark.range(3).selectExpr("string(id)").coalesce(1).write.text(str(tmp_path / "summed"))
    part, = (tmp_path / "summed").glob("part-*")
    assert _texts(spark, str(tmp_path / "summed")) == 1
    part.write_bytes(b"9\n8\n7\n")  # its checksum file tells
    with pytest.raises(Exception):
        read_page_files(spark, str(tmp_path / "summed")).collect()
    with pytest.raises(Exception):
        read_page_files(spark, str(tmp_path / "missing"))


def test_config_to_job_and_result(spark):
    from optlake.config import BackfillConfig, configs_frame
    from optlake.operators.tasks import create_jobs, job_result
    from optlake.schemas import JOB_RESULT

    cfg = configs_frame(spark, [BackfillConfig("bars", underlying_symbol="KLMN", option_type="call", fields=("ask", "strike"), sort="strike")])
    jobs = create_jobs(cfg, order=["underlying_symbol"], max_held_job_id=800)
    j, = jobs.collect()
    assert (j.job_id, j.status, j.page_limit, j.max_pages_per_task, j.fields, j.sort) == (801, "pending", 1000, 25, "ask,strike", "strike")
    tasks = _tasks(spark, [(1, 801, "completed", 14, 6), (2, 801, "completed", 5, 2), (3, 801, "pending", 0, 0)])
    changes = spark.createDataFrame([(801, "updated")] * 2 + [(801, "inserted")], "job_id long, change string")
    r = job_result(jobs.select("job_id", "endpoint", "status"), tasks, changes)
    assert [f.name for f in r.schema.fields] == [f.name for f in JOB_RESULT.fields]
    row, = r.collect()
    assert (row.inserted_rows, row.updated_rows, row.skipped_existing_rows, row.api_call_units_estimated, list(row.unresolved_tasks)) == \
        (19, 2, 0, 80, [3])
