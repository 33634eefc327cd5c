"""Vendor-shaped JSON pages built from the driver's tables (test landing).

Records are grouped into pages by a key range, so a page holds a bounded
number of records at any scale; a third of the pages carry a ``results``
list, a third a single ``results`` object and a third the legacy ``data``
list (bars pages are always ``results`` lists with a page ticker).  Record
order inside a page is fixed by a sort key, so positions are reproducible.
"""

from __future__ import annotations

import os
import shutil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from optlake.plans import fixtures as fx
from optlake.session import local_path

RECORDS_PER_PAGE_KEYS = 300
# Folders that landed page files are spread over.
PAGE_FOLDERS = 128


def _ns(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) * F.lit(1000)


def _assemble(rows: DataFrame, page_id: Column, shape: Column, sort_key: list[Column], modern: Column,
              legacy: Column | None = None, page_ticker: Column | None = None) -> DataFrame:
    """Pages as JSON text.  shape 0: ``results`` list of modern records,
    1: a single modern record as ``results``, 2: legacy ``data`` list.

    Records stay structs until the page is serialised once with ``to_json``
    (NULL members are left out, as the vendor omits them).  Single-record
    pages hold one record by construction, so they are built row by row;
    only list pages go through a grouping, sorted by ``sort_key``: its columns
    stand beside the record, since a struct of them would get a new ordering
    object in every comparison."""
    ticker = page_ticker if page_ticker is not None else F.lit(None).cast("string")
    order = [f"k{n}" for n in range(len(sort_key))]
    tagged = rows.select(page_id.alias("page_id"), shape.alias("shape"), *[k.alias(n) for k, n in zip(sort_key, order)],
                         modern.alias("m"), (legacy if legacy is not None else F.lit(None)).alias("l"),
                         ticker.alias("ticker"))
    single = tagged.where(F.col("shape") == 1).select(
        "page_id", "shape", F.to_json(F.struct(F.col("m").alias("results"), "ticker")).alias("page_text"))
    parts = [single]
    for shp, col, member in ((0, "m", "results"), (2, "l", "data")):
        if col == "l" and legacy is None:
            continue
        g = tagged.where(F.col("shape") == shp).groupBy("page_id", "shape", "ticker").agg(
            F.sort_array(F.collect_list(F.struct(*order, col))).alias("recs"))
        parts.append(g.select("page_id", "shape", F.to_json(F.struct(
            F.col("recs").getField(col).alias(member), "ticker")).alias("page_text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _page_id(prefix: str, shape: Column, key: Column, span: int, row_key: Column | None = None) -> Column:
    single = F.concat(F.lit(f"{prefix}1-"), (row_key if row_key is not None else key).cast("string"))
    ranged = F.concat(F.lit(prefix), shape.cast("string"), F.lit("-"), F.floor(key / F.lit(span)).cast("string"))
    return F.when(shape == 1, single).otherwise(ranged)


def contract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.contracts_like(spark, sf_dir, with_part_key=True)
    shape = F.col("p_partkey") % 3
    modern = F.struct(
        F.col("contract").alias("ticker"), F.col("underlying_symbol").alias("underlying_ticker"),
        F.col("option_type").alias("contract_type"), F.col("exp_date").cast("string").alias("expiration_date"),
        F.col("strike").alias("strike_price"), F.col("exchange"))
    legacy = F.struct(
        F.col("contract").alias("id"), F.lit("options-contracts").alias("type"),
        F.struct("contract", "underlying_symbol", F.col("exp_date").cast("string").alias("exp_date"),
                 F.col("option_type").alias("type"), "strike", "exchange").alias("attributes"))
    return _assemble(rows, _page_id("c", shape, F.col("p_partkey"), RECORDS_PER_PAGE_KEYS), shape, [F.col("p_partkey")],
                     modern, legacy)


def chain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # join on the numeric part key (the contract code is a function of it)
    c = fx.contracts_like(spark, sf_dir, with_part_key=True).withColumnRenamed("p_partkey", "part_key")
    e = fx.eod_raw_like(spark, sf_dir).drop("contract")
    rows = e.join(c, "part_key")
    shape = F.col("src_id") % 3
    modern = F.struct(
        F.struct(F.col("contract").alias("ticker"), F.col("option_type").alias("contract_type"),
                 F.col("exp_date").cast("string").alias("expiration_date"),
                 F.col("strike").alias("strike_price")).alias("details"),
        F.struct(F.col("underlying_symbol").alias("ticker")).alias("underlying_asset"),
        F.struct(_ns(F.col("tradetime")).alias("last_updated"), F.col("volume")).alias("day"),
        F.struct("bid", "ask", _ns(F.col("fetched_at")).alias("last_updated")).alias("last_quote"),
        F.struct("delta").alias("greeks"),
        F.col("volatility").alias("implied_volatility"))
    legacy = F.struct(
        F.concat_ws("-", "contract", F.col("tradetime").cast("string")).alias("id"),
        F.lit("options-eod").alias("type"),
        F.struct("contract", "underlying_symbol", F.col("exp_date").cast("string").alias("exp_date"),
                 F.col("option_type").alias("type"), "strike", "bid", "ask",
                 F.col("tradetime").cast("string").alias("tradetime"), "volatility", "delta", "volume",
                 F.col("fetched_at").cast("string").alias("bid_date")).alias("attributes"))
    # one row = (contract, trade month, seq): unique, unlike the line id alone
    row_key = F.concat_ws("|", "contract", F.col("tradetime").cast("string"), F.col("seq").cast("string"))
    return _assemble(rows, _page_id("e", shape, F.col("src_id"), 1600, row_key), shape, [F.col("src_id"), row_key],
                     modern, legacy)


def bar_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fx.ticks_like(spark, sf_dir)
    own = F.col("event_id") % 7 == 0
    rec = F.struct(
        F.when(own, F.concat(F.lit("X:"), F.col("contract"))).alias("ticker"),
        F.col("price").alias("o"), F.col("price").alias("h"), F.col("price").alias("l"), F.col("price").alias("c"),
        F.col("size").alias("v"), F.col("price").alias("vw"),
        F.unix_millis(F.col("t").cast("timestamp")).alias("t"))
    page_id = F.concat_ws("-", F.lit("b"), F.col("contract"), F.floor(F.col("event_id") / 500).cast("string"))
    return _assemble(t, page_id, F.lit(0), [F.col("event_id")], rec, page_ticker=F.col("contract"))


def symbol_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.table(spark, sf_dir, "part")
    obj = F.col("p_partkey") % 2 == 1
    modern = F.struct(
        F.col("p_brand").alias("ticker"), F.lit("stocks").alias("market"),
        (F.col("p_size") % 2 == 0).alias("active"), F.col("p_name").alias("name"))
    shape = F.when(obj, F.lit(0)).otherwise(F.lit(2))
    page_id = F.concat(F.lit("s"), shape.cast("string"), F.lit("-"), F.floor(F.col("p_partkey") / 200).cast("string"))
    # legacy pages list bare symbol strings
    return _assemble(p, page_id, shape, [F.col("p_partkey")], modern, legacy=F.col("p_brand"))


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages (url, page_text) of one contract query per underlying, each with the vendor's link to the next.

    A query's pages are ranges of part keys in order; a url ends in a hash, so names tell nothing about the order.  Some
    pages never landed (every 11th range of 'PROMO' underlyings) and some last pages link back to the first
    (underlyings of copper)."""
    rows = fx.contracts_like(spark, sf_dir, with_part_key=True)
    sym = F.col("underlying_symbol")
    paged = rows.groupBy("underlying_symbol", F.floor(F.col("p_partkey") / 100).alias("k")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("contract").alias("ticker"), F.col("strike").alias("strike_price")))).alias("results"))
    url = F.concat(F.lit("https://api.example/contracts?underlying="), sym, F.lit("&cursor="), F.md5(F.concat(sym, F.lit("|"), F.col("k").cast("string"))))
    line = Window.partitionBy("underlying_symbol").orderBy("k")
    linked = paged.withColumn("url", url).withColumn("after", F.lead("url").over(line)).withColumn(
        "head", F.first("url").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    next_url = F.when(F.col("after").isNull() & sym.endswith("COPPER"), F.col("head")).otherwise(F.col("after"))
    text = F.to_json(F.struct("results", next_url.alias("next_url")))
    gone = sym.startswith("PROMO") & (F.col("k") % 11 == 5)
    return linked.where(~gone).select("url", text.alias("page_text"))


def land_page_files(pages: DataFrame, root: str) -> None:
    """Every page as one JSON file, spread over folders by its id.

    The pages are dealt out by folder first, by a fixed number: all cores write files, where the few MB of a small table
    would come from one task, and a commit moves whole folders instead of single files."""
    folder = F.pmod(F.xxhash64("page_id"), F.lit(PAGE_FOLDERS)).alias("folder")
    dealt = pages.select("page_text", folder).repartition(PAGE_FOLDERS, "folder")
    where = local_path(pages.sparkSession, root)
    if where is None:
        dealt.write.partitionBy("folder").option("maxRecordsPerFile", 1).text(root)
    else:
        _write_local(dealt, where)


def _write_local(dealt: DataFrame, root: str) -> None:
    """The text writer's files, one a row, by Python's file functions.

    Hadoop's local file system starts two ``chmod`` processes a file (without its native library) and adds a checksum
    file.  A task writes to a hidden folder of its attempt; the driver moves the folders of those attempts that Spark
    counts, so each row is there once whatever is retried."""
    os.makedirs(root)
    staged = f"{root}/_temporary"

    def write(batches):
        import os
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        attempt, task, made, n = uuid.uuid4().hex, TaskContext.get().partitionId(), {}, 0
        for batch in batches:
            for text, folder in zip(batch.column(0), batch.column(1).to_pylist()):
                if folder not in made:
                    made[folder] = f"{attempt}/folder={folder}"
                    os.makedirs(f"{staged}/{made[folder]}")
                with open(f"{staged}/{made[folder]}/part-{task:05d}-{attempt}-c{n:06d}.txt", "xb") as f:
                    f.write((text.as_py() or b"") + b"\n")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(made.values()), pa.string())], names=["folder"])

    try:
        for r in dealt.select(F.col("page_text").cast("binary"), "folder").mapInArrow(write, "folder string").collect():
            os.rename(f"{staged}/{r.folder}", f"{root}/{r.folder.split('/')[1]}")
    finally:
        shutil.rmtree(staged, ignore_errors=True)
