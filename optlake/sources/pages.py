"""Landed vendor pages -> records.

A page is one JSON document as the vendor returned it.  Records sit under
``results`` (a list, or a single object) or, in the legacy shape, under
``data`` (a list); a page with neither has no records.  Bars pages carry the
contract once, as a page-level ``ticker``.

Pages are read as whole files (one page per file) or taken from any
DataFrame holding page text; parsing is ``parse_json`` to VARIANT, so no
schema inference pass over the landing folder is needed and no field is
lost.  Link following (next_url / links.next) is the landing tool's job.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from optlake.session import local_path, materialize

# Files that one task reads, and bytes of text it hands over at once.
FILES_PER_TASK = 4096
BATCH_BYTES = 8 << 20


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: page_id (file path) and its text.

    ``path`` may be a folder, a folder of ``name=value`` folders, or a glob.  Folders are listed by tasks; a glob of many
    files is expanded on the driver and each file looked up by itself.  A folder of plain files on the local file system
    is listed into a table and read by Python's file functions, with the same rows: Spark's reader would keep every file
    on the driver and spends 2 ms on each."""
    files, n = _plain_files(spark, path)
    if files is None:
        return (spark.read.text(path, wholetext=True)
                .select(F.col("_metadata.file_path").alias("page_id"), F.col("value").alias("page_text")))
    most = BATCH_BYTES

    def texts(batches):
        import pyarrow as pa

        def out():
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.binary())], names=["page_id", "page_text"])

        for batch in batches:
            ids, found, size = [], [], 0
            for name in batch.column(0).to_pylist():
                with open(name, "rb") as f:
                    text = f.read()
                if text:  # like Spark's reader, which leaves empty files out
                    ids.append(f"file:{name}")
                    found.append(text)
                    size += len(text)
                if size > most:
                    yield out()
                    ids, found, size = [], [], 0
            yield out()

    tasks = max(spark.sparkContext.defaultParallelism, -(-n // FILES_PER_TASK))
    rows = files.repartition(tasks).mapInArrow(texts, "page_id string, page_text binary")
    return rows.select("page_id", F.col("page_text").cast("string").alias("page_text"))


def _plain_files(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    """Paths of the files in a local folder, or in its ``name=value`` folders, as listed now, and their number.

    None where Spark's reader does more than read them: other file systems, globs, deeper or mixed folders, compressed
    files, checksum files, names that a URI would escape, files to be skipped when lost.  The list needs a scratch folder."""
    root = local_path(spark, path) if isinstance(path, str) else None
    scratch = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    skips = "true" in [spark.conf.get(f"spark.sql.files.ignore{x}Files").lower() for x in ("Missing", "Corrupt")]
    if root is None or skips or not scratch or not re.fullmatch(r"(/[A-Za-z0-9._=-]+)+", root) or not os.path.isdir(root):
        return None, 0
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    packed = tuple(jvm.org.apache.hadoop.util.ReflectionUtils.newInstance(c, conf).getDefaultExtension() for c in codecs)
    folders, loose = [], False
    with os.scandir(root) as entries:
        for e in entries:
            if not e.name.startswith((".", "_")) and e.is_dir():
                folders.append(e.name)
            elif not e.name.startswith((".", "_")) or "=" in e.name:
                loose = True
    columns = {m[1] if (m := re.fullmatch(r"([A-Za-z0-9]+)=[A-Za-z0-9.-]+", n)) else None for n in folders}
    if folders and (loose or len(columns) > 1 or None in columns or "value" in {c.lower() for c in columns}):
        return None, 0

    def files(batches):
        import os
        import re

        import pyarrow as pa

        def out():
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(plain, pa.bool_())], names=["name", "plain"])

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                names, plain = [], []
                with os.scandir(folder) as entries:
                    for e in entries:
                        hidden = e.name.startswith((".", "_")) and "=" not in e.name
                        if hidden and not e.name.endswith(".crc"):
                            continue
                        names.append(f"{folder}/{e.name}")
                        plain.append(bool(re.fullmatch("[A-Za-z0-9][A-Za-z0-9._=-]*", e.name)) and e.is_file()
                                     and not e.name.endswith((*packed, "._COPYING_")))
                        if len(names) == 100_000:
                            yield out()
                            names, plain = [], []
                yield out()

    listed = spark.createDataFrame([(f"{root}/{n}" if n else root,) for n in folders or [""]], "folder string")
    found = materialize(listed.mapInArrow(files, "name string, plain boolean"), "page-list")
    n, plain = found.agg(F.count("*"), F.count_if("plain")).first()
    return (found.select("name"), n) if plain == n else (None, 0)


def parse_pages(pages: DataFrame, text: str = "page_text") -> DataFrame:
    """Parse page text into a VARIANT ``payload`` (bad JSON -> NULL payload)."""
    return pages.withColumn("payload", F.try_parse_json(F.col(text))).drop(text)


def page_records(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Explode each page into its records (S1) with the page ticker.

    Output: page columns, ``pos`` (0-based position in the page), ``kind``
    ('results', 'result', 'data'), ``record`` (VARIANT), ``page_ticker``.

    The envelope members are taken from the payload once per page, straight to
    lists (a cast to VARIANT writes the whole member anew), and the
    explode is an outer one followed by a filter on its output: an inner
    explode would add a ``size(records) > 0`` filter that the optimizer
    pushes below the parse, parsing every page again.
    """
    p = F.col(payload)
    keep = [c for c in pages.columns if c != payload]
    one = F.try_variant_get(p, "$.results", "struct<`__none`:variant>")  # any object, its members left alone
    env = pages.select(*keep,
                       F.try_variant_get(p, "$.results", "array<variant>").alias("__res_list"),
                       F.when(one.isNotNull(), F.array(F.variant_get(p, "$.results", "variant"))).alias("__res_one"),
                       F.try_variant_get(p, "$.data", "array<variant>").alias("__data_list"),
                       F.try_variant_get(p, "$.ticker", "string").alias("page_ticker"))
    res_list, res_one, data_list = F.col("__res_list"), F.col("__res_one"), F.col("__data_list")
    staged = env.select(
        *keep, "page_ticker",
        F.when(res_list.isNotNull(), F.struct(F.lit("results").alias("kind"), res_list.alias("recs")))
        .when(res_one.isNotNull(), F.struct(F.lit("result").alias("kind"), res_one.alias("recs")))
        .when(data_list.isNotNull(), F.struct(F.lit("data").alias("kind"), data_list.alias("recs")))
        .alias("__env"))
    out = staged.select(*keep, F.col("__env.kind").alias("kind"), "page_ticker",
                        F.posexplode_outer("__env.recs").alias("pos", "record"))
    return out.where(F.col("record").isNotNull())


def next_link(payload: Column) -> Column:
    """The page's next link (``next_url`` or ``links.next``), NULL when last."""
    return F.coalesce(F.try_variant_get(payload, "$.next_url", "string"),
                      F.try_variant_get(payload, "$.links.next", "string"))
