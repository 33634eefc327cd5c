"""Bulk flat files: daily compressed CSV of minute aggregates, and a file
inventory of a landing prefix.

A ``.csv.gz`` file cannot be split, so the reader gets one task per file;
``read_daily_csv`` spreads the rows over more tasks right after the scan only
when there are fewer files than cores.  The schema is given,
never inferred (the column names of the vendor files are an argument).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from optlake.functions.dates import epoch_ms_to_ts, epoch_ns_to_ts
from optlake.session import materialize

DATE_IN_PATH = r"(\d{4}-\d{2}-\d{2})"
# microsecond timestamps in text (the default CSV pattern keeps milliseconds)
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_daily_csv(df: DataFrame, root: str, date_col: str, compression: str = "gzip", drop: list[str] = ()) -> None:
    """Write rows as compressed CSV files per day under ``root/day=YYYY-MM-DD``.

    Rebalanced on the day (AQE): a day's rows stay together unless the day is
    large, which is then split over several tasks (and files)."""
    (df.withColumn("day", F.to_date(F.col(date_col))).drop(*drop)
       .hint("rebalance", "day")
       .write.mode("overwrite").partitionBy("day").option("header", True).option("compression", compression)
       .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
       .csv(root))


def read_daily_csv(spark: SparkSession, path: str, schema: StructType, date_col: str = "file_date") -> DataFrame:
    """Read daily CSV files (S8) with a fixed schema; the file's date comes
    from its path (``day=YYYY-MM-DD`` folder or a dated file name)."""
    rows = (spark.read.schema(schema).option("header", True)
            .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
            .csv(path))
    few = len(rows.inputFiles()) < spark.sparkContext.defaultParallelism
    rows = rows.withColumn(date_col, F.to_date(F.regexp_extract(F.col("_metadata.file_path"), DATE_IN_PATH, 1)))
    if "day" in rows.columns:
        rows = rows.drop("day")
    return rows.repartition(spark.sparkContext.defaultParallelism) if few else rows


# Different headers a folder may have: they are worked off one by one at the driver.
MOST_HEADERS = 1000


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, names): the first line of every CSV file and its column names, trimmed and lower-cased.

    The line is taken in order within the file's first split; the file's other lines are read, but not shuffled."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    first = lines.where("at = 0").withColumn("n", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "n").alias("header"))
    return first.withColumn("names", F.transform(F.split("header", ","), lambda c: F.lower(F.trim(F.regexp_replace(c, '"', "")))))


def header_reasons(names: Column, schema: StructType, required: list[str]) -> Column:
    """Why a header does not fit: columns the schema does not know, required ones it lacks, names it holds twice."""
    known = F.array(*[F.lit(f.name.lower()) for f in schema.fields])
    unknown = F.transform(F.array_except(names, known), lambda c: F.concat(F.lit("unknown column "), c))
    missing = F.transform(F.array_except(F.array(*[F.lit(c.lower()) for c in required]).cast("array<string>"), names),
                          lambda c: F.concat(F.lit("missing column "), c))
    twice = F.when(F.size(F.array_distinct(names)) < F.size(names), F.array(F.lit("repeated column"))).otherwise(F.array().cast("array<string>"))
    return F.sort_array(F.concat(unknown, missing, twice))


def read_reconciled_csv(spark: SparkSession, path: str, schema: StructType, required: list[str] | None = None,
                        date_col: str = "file_date") -> tuple[DataFrame, DataFrame]:
    """CSV files whose headers differ: (rows, quarantine).

    Columns are mapped by name, per file: reordered columns are put right and columns that are not ``required`` (all, by
    default) may be left out (NULL).  Files with an unknown, missing or repeated column are not read; they come back in
    ``quarantine`` (file, header, reasons, file_date).  Values that do not fit their type are NULL.  All files of one
    header are one group: a row finds its columns through the places its file's header gives them.
    """
    required = [f.name for f in schema.fields] if required is None else required
    found = materialize(file_headers(spark, path).withColumn("reasons", header_reasons(F.col("names"), schema, required)), "headers")
    dated = F.to_date(F.regexp_extract("file", DATE_IN_PATH, 1)).alias(date_col)
    bad = found.where(F.size("reasons") > 0).select("file", "header", "reasons", dated)
    good = found.where(F.size("reasons") == 0)
    groups = [r.names for r in good.select("names").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(groups) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers under {path}")
    width = max(map(len, groups), default=1)
    raw = spark.read.schema(", ".join(f"c{i} string" for i in range(width))).option("header", False).csv(path)
    cells = raw.select(F.col("_metadata.file_path").alias("file"), F.array(*raw.columns).alias("cells")).join(good.select("file", "names"), "file")
    own = F.transform(F.slice("cells", 1, F.size("names")), lambda c: F.lower(F.trim(c)))
    rows = cells.where(~own.eqNullSafe(F.col("names")))  # the header lines themselves
    place = {f.name: F.array_position("names", f.name.lower()).cast("int") - 1 for f in schema.fields}
    return rows.select(*[F.when(place[f.name] >= 0, F.get("cells", place[f.name])).try_cast(f.dataType).alias(f.name) for f in schema.fields],
                       dated), bad


# The columns of the vendor's minute-aggregate files.
MINUTE_AGGREGATES = "ticker string, volume double, open double, close double, high double, low double, window_start long, transactions long"


def read_minute_aggregates(spark: SparkSession, path: str) -> DataFrame:
    """Daily minute-aggregate files -> bar rows (contract, tradetime, open,
    high, low, last, volume) for the bars table.  ``window_start`` is epoch
    nanoseconds, or milliseconds where it has no more than 13 digits; a start
    out of range is NULL.  ``seq`` is (file, row) order for the merge."""
    rows = read_daily_csv(spark, path, _parse_datatype_string(MINUTE_AGGREGATES))
    start = F.col("window_start")
    at = F.when(F.abs(start) < 10**13, epoch_ms_to_ts(start)).otherwise(epoch_ns_to_ts(start))
    return rows.select(F.col("ticker").alias("contract"), at.alias("tradetime"), "open", "high", "low",
                       F.col("close").alias("last"), "volume", F.struct("file_date", "window_start", "transactions").alias("seq"))


def file_inventory(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Files under a prefix with size and modification time (S9); the file
    bodies are not read (only metadata columns are selected)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
            .select("path", "length", "modificationTime")
            .withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]*$", 1)))


def folder_summary(inventory: DataFrame) -> DataFrame:
    """Data sets under the prefix: files, bytes and time span per folder."""
    return inventory.groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
        F.min("modificationTime").alias("first_modified"), F.max("modificationTime").alias("last_modified"))


def sample_files(inventory: DataFrame, n: int) -> DataFrame:
    """The first ``n`` files by path (a top-k, not a sort of the listing)."""
    return inventory.orderBy("path").limit(n)
