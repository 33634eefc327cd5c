"""Partitioned Parquet tables: create if missing, read with pruning, and
rewrite only the partitions a fold touched.

No MERGE on plain Parquet, so a merge is: write the staged rows once to the
shared scratch folder; take the touched partitions from the copy (one column is
read); read exactly those of the held table (literal partition filters); deal
staged and held rows out by partition and key bucket, the one shuffle of a merge;
fold; overwrite exactly those partitions with dynamic partition overwrite, which
replaces folders only when all of its tasks are done with the old ones; delete
the scratch copy.  A failed job leaves the table as it was up to the final rename
of each partition folder.  One writer per table at a time.

Rows that break the table's key or NOT NULL rules never reach a fold: they are
appended with their reasons to the table's quarantine folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from optlake import schemas
from optlake.operators.checks import reasons
from optlake.operators.layout import along_curve, with_curve
from optlake.operators.merge import contracts_seen, keep_last, merge_keep_last, symbol_universe, upsert_eod, write_order
from optlake.session import delete_path, list_folders, scratch_path

# Fixed layout: partition column per table and the column it is derived from.
PARTITIONING = {
    "option_eod": ("trade_month", lambda df: F.trunc(F.to_date("tradetime"), "month")),
    "bars": ("trade_date", lambda df: F.to_date(F.col("tradetime"))),
}
# Writes are rebalanced on the partition column (AQE REBALANCE): rows of a
# month stay together, a month larger than the advisory partition size is
# split over several write tasks, small months are coalesced, and there is
# no sampling pass over the (possibly expensive) input.
#
# A merge's rows are dealt by the partition column and a bucket of the key
# before the fold, and written from where they are folded: a key's rows all lie
# in one task, a large month's in several, as many as give BUCKET_ROWS rows each.
BUCKET_ROWS = 250_000
_BUCKET = "__bucket"
SORT_WITHIN = {
    "option_eod": ["underlying_symbol", "tradetime", "exp_date", "option_type", "strike"],
    "bars": ["contract", "tradetime"],
}


def _partitioned_schema(name: str) -> StructType:
    base = schemas.TABLES[name]
    if name in PARTITIONING:
        return StructType(base.fields + [schemas.StructField(PARTITIONING[name][0], schemas.DateType(), True)])
    return base


@dataclass
class TableStore:
    """Tables under one root folder (a shared file system or object store).

    With ``store_raw_json`` off (S7), merges leave the vendor's JSON out of what
    they add; JSON that is held already stays."""

    spark: SparkSession
    root: str
    store_raw_json: bool = True

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def exists(self, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(self.path(name))
        return p.getFileSystem(conf).exists(p)

    def has_partitions(self, name: str) -> bool:
        """Whether the table holds any partition folder (one directory
        listing of the table root, not a listing of its files)."""
        part = PARTITIONING.get(name)
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = root.getFileSystem(conf)
        if not fs.exists(root):
            return False
        prefix = f"{part[0]}=" if part else "part-"
        return any(st.getPath().getName().startswith(prefix) for st in fs.listStatus(root))

    def ensure(self, name: str) -> None:
        """Create an empty table with its fixed schema if missing."""
        if self.exists(name):
            return
        empty = self.spark.createDataFrame([], _partitioned_schema(name))
        part = PARTITIONING.get(name)
        w = empty.write.mode("overwrite")
        if part:
            w = w.partitionBy(part[0])
        w.parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        """Held rows with the fixed schema (S4); filters on the partition
        column prune folders, others reach the Parquet reader."""
        self.ensure(name)
        return self.spark.read.schema(_partitioned_schema(name)).parquet(self.path(name))

    def with_partition(self, name: str, df: DataFrame) -> DataFrame:
        part = PARTITIONING.get(name)
        return df.withColumn(part[0], part[1](df)) if part else df

    def overwrite_partitions(self, name: str, rows: DataFrame, staged_copy: bool = True, dealt: bool = False) -> None:
        """Replace exactly the partitions present in ``rows`` (S5); an
        unpartitioned table is replaced whole.

        ``dealt`` rows already lie together by partition and are written from there.  With ``staged_copy`` the rows are written to a staging folder first, and the table is overwritten from that
        copy: an unpartitioned table needs it where ``rows`` read the table itself.
        """
        part = PARTITIONING.get(name)
        schema = _partitioned_schema(name)
        cols = [f.name for f in schema.fields]
        rows = rows if dealt else self.with_partition(name, rows)
        # columns the rows lack are written as typed NULLs; the rest are cast
        staged = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                               for f in schema.fields])
        if part and not dealt:
            staged = staged.hint("rebalance", part[0])
        staged = write_order(staged, part[0] if part else cols[0], SORT_WITHIN.get(name, []))
        staging = scratch_path(self.spark, f"stage-{name}") if staged_copy else None
        if staging:
            staged.write.mode("overwrite").parquet(staging)
            staged = self.spark.read.schema(schema).parquet(staging)
        w = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        if part:
            w = w.partitionBy(part[0])
        w.parquet(self.path(name))
        if staging:
            delete_path(self.spark, staging)

    def cluster(self, name: str, values: list[str], columns: list[str], files: int) -> None:
        """Rewrites the given partitions (``values`` of the partition column) in the order of a space-filling curve over
        ``columns``, in about ``files`` files in all: filters on any of the columns then skip files and row groups.  The
        rows stay the same; a later merge writes the partitions it touches in the table's plain order again."""
        part, schema = PARTITIONING[name][0], _partitioned_schema(name)
        held = self.with_partition(name, self._held(name, values)).select(*[f.name for f in schema.fields])
        staging = scratch_path(self.spark, f"cluster-{name}")
        with_curve(held, columns).write.parquet(staging)  # sampled, then read, and no longer the files that are replaced
        laid = along_curve(self.spark.read.parquet(staging), columns, files, within=[part])
        laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(self.path(name))
        delete_path(self.spark, staging)

    def replace(self, name: str, rows: DataFrame) -> None:
        """Write an unpartitioned table (contracts, symbols) whole from
        ``rows``, staged first.  A partitioned table is refused: use its merge,
        which keeps the held rows of the partitions it rewrites."""
        if name in PARTITIONING:
            raise ValueError(f"{name} is partitioned: replace() would drop held rows; use the merge call")
        self.overwrite_partitions(name, rows)

    def quarantine(self, name: str) -> DataFrame | None:
        """Rows kept out of a table, with the ``reasons`` array; None if there are none."""
        path = f"{self.root.rstrip('/')}/_quarantine/{name}"
        return self.spark.read.option("mergeSchema", "true").parquet(path) if list_folders(self.spark, path) else None

    def _stage(self, name: str, staged: DataFrame) -> tuple[DataFrame, str, dict[str, int]]:
        """Write staged rows once: (good rows with their partition column,
        scratch folder, rows by touched partition).  Bad rows go to quarantine."""
        part = PARTITIONING[name][0]
        path = scratch_path(self.spark, f"staged-{name}")
        must = [c for c in schemas.TABLE_KEYS[name] if c in staged.columns]
        must += [c for c in schemas.not_null_columns(schemas.TABLES[name]) if c in staged.columns and c not in must]
        tagged = self.with_partition(name, staged).withColumn("__bad", reasons(must))
        ok = F.size("__bad") == 0
        tagged = tagged.withColumn(part, F.when(ok, F.col(part)))
        tagged.write.parquet(path)
        copy = self.spark.read.schema(tagged.schema).parquet(path)
        found = dict(copy.groupBy(part).count().collect())  # one row per partition
        if None in found:
            bad = copy.where(F.col(part).isNull()).drop(part).withColumnRenamed("__bad", "reasons")
            load = path.rstrip("/").rsplit("/", 1)[1]
            bad.write.parquet(f"{self.root.rstrip('/')}/_quarantine/{name}/load={load}")
        return copy.where(F.col(part).isNotNull()).drop("__bad"), path, {str(v): n for v, n in found.items() if v is not None}

    def _held(self, name: str, values: list[str]) -> DataFrame:
        """Held rows of the given partitions: a literal partition filter, so no other folder is read."""
        part = PARTITIONING[name][0]
        return self.read(name).where(F.col(part).isin(*[F.lit(v).cast("date") for v in values]))

    def _merge(self, name: str, staged: DataFrame, fold) -> DataFrame:
        """Fold staged rows with the held rows of the partitions they touch: ``fold(held or None, staged, within)``, where
        ``within`` are the columns by which the fold deals its rows out."""
        part = PARTITIONING[name][0]
        good, path, rows = self._stage(name, staged)
        if rows:
            # dynamic overwrite writes beside the table and moves the new folders in once all tasks are done: until
            # then the held files are read as they are, so no copy of the folded rows is needed
            held = self._held(name, list(rows)) if self.has_partitions(name) else None
            before = {} if held is None else dict(held.groupBy(part).count().collect())  # from the file footers
            before = {str(v): n for v, n in before.items()}
            most = max(n + before.get(v, 0) for v, n in rows.items())
            bucket = F.pmod(F.xxhash64(*schemas.TABLE_KEYS[name]), F.lit(-(-most // BUCKET_ROWS)))
            folded = fold(None if held is None else held.withColumn(_BUCKET, bucket), good.withColumn(_BUCKET, bucket), [part, _BUCKET])
            self.overwrite_partitions(name, folded, staged_copy=False, dealt=True)
        delete_path(self.spark, path)
        return self.read(name)

    def upsert_eod(self, staged: DataFrame, seq: str = "seq") -> DataFrame:
        """W1 into the end-of-day table, keyed by contract and UTC trade DATE.

        A timestamp ``tradetime`` gives the date; its instant is kept in
        ``bid_date`` where that is NULL.  Of several snapshots of one day the
        last in ``seq`` order gives the quotes.  Returns the table."""
        staged = self._with_json(staged)
        if dict(staged.dtypes).get("tradetime") != "date":
            at = F.col("tradetime").cast("timestamp")
            staged = staged.withColumn("bid_date", F.coalesce(F.col("bid_date"), at) if "bid_date" in staged.columns else at)
            staged = staged.withColumn("tradetime", F.to_date("tradetime"))
        return self._merge("option_eod", staged, lambda held, rows, within: upsert_eod(held, rows, seq=seq, within=within))

    def upsert_bars(self, staged: DataFrame, seq: str = "seq") -> DataFrame:
        """Bars merged by (contract, tradetime), the last row wins; held bars of the touched days stay."""
        key = schemas.TABLE_KEYS["bars"]

        def fold(held, rows, within):
            if held is None:
                return keep_last(rows, key, seq, within=within)
            return merge_keep_last(held, rows, key, seq, within=within)

        return self._merge("bars", staged, fold)

    def upsert_contracts(self, observations: DataFrame, seen: str = "seen_at", seq: str = "seq") -> DataFrame:
        """W3 into the contracts table: held rows count as the first sighting."""
        held = self.read("contracts") if self.exists("contracts") else None
        observations = self._with_json(observations)
        good = observations.where(F.size(reasons(["contract", "underlying_symbol", "option_type", seen])) == 0)
        bad = observations.withColumn("reasons", reasons(["contract", "underlying_symbol", "option_type", seen]))
        self._keep_bad("contracts", bad.where(F.size("reasons") > 0))
        self.overwrite_partitions("contracts", contracts_seen(good, seen, seq, held=held))
        return self.read("contracts")

    def upsert_symbols(self, rows: DataFrame) -> DataFrame:
        """W4 into the symbols table: latest fetch time, latest non-NULL fields."""
        name = "underlying_symbols"
        self._keep_bad(name, rows.withColumn("reasons", reasons(["underlying_symbol"])).where(F.size("reasons") > 0))
        good = rows.where(F.col("underlying_symbol").isNotNull())
        if self.exists(name):
            good = self.read(name).unionByName(good, allowMissingColumns=True)
        self.overwrite_partitions(name, symbol_universe(good).drop("first_fetched_at"))
        return self.read(name)

    def _with_json(self, rows: DataFrame) -> DataFrame:
        return rows if self.store_raw_json else rows.withColumn("raw_json", F.lit(None).cast("string"))

    def _keep_bad(self, name: str, bad: DataFrame) -> None:
        if bad.limit(1).count():
            load = scratch_path(self.spark, "bad").rsplit("/", 1)[1]
            bad.write.parquet(f"{self.root.rstrip('/')}/_quarantine/{name}/load={load}")
