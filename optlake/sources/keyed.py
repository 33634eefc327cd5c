"""Keyed tables that grow by deltas: a base, one small delta per batch, merged
when read, compacted when the deltas outgrow a share of the base.

A batch writes its own folded rows and nothing else.  Base and deltas are
partitioned by a hash of the key, so a read of given keys opens their buckets
only, and rows that share a key stand in the same bucket of every file set.
Reading folds the deltas and the base rows they touch; base rows of other keys
pass through as they are, without a shuffle when the deltas' keys are few
(AQE broadcasts them from their measured size).

``fold(rows, key, seq)`` merges the rows of a key in ``seq`` order; it groups by the
key columns it is given, which may be more than the table's.  It must be
associative: folding folded rows gives the same as folding all.  Every batch
has a version (a stream's batch id).  A delta counts from the moment its job
commits (``_SUCCESS``); a version that is committed, or that the base includes,
is not applied again, so a replayed batch changes nothing even where the fold
adds up.  A job that dies leaves a folder without ``_SUCCESS``, which readers
ignore and the replay overwrites.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from optlake.operators.merge import keep_last, union_by_name
from optlake.session import delete_path, list_folders, path_exists

BUCKET, VERSION = "__bucket", "__version"
# Tasks fold parts of a bucket.
PART, PARTS = "__part", 16


@dataclass
class KeyedTable:
    """Rows unique by ``key`` under ``root``; ``share``: delta rows per base row at which the table is compacted."""

    spark: SparkSession
    root: str
    key: list[str]
    fold: Callable[[DataFrame, list[str], str], DataFrame] = keep_last
    buckets: int = 16
    share: float = 0.5

    def _path(self, kind: str, version: int) -> str:
        return f"{self.root.rstrip('/')}/{kind}/v={version:012d}"

    def _committed(self, kind: str) -> list[int]:
        names = [n for n in list_folders(self.spark, f"{self.root.rstrip('/')}/{kind}") if n.startswith("v=")]
        found = sorted(int(n[2:]) for n in names)
        return [v for v in found if path_exists(self.spark, f"{self._path(kind, v)}/_SUCCESS")]

    def versions(self) -> tuple[int | None, list[int]]:
        """Version of the live base, and the versions of the deltas after it."""
        bases = self._committed("base")
        base = bases[-1] if bases else None
        return base, [v for v in self._committed("delta") if base is None or v > base]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _folded(self, rows: DataFrame, seq: str) -> DataFrame:
        """Rows folded by key, with their bucket: they are dealt out once, by parts of buckets, and can be written from there."""
        part = F.pmod(F.shiftright(F.xxhash64(*self.key), 32), F.lit(PARTS)).cast("int")
        dealt = rows.withColumn(BUCKET, self._bucket()).withColumn(PART, part).repartition(BUCKET, PART)
        return self.fold(dealt, [*self.key, BUCKET, PART], seq).drop(PART)

    def _write(self, rows: DataFrame, kind: str, version: int) -> None:
        dealt = rows if BUCKET in rows.columns else rows.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET)
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(self._path(kind, version))

    def _read(self, kind: str, version: int, buckets: list[int] | None = None) -> DataFrame | None:
        """Rows of one file set with their version; None if it has none (no bucket folder)."""
        if not any(n.startswith(f"{BUCKET}=") for n in list_folders(self.spark, self._path(kind, version))):
            return None
        got = self.spark.read.parquet(self._path(kind, version))
        if buckets is not None:
            got = got.where(F.col(BUCKET).isin(*buckets))
        return got.drop(BUCKET).withColumn(VERSION, F.lit(version).cast("long"))

    def apply(self, rows: DataFrame, version: int, seq: str | None = None, compact: bool = True) -> bool:
        """Adds one batch as a delta; False if its version is applied already.

        ``seq`` orders rows of one key within the batch; without it a batch has one row per key."""
        base, deltas = self.versions()
        if version in deltas or (base is not None and version <= base):
            return False
        self._write(self._folded(rows, seq) if seq else rows, "delta", version)
        if compact:
            self.compact_if_due()
        return True

    def rows_held(self) -> tuple[int, int]:
        """Rows of the base (of the first delta, where there is no base yet) and of the deltas after it, from the file footers."""
        base, deltas = self.versions()
        parts = ([] if base is None else [self._read("base", base)]) + [self._read("delta", v) for v in deltas]
        counts = [0 if got is None else got.count() for got in parts]
        return sum(counts[:1]), sum(counts[1:])

    def compact_if_due(self) -> None:
        """Compacts once the deltas hold ``share`` of the base's rows, so each row is rewritten about 1 / share times."""
        held, fresh = self.rows_held()
        if fresh and fresh >= self.share * held:
            self.compact()

    def _same_key(self, rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        names = {k: f"__key_{n}" for n, k in enumerate(self.key)}
        named = keys.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct()
        return rows.join(named, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]), how)

    def read(self, upto: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """Current rows, or those as of version ``upto`` (not before the base's), or of the given keys alone."""
        base, deltas = self.versions()
        if base is None and not deltas:
            raise FileNotFoundError(f"no committed version under {self.root}")
        if upto is not None:
            if base is not None and upto < base:
                raise ValueError(f"versions before {base} are compacted")
            deltas = [v for v in deltas if v <= upto]
        buckets = None if keys is None else [r[0] for r in keys.select(self._bucket()).distinct().collect()] or [-1]
        held = None if base is None else self._read("base", base, buckets)
        fresh = [d for d in (self._read("delta", v, buckets) for v in deltas) if d is not None]
        out = self._merged(held, fresh)
        if out is None:
            raise FileNotFoundError(f"no rows under {self.root} yet")
        return out if keys is None else self._same_key(out, keys, "left_semi")

    def _merged(self, held: DataFrame | None, deltas: list[DataFrame]) -> DataFrame | None:
        if not deltas:
            return None if held is None else held.drop(VERSION)
        fresh = union_by_name(*deltas)
        if held is None:
            return self.fold(fresh, self.key, VERSION)
        touched = self._same_key(held, fresh, "left_semi")
        same = self._same_key(held, fresh, "left_anti").drop(VERSION)
        return union_by_name(same, self.fold(union_by_name(touched, fresh), self.key, VERSION))

    def changes(self, version: int) -> DataFrame | None:
        """What a delta changed, as retractions and insertions: rows with ``op`` -1 (as before it) and 1 (as after it).

        Adding up the ``op`` of equal rows over all versions leaves the current rows.  The delta must not be
        compacted yet; None if it has no rows."""
        delta = self._read("delta", version)
        if delta is None:
            return None
        base, deltas = self.versions()
        if version not in deltas:
            raise ValueError(f"version {version} is not applied, or compacted")
        keys = delta.select(*self.key)
        new = self.read(upto=version, keys=keys).withColumn("op", F.lit(1))
        earlier = [v for v in deltas if v < version and self._read("delta", v) is not None]
        if base is None and not earlier:
            return new
        old = self.read(upto=max([*earlier, *([base] if base is not None else [])]), keys=keys).withColumn("op", F.lit(-1))
        both = union_by_name(old, new)
        kept = [c for c in both.columns if c != "op"]
        return both.groupBy(*kept).agg(F.sum("op").cast("int").alias("op")).where("op <> 0")

    def compact(self) -> None:
        """Writes base and deltas as a new base.  The files it replaces stay until the next compaction, for readers on them."""
        base, deltas = self.versions()
        if not deltas:
            return
        bases, old = self._committed("base"), self._committed("delta")
        fresh = [d for d in (self._read("delta", v) for v in deltas) if d is not None] if base is None else []
        self._write(self._folded(union_by_name(*fresh), VERSION) if fresh else self.read(), "base", deltas[-1])
        for v in bases:
            if v != base:
                delete_path(self.spark, self._path("base", v))
        for v in old:
            if base is not None and v <= base:
                delete_path(self.spark, self._path("delta", v))
