"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

import optlake.llm
from optlake.session import delete_path, prepare_session, scratch_path

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(optlake.llm)

#: Rows of one Arrow batch.  Texts may be long, so batches stay short.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime confs of the library plus short Arrow batches."""
    prepare_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Hands memory that a finished task has freed back to the system.

    Python workers are reused: without this, each keeps the most that any of its tasks has taken."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_columns(df: DataFrame, cols: list, schema: str,
                start: Callable[[], Callable[..., list[list]]]) -> DataFrame:
    """Column-wise Arrow map without a shuffle.

    ``start()`` runs once per task and returns a function that takes the
    selected columns of a batch as Python lists (nulls are None) and returns
    the output columns as lists of one common length.
    """
    struct: StructType = _parse_datatype_string(schema)
    out = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, got, batch = start(), None, None
        for batch in batches:
            got = step(*[c.to_pylist() for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(got, out)], schema=out)
        del step, got, batch
        give_back()

    return df.select(*cols).mapInArrow(run, struct)


def map_stream(df: DataFrame, cols: list, schema: str,
               start: Callable[[Iterator[tuple]], Iterator[tuple]], rows: int = 1000) -> DataFrame:
    """Row stream map of a whole partition, in its order and in bounded memory.

    ``start(rows)`` consumes an iterator of tuples and yields output tuples.
    """
    struct: StructType = _parse_datatype_string(schema)
    out = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tuples():
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns])

        held: list[tuple] = []
        for row in start(tuples()):
            held.append(row)
            if len(held) >= rows:
                yield pack(held)
                held = []
        if held:
            yield pack(held)
        del held
        give_back()

    def pack(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip(zip(*held), out)], schema=out)

    return df.select(*cols).mapInArrow(run, struct)


def fold_partition(df: DataFrame, cols: list, schema: str, fold: Callable[[Iterator[list[list]]], list],
                   rows: int = 100_000) -> DataFrame:
    """One result per partition: ``fold(batches)`` consumes its batches (as lists of columns) and returns arrays."""
    struct: StructType = _parse_datatype_string(schema)
    out = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = fold([c.to_pylist() for c in b.columns] for b in batches)
        for a in range(0, len(got[0]), rows):
            yield pa.RecordBatch.from_arrays([pa.array(c[a:a + rows], f.type) for c, f in zip(got, out)], schema=out)
        del got
        give_back()

    return df.select(*cols).mapInArrow(run, struct)


#: Ids that may be broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def broadcast_if_few(ids: DataFrame) -> DataFrame:
    """The frame, marked for broadcast when its counted rows are at most BROADCAST_IDS."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


# Words are runs of ASCII digits and letters and of non-ASCII characters:
# every other byte becomes a blank, A-Z become a-z.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words (UTF-8) of a whole text."""
    return (text or "").encode().translate(WORD_BYTES).split()


class Scratch:
    """Shared-folder copies of intermediates.

    ``keep`` writes a frame once and returns a reader over the copy: this cuts
    the lineage, and a lost executor re-reads the copy.  ``drop`` deletes the
    copies no later step reads; other frames are left alone.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.mode("overwrite").parquet(path)
        return self._named(self.spark.read.schema(df.schema).parquet(path), path)

    def keep_bucketed(self, df: DataFrame, label: str, column: str) -> DataFrame:
        """Like ``keep``, but the copy is bucketed: grouping it by ``column`` needs no shuffle."""
        path = scratch_path(self.spark, label)
        name = f"scratch_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.bucketBy(buckets, column).format("parquet").option("path", path).saveAsTable(name)
        got = self.spark.table(name)
        self.spark.sql(f"drop table {name}")  # the name only: the files are the scratch copy
        return self._named(got, path)

    def drop(self, *frames: DataFrame) -> None:
        for f in frames:
            path = f.__dict__.pop("_scratch_path", None)
            if path:
                delete_path(self.spark, path)

    @staticmethod
    def _named(copy: DataFrame, path: str) -> DataFrame:
        copy.__dict__["_scratch_path"] = path
        return copy
