"""Structured Streaming twins of the batch operators.

Each builder takes a streaming DataFrame and returns a started query writing
to a durable sink; the transformation code is the batch operator, unchanged.

* X1 landing folder -> normalised rows (file source, ``parse_json``)
* X2 replay-safe upsert per micro-batch (``foreachBatch`` + the W1 fold,
  seq = (batch id, row seq)); replaying a batch changes nothing
  (``upsert_delta_stream``: the same fold over a keyed table's deltas)
* X3 tumbling bars with a watermark, append mode (closed windows only), or
  mergeable bar states that late ticks correct (``late_bars_stream``)
* X4 live task state: the T4 aggregation in update mode, a delta per batch
* X5 drop repeats within the lateness bound (``dropDuplicatesWithinWatermark``)
* X6 requests per minute against the quota, watermark + 1-minute window

Event-time columns must be TIMESTAMP (not TIMESTAMP_NTZ) for a watermark;
``event_time`` casts in the session zone (UTC).  State lives in the
checkpoint folder under the shared scratch root; the RocksDB provider keeps
large state off the JVM heap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from optlake.operators import bars as B
from optlake.operators import merge as M
from optlake.operators import requests as L
from optlake.operators import tasks as T
from optlake.operators.normalize import normalize
from optlake.session import path_exists
from optlake.sources.keyed import KeyedTable
from optlake.sources.pages import page_records, parse_pages

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB (off-heap, spills to local disk,
    checkpointed to the shared folder) unless a provider is already chosen."""
    key = "spark.sql.streaming.stateStore.providerClass"
    current = spark.conf.get(key, None)
    if not current or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB)


def event_time(col: str) -> Column:
    return F.col(col).cast("timestamp")


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File-source stream.  ``path`` may be a folder or a glob."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def landing_stream(spark: SparkSession, landing_glob: str, endpoint: str, one_page_per_file: bool = True,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed pages -> normalised rows, as files arrive.  A landing file
    holds one page, or (``one_page_per_file=False``) one page per line."""
    r = spark.readStream.format("text").option("wholetext", one_page_per_file)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.load(landing_glob)
    page_id = (F.col("_metadata.file_path") if one_page_per_file
               else F.concat_ws(":", F.col("_metadata.file_path"), F.xxhash64("value").cast("string")))
    pages = raw.select(page_id.alias("page_id"), F.col("value").alias("page_text"))
    return normalize(page_records(parse_pages(pages)), endpoint, keep=["page_id", "pos"])


def _start(df_writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = df_writer.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def bars_stream(ticks: DataFrame, bar_width: str, lateness: str, sink: str, checkpoint: str,
                ts: str = "t", available_now: bool = True) -> StreamingQuery:
    """Bars in append mode; a window is written once the watermark
    (max event time - lateness) passes its end; later ticks for it drop."""
    t = ticks.withColumn(ts, event_time(ts)).withWatermark(ts, lateness)
    bars = B.ticks_to_bars(t, bar_width, ts=ts).drop("notional")
    return _start(bars.writeStream.format("parquet").outputMode("append").option("path", sink), checkpoint, available_now)


def quota_stream(log: DataFrame, lateness: str, sink: str, checkpoint: str, ts: str = "created_at",
                 available_now: bool = True) -> StreamingQuery:
    """Requests and call units per minute, closed minutes appended."""
    s = log.withColumn(ts, event_time(ts)).withWatermark(ts, lateness)
    q = L.quota_per_minute(s, ts=ts)
    return _start(q.writeStream.format("parquet").outputMode("append").option("path", sink), checkpoint, available_now)


def dedupe_stream(rows: DataFrame, key: list[str], ts: str, lateness: str, sink: str, checkpoint: str,
                  available_now: bool = True) -> StreamingQuery:
    """The first row of each key within the lateness bound (keep-first;
    keep-last needs the X2 fold)."""
    s = rows.withColumn(ts, event_time(ts)).withWatermark(ts, lateness).dropDuplicatesWithinWatermark(key)
    return _start(s.writeStream.format("parquet").outputMode("append").option("path", sink), checkpoint, available_now)


def _apply_to(table: KeyedTable, seq: str | None = None):
    """foreachBatch body: each micro-batch is one delta of a keyed table, its version the batch id."""
    def run(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch, batch_id, seq=seq)

    return run


def task_state_stream(events: DataFrame, table: KeyedTable, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """The T4 fold as a streaming aggregation (update mode); each batch's changed task rows are one delta of
    ``table`` (keyed by task_id, the later batch wins)."""
    state = T.task_state(events)
    return _start(state.writeStream.outputMode("update").foreachBatch(_apply_to(table)), checkpoint, available_now)


def bar_table(spark: SparkSession, root: str, **options) -> KeyedTable:
    """Table of mergeable bar states: deltas add up with what is held."""
    return KeyedTable(spark, root, ["contract", "tradetime"], fold=B.merge_states, **options)


def late_bars_stream(ticks: DataFrame, bar_width: str, table: KeyedTable, checkpoint: str, changelog: str | None = None,
                     ts: str = "t", available_now: bool = True) -> StreamingQuery:
    """X3 with corrections: bars that stay right however late a tick comes.

    A micro-batch becomes partial bar states, one delta of ``table``; there is no watermark and nothing is dropped.  A
    tick for a bar that was written long ago changes that bar alone.  With ``changelog`` each batch also writes what it
    changed there, as finished bars with ``op`` -1 (retracted) and 1 (inserted), under ``v=<batch id>``; a batch that is
    replayed finds its version applied, so states are never added twice."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table.apply(B.bar_states(batch, bar_width, ts=ts), batch_id, compact=False)
        done = changelog and path_exists(spark, f"{changelog}/v={batch_id}/_SUCCESS")
        if changelog and not done and batch_id in table.versions()[1]:
            changed = table.changes(batch_id)
            if changed is not None:
                B.finish_states(changed, ["op"]).write.mode("overwrite").parquet(f"{changelog}/v={batch_id}")
        table.compact_if_due()

    timed = ticks.withColumn(ts, event_time(ts))
    return _start(timed.writeStream.foreachBatch(run), checkpoint, available_now)


def eod_table(spark: SparkSession, root: str, **options) -> KeyedTable:
    """End-of-day rows by (contract, tradetime) whose deltas fold with the W1 upsert."""
    return KeyedTable(spark, root, ["contract", "tradetime"], fold=lambda rows, key, seq: M.upsert_eod(None, rows, seq=seq, key=key),
                      **options)


def upsert_delta_stream(staged: DataFrame, table: KeyedTable, checkpoint: str, seq: str = "seq",
                        available_now: bool = True) -> StreamingQuery:
    """X2 without rewriting what is held: each micro-batch is folded by itself (W1) and kept as one delta; identity,
    last quotes and last JSON meet when the table is read or compacted."""
    return _start(staged.writeStream.foreachBatch(_apply_to(table, seq)), checkpoint, available_now)


def upsert_stream(staged: DataFrame, store, checkpoint: str, seq: str = "seq",
                  available_now: bool = True) -> StreamingQuery:
    """Each micro-batch folded into the option_eod table of ``store``
    (a ``TableStore``) with the W1 upsert, rewriting only the trade months the
    batch touches.

    Rows are ordered by (batch id, seq) after the held rows; the fold is
    idempotent, so a batch replayed after a failure leaves the table
    unchanged (``fetched_at`` must come from the input, not the clock)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(seq, F.struct(F.lit(batch_id).cast("long").alias("batch"), F.col(seq).alias("row")))
        store.upsert_eod(rows, seq=seq)

    return _start(staged.writeStream.foreachBatch(run), checkpoint, available_now)
