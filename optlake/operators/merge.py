"""Merging reruns by key: keep-last, the field-wise EOD upsert, change labels,
contract and symbol refreshes.

Every fold here is one grouped aggregation of mergeable aggregates
(``max_by`` / ``min_by`` / ``min`` / ``max``): partial aggregation runs map-side
and there is one shuffle on the key, so a key that holds a large share of the
rows costs no more than its partial states.  Folds over structs plan as
sort-based aggregations: each task sorts its rows by key (spilling if it must)
before it folds them.  A fold given ``within`` (columns that are functions of the
key) deals the rows out by those alone before it folds, so a writer that lays
files out by them needs no second shuffle; a key's rows then meet in one task.

``seq`` orders the rows of a key (later wins).  It may be any orderable type
(a long, or a struct such as (load id, file, position)) and must be unique
within a key, or the result would depend on timing.  It must not be NULL:
``max_by`` / ``min_by`` skip rows whose ordering is NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from optlake.schemas import EOD_IDENTITY_COLUMNS, EOD_KEY, EOD_QUOTE_COLUMNS

_ORDER = "__order"
_HELD = "__held"
_HASH = "__hash"


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union aligned by column name; a column missing on one side is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _expand(df: DataFrame, struct_col: str, names: list[str]) -> list[Column]:
    return [F.col(f"{struct_col}.{n}").alias(n) for n in names]


def _by_key(rows: DataFrame, key: list[str], within: list[str]):
    """Rows grouped by key.  With ``within`` they are dealt out by those columns first; a hash of the key then stands
    first in the grouping, so the sort before the fold compares numbers and seldom texts."""
    if not within:
        return rows.groupBy(*key)
    return rows.repartition(*within).withColumn(_HASH, F.xxhash64(*key)).groupBy(_HASH, *within, *key)


def keep_last(df: DataFrame, key: list[str] | None, seq: str = "seq", keep_seq: bool = False, within: list[str] = ()) -> DataFrame:
    """One row per key: the row with the highest ``seq``.

    Without a key, exact duplicate rows are dropped instead.  With ``within`` the rows are dealt out by these columns,
    which stay in the result.
    """
    if not key:
        return df.dropDuplicates()
    groups, key = _by_key(df, key, within), [*within, *key]
    rest = [c for c in df.columns if c not in key and (keep_seq or c != seq)]
    picked = groups.agg(F.max_by(F.struct(*rest), F.col(seq)).alias("__row"))
    return picked.select(*key, *_expand(picked, "__row", rest))


def merge_keep_last(held: DataFrame, fresh: DataFrame, key: list[str], seq: str = "seq", within: list[str] = ()) -> DataFrame:
    """Held rows then fresh rows, aligned by name, last row per key wins (U1+U2).

    Fresh rows beat held rows whatever their ``seq``: the merge order is
    (side, seq), held side first.  Rows are dealt out by ``within``, if given.
    """
    h = held.withColumn(_HELD, F.lit(0))
    f = fresh.withColumn(_HELD, F.lit(1))
    both = union_by_name(h, f).withColumn(_ORDER, F.struct(F.col(_HELD), F.col(seq)))
    out = keep_last(both.drop(_HELD), key, seq=_ORDER, within=within)
    return out.drop(seq) if seq in out.columns else out


def _order_struct(df: DataFrame, seq: str | None, held: bool) -> Column:
    # held rows sort before every staged row; their own seq (if any) breaks ties
    inner = F.col(seq) if seq and seq in df.columns else F.lit(None)
    return F.struct(F.lit(0 if held else 1).alias("side"), inner.alias("seq"))


def upsert_eod(
    held: DataFrame | None,
    staged: DataFrame,
    seq: str = "seq",
    key: list[str] = EOD_KEY,
    identity: list[str] = EOD_IDENTITY_COLUMNS,
    quotes: list[str] = EOD_QUOTE_COLUMNS,
    stamp: str | None = "fetched_at",
    raw: str | None = "raw_json",
    within: list[str] = (),
) -> DataFrame:
    """Field-wise upsert of end-of-day rows on (contract, tradetime).

    Per key, over held rows then staged rows in ``seq`` order:
      * identity columns (underlying, expiry, type, strike) and every column
        the upsert does not write keep the value of the first row (the held
        row when there is one);
      * the quote columns and the fetch stamp take the last row's values,
        NULLs included (an incoming NULL overwrites);
      * ``raw_json`` is the last non-NULL value (an incoming NULL keeps the old).
    Applying the same staged rows twice gives the same table (idempotent),
    provided the staged rows carry their own ``fetched_at``.
    Columns of the staged rows that the upsert does not write are filled in on
    insert (our ingest computes them); the reference insert left them NULL.
    Rows are dealt out by ``within``, if given; these columns stay in the result.
    """
    parts = []
    if held is not None:
        parts.append(held.withColumn(_ORDER, _order_struct(held, seq, True)))
    parts.append(staged.withColumn(_ORDER, _order_struct(staged, seq, False)))
    rows = union_by_name(*parts)
    if seq in rows.columns:
        rows = rows.drop(seq)
    given, key = key, [*within, *key]
    cols = [c for c in rows.columns if c != _ORDER]
    last_cols = [c for c in quotes + ([stamp] if stamp else []) if c in cols]
    first_cols = [c for c in cols if c not in key and c not in last_cols and c != raw]
    aggs = [F.max_by(F.struct(*last_cols), F.col(_ORDER)).alias("__last")]
    if first_cols:
        aggs.append(F.min_by(F.struct(*first_cols), F.col(_ORDER)).alias("__first"))
    if raw and raw in cols:
        aggs.append(F.max_by(F.col(raw), F.when(F.col(raw).isNotNull(), F.col(_ORDER))).alias(raw))
    folded = _by_key(rows, given, within).agg(*aggs)
    out_cols = []
    for c in cols:
        if c in key:
            out_cols.append(F.col(c))
        elif c in last_cols:
            out_cols.append(F.col(f"__last.{c}").alias(c))
        elif c == raw:
            out_cols.append(F.col(raw))
        else:
            out_cols.append(F.col(f"__first.{c}").alias(c))
    return folded.select(*out_cols)


def change_labels(
    held: DataFrame,
    staged: DataFrame,
    seq: str = "seq",
    key: list[str] = EOD_KEY,
    compare: list[str] | None = None,
    quotes: list[str] = EOD_QUOTE_COLUMNS,
    raw: str | None = "raw_json",
) -> DataFrame:
    """Per key: 'inserted' (not held before), 'updated' (a compared column
    changed, NULL-safe) or 'unchanged' after the W1 upsert (W2).

    One aggregation computes the held state and the upserted state, without
    an outer join.  ``held`` may be raw held rows: the held state takes the last
    row's quotes and the last non-NULL ``raw``, as W1 does.
    """
    h = held.withColumn(_ORDER, _order_struct(held, seq, True)).withColumn(_HELD, F.lit(True))
    s = staged.withColumn(_ORDER, _order_struct(staged, seq, False)).withColumn(_HELD, F.lit(False))
    rows = union_by_name(h, s)
    cols = [c for c in rows.columns if c not in (_ORDER, _HELD, seq) and c not in key]
    compare = [c for c in (compare or [q for q in quotes if q in cols] + ([raw] if raw in cols else []))]
    last_q = [c for c in compare if c != raw]
    aggs = [
        F.max(F.col(_HELD).cast("int")).alias("__was_held"),
        F.min(F.col(_HELD).cast("int")).alias("__untouched"),
        F.max_by(F.struct(*last_q), F.when(F.col(_HELD), F.col(_ORDER))).alias("__before"),
        F.max_by(F.struct(*last_q), F.col(_ORDER)).alias("__after"),
    ]
    if raw in compare:
        known = F.col(raw).isNotNull()
        aggs.append(F.max_by(F.col(raw), F.when(known, F.col(_ORDER))).alias("__after_raw"))
        aggs.append(F.max_by(F.col(raw), F.when(known & F.col(_HELD), F.col(_ORDER))).alias("__before_raw"))
    # keys the staged rows do not touch are not part of this upsert
    g = rows.groupBy(*key).agg(*aggs).where(F.col("__untouched") == 0)
    same = [F.col(f"__before.{c}").eqNullSafe(F.col(f"__after.{c}")) for c in last_q]
    if raw in compare:
        same.append(F.col("__before_raw").eqNullSafe(F.col("__after_raw")))
    all_same = reduce(lambda a, b: a & b, same) if same else F.lit(True)
    label = (F.when(F.col("__was_held") == 0, F.lit("inserted"))
             .when(all_same, F.lit("unchanged"))
             .otherwise(F.lit("updated")))
    return g.select(*key, label.alias("change"))


def change_counts(labels: DataFrame) -> DataFrame:
    """inserted / updated / unchanged totals (the upsert result counters)."""
    return labels.agg(
        F.count_if(F.col("change") == "inserted").alias("inserted_rows"),
        F.count_if(F.col("change") == "updated").alias("updated_rows"),
        F.count_if(F.col("change") == "unchanged").alias("skipped_existing_rows"),
    )


# Columns of a contract that a sighting without them must not blank.
CONTRACT_KEPT = ("expiration_type", "exchange", "currency")


def contracts_seen(
    observations: DataFrame,
    seen: str = "seen_at",
    seq: str = "seq",
    key: str = "contract",
    identity: list[str] = ("underlying_symbol", "exp_date", "option_type", "strike"),
    kept: list[str] = CONTRACT_KEPT,
    raw: str | None = "raw_json",
    held: DataFrame | None = None,
) -> DataFrame:
    """Contracts refresh (W3): identity columns from the latest observation;
    expiration_type, exchange, currency and raw_json the latest non-NULL;
    first_seen_at = earliest sighting, last_seen_at = latest.  ``held`` (the
    contracts as stored) counts as a sighting before all others."""
    rows = observations.withColumn("__first", F.col(seen)).withColumn("__last", F.col(seen))
    rows = rows.withColumn(_ORDER, _order_struct(observations, seq, False)).drop(seen, seq)
    if held is not None:
        before = held.withColumn("__first", F.col("first_seen_at")).withColumn("__last", F.col("last_seen_at"))
        before = before.withColumn(_ORDER, F.struct(F.lit(0).alias("side"), F.lit(None).cast(
            rows.schema[_ORDER].dataType["seq"].dataType).alias("seq"))).drop("first_seen_at", "last_seen_at")
        rows = union_by_name(before, rows)
    ident = [c for c in identity if c in rows.columns]
    late = [c for c in (*kept, *([raw] if raw else [])) if c in rows.columns]
    folded = rows.groupBy(key).agg(
        F.min("__first").alias("first_seen_at"), F.max("__last").alias("last_seen_at"),
        F.max_by(F.struct(*ident), F.col(_ORDER)).alias("__id"),
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(_ORDER))).alias(c) for c in late])
    return folded.select(key, *[F.col(f"__id.{c}").alias(c) for c in ident], *late, "first_seen_at", "last_seen_at")


def symbol_universe(symbol_rows: DataFrame, fetched: str = "fetched_at") -> DataFrame:
    """Underlying symbols refresh (W4): one row per symbol, first and latest
    fetch time, and the latest non-NULL of any other column."""
    rest = [c for c in symbol_rows.columns if c not in ("underlying_symbol", fetched)]
    return symbol_rows.groupBy("underlying_symbol").agg(
        F.min(fetched).alias("first_fetched_at"),
        F.max(fetched).alias("fetched_at"),
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(F.col(fetched), F.col(c).cast("string")))).alias(c) for c in rest],
    )


def write_order(df: DataFrame, event_date: str = "event_date", row_key: list[str] | None = None) -> DataFrame:
    """Row order inside files (U3): by event date then key, nulls last.

    Sorting within partitions keeps row-group statistics tight for pruning
    without a global sort."""
    cols = [F.col(event_date).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in (row_key or [])]
    return df.sortWithinPartitions(*cols)
