"""Table constraints as queries: NOT NULL / value sets with reasons, duplicate
keys, orphans, rule counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The allowed option types and task statuses.
OPTION_TYPES = ["put", "call"]
TASK_STATUSES = ["pending", "running", "completed", "failed"]


def reasons(not_null: list[str] = (), allowed: dict[str, list] | None = None,
            rules: dict[str, Column] | None = None) -> Column:
    """Array of violated rules for a row (empty when the row is good)."""
    parts = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in not_null]
    for c, values in (allowed or {}).items():
        parts.append(F.when(F.col(c).isNotNull() & ~F.col(c).isin(*values), F.lit(f"{c} not allowed")))
    for name, bad in (rules or {}).items():
        parts.append(F.when(bad, F.lit(name)))
    return F.array_compact(F.array(*parts)) if parts else F.array().cast("array<string>")


def validate(df: DataFrame, not_null: list[str] = (), allowed: dict[str, list] | None = None,
             rules: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """V1/V4: split into good rows and quarantined rows with a ``reasons``
    array, from one tagged scan (cache it if both sides are used)."""
    tagged = df.withColumn("reasons", reasons(not_null, allowed, rules))
    good = tagged.where(F.size("reasons") == 0).drop("reasons")
    bad = tagged.where(F.size("reasons") > 0)
    return good, bad


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """V2: keys held more than once, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, on: list[str]) -> DataFrame:
    """V3: child rows whose key has no parent row."""
    return child.join(parent.select(*on).distinct(), on, "left_anti")


def rule_counts(df: DataFrame, rules: dict[str, Column], table: str) -> DataFrame:
    """Rows breaking each rule, one output row per rule (zeros included),
    from a single aggregation."""
    agg = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, bad in enumerate(rules.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("bad_rows")) for i, name in enumerate(rules)])
    return agg.select(F.lit(table).alias("table_name"), F.explode(rows).alias("r")).select("table_name", "r.rule", "r.bad_rows")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
