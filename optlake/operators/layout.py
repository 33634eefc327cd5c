"""File layout over several columns at once: rows in the order of a space-filling curve.

Sorting by (a, b, c) keeps files narrow in a alone.  Here every column's values
are ranked and scaled to 2^bits steps, and the bits of the ranks are interleaved:
rows that are near on the curve are near in every column, so files and row
groups have narrow minima and maxima in each, and filters on any of them prune.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from optlake.operators.tasks import global_index


def scaled_ranks(df: DataFrame, column: str, bits: int) -> DataFrame:
    """(value, step): every distinct value with its rank scaled to 0 .. 2^bits - 1.

    The distinct values are numbered by a range-partitioned sort, so a column may have any number of them."""
    values = global_index(df.select(F.col(column).alias("value")).where("value is not null").distinct(), ["value"], "at")
    return values.select("value", F.floor(F.col("at") * (1 << bits) / F.lit(max(values.count(), 1))).cast("int").alias("step"))


def interleave(steps: list[Column], bits: int) -> Column:
    """Bits of all steps in turn, the highest first."""
    if bits * len(steps) > 63:
        raise ValueError("a curve has at most 63 bits")
    curve = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for step in steps:
            curve = F.shiftleft(curve, 1).bitwiseOR(F.shiftright(step, b).bitwiseAND(F.lit(1)).cast("long"))
    return curve


def step_bounds(df: DataFrame, column: str, bits: int) -> list[tuple]:
    """(least value, step) of every step of ``scaled_ranks`` in order: 2^bits rows at most, whatever the column holds."""
    ranks = scaled_ranks(df, column, bits).groupBy("step").agg(F.min("value").alias("value"))
    return [(r.value, r.step) for r in ranks.orderBy("step").collect()]


def step_of(value: Column, bounds: list[tuple], type_) -> Column:
    """The step whose range of values holds ``value``: halving the bounds, without a join (NULLs stand at step 0)."""
    if not bounds:
        return F.lit(0)
    if len(bounds) == 1:
        return F.lit(bounds[0][1])
    half = len(bounds) // 2
    low, high = step_of(value, bounds[:half], type_), step_of(value, bounds[half:], type_)
    return F.when(value >= F.lit(bounds[half][0]).cast(type_), high).otherwise(low)


def with_curve(df: DataFrame, columns: list[str], bits: int = 8, name: str = "__curve") -> DataFrame:
    """The rows with their place on the curve over ``columns`` (NULLs stand at step 0).

    A row's steps are found by comparing its values with the bounds of the steps, so the rows are not shuffled."""
    steps = [step_of(F.col(c), step_bounds(df, c, bits), df.schema[c].dataType) for c in columns]
    stepped = df.select("*", *[s.alias(f"__s{n}") for n, s in enumerate(steps)])
    curve = interleave([F.col(f"__s{n}") for n in range(len(columns))], bits)
    return stepped.withColumn(name, curve).drop(*[f"__s{n}" for n in range(len(columns))])


def along_curve(curved: DataFrame, columns: list[str], files: int, within: list[str] = ()) -> DataFrame:
    """Rows of ``with_curve`` dealt into ``files`` ranges of the curve (inside each combination of ``within``) and sorted
    along it.  ``curved`` should be a written copy: range partitioning samples it before it reads it."""
    order = [*within, "__curve", *columns]
    return curved.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("__curve")
