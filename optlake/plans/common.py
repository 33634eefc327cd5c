"""Shared building blocks of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from optlake.operators.merge import keep_last
from optlake.operators.strategy import option_chain
from optlake.plans import fixtures as fx


def _held_by_part(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    # The contract code is a function of the part key: fold and join on the
    # 8-byte key and format the code once per output row, instead of hashing
    # and shuffling the string.
    raw = fx.eod_raw_like(spark, sf_dir).select(
        "part_key", "tradetime", "bid", "ask", "volatility", "delta", "raw_json",
        "volume", "open_interest", "fetched_at", "seq")
    if keys is not None:  # before the fold, so rows of other contracts are neither sorted nor shuffled
        raw = raw.join(keys, "part_key", "left_semi")
    return keep_last(raw, ["part_key", "tradetime"])


def held_eod(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-last over the raw quote rows: the end-of-day table as held."""
    held = _held_by_part(spark, sf_dir)
    return held.select(fx.contract_code(F.col("part_key")).alias("contract"),
                       *[c for c in held.columns if c != "part_key"])


def chain(spark: SparkSession, sf_dir: str, option_type: str | None = None) -> DataFrame:
    """Held end-of-day rows (of one option type) joined to their contract identity."""
    ident = fx.contracts_like(spark, sf_dir, with_part_key=True).withColumnRenamed("p_partkey", "part_key")
    if option_type is not None:
        ident = ident.where(F.col("option_type") == option_type)
    held = _held_by_part(spark, sf_dir, None if option_type is None else ident.select("part_key")).drop("raw_json", "fetched_at")
    return option_chain(held, ident, on="part_key").drop("part_key")
