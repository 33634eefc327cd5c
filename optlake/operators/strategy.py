"""Chain slices, nearest-strike legs and vertical-spread credits.

Nearest strike is a two-sided as-of merge: the targets of the entries and the
strikes of their chain are put in one order per chain; the last strike at or
below a target and the first above it come from two running windows, and the
nearer one wins.  The cost is that of sorting entries plus strikes, never their
product, and every entry row keeps its own result.  Entries of a chain that has
very many are dealt into parts, each with a copy of the chain's strikes.  Ties in
distance go to the lower strike, then the lower contract code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from optlake.functions.derived import credit, midpoint_fill
from optlake.operators.filters import FilterSet, apply_filter_set

CHAIN_KEY = ["underlying_symbol", "tradetime", "exp_date", "option_type"]

# Fixed values of the put-spread plan: short strike at 90 % of the close,
# long strike 5 below the short one.
SHORT_STRIKE_FACTOR = 0.90
SPREAD_WIDTH = 5.0


def option_chain(eod: DataFrame, contracts: DataFrame, on: str = "contract") -> DataFrame:
    """End-of-day rows with their contract identity and a filled midpoint.

    ``on`` names the contract key shared by both sides (the contract code, or
    a compact surrogate of it)."""
    ident = contracts.select(*dict.fromkeys([on, "contract", "underlying_symbol", "exp_date", "option_type", "strike"]))
    rows = eod.drop(*[c for c in ("contract", "underlying_symbol", "exp_date", "option_type", "strike")
                      if c in eod.columns and c != on])
    chain = rows.join(ident, on)
    mid = midpoint_fill("midpoint" if "midpoint" in chain.columns else F.lit(None).cast("double"))
    return chain.withColumn("midpoint", mid)


def chain_slice(chain: DataFrame, fs: FilterSet) -> DataFrame:
    """Chain slice (F6): the filter set applied to the joined chain."""
    return apply_filter_set(chain, fs)


def chain_entries(chain: DataFrame, option_type: str = "put", spot_divisor: float = 1.8) -> DataFrame:
    """One entry per (underlying, trade date, expiry) of the ``option_type``
    chain, with a stand-in close: (lowest + highest strike) / ``spot_divisor``."""
    # grouped on all four chain keys, in join-key order, so the entries come
    # out hash-partitioned the way the nearest-strike join needs them
    return (chain.where(F.col("option_type") == option_type)
            .groupBy(*CHAIN_KEY)
            .agg(((F.min("strike") + F.max("strike")) / F.lit(spot_divisor)).alias("spot")))


# Entries of one chain from which on they are dealt into parts of about this many.
PART_ENTRIES = 500_000


def _parts(entries: DataFrame, on: list[str]) -> DataFrame:
    """(chain, parts) of the chains with more than PART_ENTRIES entries: at most one row for so many entries."""
    names = [F.col(c).alias(f"__{c}") for c in on]
    return (entries.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / PART_ENTRIES).cast("int").alias("__parts"))
            .where("__parts > 1").select(*names, "__parts"))


def nearest_strike(entries: DataFrame, chain: DataFrame, target: str = "target",
                   on: list[str] = CHAIN_KEY, prefix: str = "") -> DataFrame:
    """For each entry row, the chain row whose strike is nearest ``target``.

    Returns the entry columns plus ``{prefix}contract``, ``{prefix}strike``,
    ``{prefix}midpoint``, one row per entry row, equal rows included.  Entries
    without a target, and those whose chain has no strike, drop out.
    """
    hot = _parts(entries, on)
    mine = [F.col(c) == F.col(f"__{c}") for c in on]
    parts = F.coalesce("__parts", F.lit(1))
    whole = F.struct(*[F.col(c) for c in entries.columns])
    leg = F.struct("strike", "contract", "midpoint")
    dealt = F.pmod(F.xxhash64(*entries.columns), parts).cast("int")  # of the row alone, so a task that runs again deals alike
    targets = entries.where(F.col(target).isNotNull()).join(hot, mine, "left").select(
        *on, dealt.alias("__part"), F.col(target).cast("double").alias("__at"),
        whole.alias("__entry"), F.lit(None).cast(chain.select(leg).schema[0].dataType).alias("__leg"))
    strikes = chain.where(F.col("strike").isNotNull()).select(*on, leg.alias("__leg")).join(hot, mine, "left").select(
        *on, F.explode(F.sequence(F.lit(0), parts - 1)).alias("__part"), F.col("__leg.strike").cast("double").alias("__at"),
        F.lit(None).cast(targets.schema["__entry"].dataType).alias("__entry"), "__leg")
    merged = targets.unionByName(strikes).where(F.concat(*[F.col(c).cast("string") for c in on]).isNotNull())

    # at one strike the lowest contract comes last in either direction; strikes stand before targets of the same value
    side, contract = F.col("__entry").isNotNull(), F.col("__leg.contract").desc()
    line = Window.partitionBy(*on, "__part")
    up = line.orderBy("__at", side, contract).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = line.orderBy(F.col("__at").desc(), side, contract).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = merged.select("__entry", "__at", F.last("__leg", ignorenulls=True).over(up).alias("__below"),
                        F.last("__leg", ignorenulls=True).over(down).alias("__above"))
    met = met.where(F.col("__entry").isNotNull() & (F.col("__below").isNotNull() | F.col("__above").isNotNull()))
    low = F.abs(F.col("__below.strike") - F.col("__at"))
    high = F.abs(F.col("__above.strike") - F.col("__at"))
    nearer = F.when(F.col("__above").isNull() | (low <= high), F.col("__below")).otherwise(F.col("__above"))
    return met.withColumn("__leg", nearer).select(
        "__entry.*", *[F.col(f"__leg.{c}").alias(f"{prefix}{c}") for c in ("contract", "strike", "midpoint")])


def short_leg(entries: DataFrame, chain: DataFrame, factor: float = SHORT_STRIKE_FACTOR) -> DataFrame:
    """G1: target = close x factor, nearest available strike."""
    e = entries.withColumn("target", F.lit(factor) * F.col("spot"))
    return nearest_strike(e, chain, "target")


def spread_credit(entries: DataFrame, chain: DataFrame, factor: float = SHORT_STRIKE_FACTOR,
                  width: float = SPREAD_WIDTH) -> DataFrame:
    """Short leg, long leg at short strike - width, credit = short mid - long mid."""
    short = short_leg(entries, chain, factor).select(
        *CHAIN_KEY, "spot",
        F.col("contract").alias("short_contract"), F.col("strike").alias("short_strike"),
        F.col("midpoint").alias("short_midpoint"))
    long_entries = short.withColumn("long_target", F.col("short_strike") - F.lit(width))
    both = nearest_strike(long_entries, chain, "long_target", prefix="long_")
    return both.withColumn("credit", credit("short_midpoint", "long_midpoint"))
