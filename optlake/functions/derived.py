"""Derived option columns (the schema names them, nothing upstream computes them)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def days_to_expiry(exp_date="exp_date", tradetime="tradetime") -> Column:
    return F.datediff(_c(exp_date), F.to_date(_c(tradetime))).cast("int")


def vol_oi_ratio(volume="volume", open_interest="open_interest") -> Column:
    """volume / open interest; NULL when open interest is 0 or missing."""
    return F.try_divide(_c(volume), F.nullif(_c(open_interest), F.lit(0.0)))


def midpoint_fill(midpoint="midpoint", bid="bid", ask="ask") -> Column:
    """Vendor midpoint, else (bid + ask) / 2."""
    return F.coalesce(_c(midpoint), (_c(bid) + _c(ask)) / F.lit(2.0))


def credit(short_mid: Column | str, long_mid: Column | str) -> Column:
    """Entry credit of a vertical spread: short midpoint minus long midpoint."""
    return _c(short_mid) - _c(long_mid)


def exact_sum(col: Column | str, scale: int = 4) -> Column:
    """Order-independent sum of a double column (fixed-point, then back to double).

    A double sum depends on the order partials are combined, so two runs (or
    two engines) can differ in the last bits; a DECIMAL sum does not.
    """
    return F.sum(_c(col).cast(f"decimal(18,{scale})")).cast("double")
