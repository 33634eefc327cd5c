"""Filter set, trade-date window, field list, output order and paging.

A filter argument that is None is not applied.  Filters are plain column
predicates, so Catalyst pushes them into the Parquet scan (row-group
statistics) and, for partition columns, prunes whole folders.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, fields as dc_fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from optlake.functions.dates import parse_bound, parse_date_arg
from optlake.operators.tasks import global_index

# Page size default and upper bound.
DEFAULT_PAGE_LIMIT = 1000
MAX_PAGE_LIMIT = 1000
HIDDEN_PREFIX = "__"


@dataclass
class FilterSet:
    """Optional filters of a contracts / end-of-day request (F1, F2)."""

    contract: str | None = None
    underlying_symbol: str | None = None
    option_type: str | None = None
    exp_date_eq: object = None
    exp_date_from: object = None
    exp_date_to: object = None
    strike_eq: float | None = None
    strike_from: float | None = None
    strike_to: float | None = None
    tradetime_eq: object = None
    tradetime_from: object = None
    tradetime_to: object = None
    range_from: object = None
    range_to: object = None
    fields: object = None
    sort: str | None = None
    limit: int | None = None
    extra: dict = field(default_factory=dict)

    def given(self) -> dict:
        return {f.name: getattr(self, f.name) for f in dc_fields(self)
                if f.name != "extra" and getattr(self, f.name) is not None}


def resolve_window(fs: FilterSet) -> tuple[_dt.date | None, _dt.date | None]:
    """Trade-date window (F2): range bounds win, then the exact date, then
    from/to.  Bounds are whole UTC days, both inclusive."""
    start = parse_bound(fs.range_from, "range_from")
    end = parse_bound(fs.range_to, "range_to")
    if start is not None or end is not None:
        return start, end
    eq = parse_date_arg(fs.tradetime_eq, "tradetime_eq")
    if eq is not None:
        return eq, eq
    return parse_date_arg(fs.tradetime_from, "tradetime_from"), parse_date_arg(fs.tradetime_to, "tradetime_to")


def window_predicate(date_col: Column, start, end) -> Column | None:
    """Inclusive day window; rows with a NULL date fail any given bound."""
    preds = []
    if start is not None:
        preds.append(date_col >= F.lit(start))
    if end is not None:
        preds.append(date_col <= F.lit(end))
    if not preds:
        return None
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def apply_window(df: DataFrame, start, end, date_col: str = "tradetime") -> DataFrame:
    """Whole-day window on a DATE or TIMESTAMP column, written as plain
    comparisons on the column (``ts >= start 00:00 and ts < end+1 00:00``)
    so the Parquet reader can push them; other types compare their date."""
    dtype = dict(df.dtypes).get(date_col)
    c = F.col(date_col)
    if dtype == "date":
        pred = window_predicate(c, start, end)
    elif dtype in ("timestamp", "timestamp_ntz"):
        preds = []
        if start is not None:
            preds.append(c >= F.lit(f"{start.isoformat()} 00:00:00").cast(dtype))
        if end is not None:
            nxt = end + _dt.timedelta(days=1)
            preds.append(c < F.lit(f"{nxt.isoformat()} 00:00:00").cast(dtype))
        pred = None
        for p in preds:
            pred = p if pred is None else pred & p
    else:
        pred = window_predicate(F.to_date(c), start, end)
    return df if pred is None else df.where(pred)


def contract_predicates(fs: FilterSet) -> list[Column]:
    """Column predicates for the identity filters that were given (F1)."""
    preds: list[Column] = []
    if fs.contract is not None:
        preds.append(F.col("contract") == F.lit(fs.contract))
    if fs.underlying_symbol is not None:
        preds.append(F.col("underlying_symbol") == F.lit(fs.underlying_symbol))
    if fs.option_type is not None:
        preds.append(F.col("option_type") == F.lit(fs.option_type))
    for name, op in (("exp_date_eq", "=="), ("exp_date_from", ">="), ("exp_date_to", "<=")):
        value = parse_date_arg(getattr(fs, name), name)
        if value is not None:
            preds.append(_cmp(F.col("exp_date"), op, F.lit(value)))
    for name, op in (("strike_eq", "=="), ("strike_from", ">="), ("strike_to", "<=")):
        value = getattr(fs, name)
        if value is not None:
            preds.append(_cmp(F.col("strike"), op, F.lit(float(value))))
    for name, value in fs.extra.items():
        if value is not None:
            preds.append(F.col(name) == F.lit(int(value) if isinstance(value, bool) else value))
    return preds


def _cmp(c: Column, op: str, v: Column) -> Column:
    return {"==": c == v, ">=": c >= v, "<=": c <= v}[op]


def normalize_fields(fields) -> list[str]:
    """Field list from a list/tuple or comma text; blanks dropped; empty = all."""
    if fields is None:
        return []
    items = fields.split(",") if isinstance(fields, str) else list(fields)
    return [str(x).strip() for x in items if str(x).strip()]


def project(df: DataFrame, fields) -> DataFrame:
    names = normalize_fields(fields)
    return df.select(*names) if names else df


def drop_hidden(df: DataFrame) -> DataFrame:
    """Remove internal bookkeeping columns from user output."""
    return df.drop(*[c for c in df.columns if c.startswith(HIDDEN_PREFIX)])


def sort_columns(sort: str | None, available: list[str], tie_break: list[str]) -> list[Column]:
    """Output order (O1): '-name' is descending; any column may be named;
    unknown or missing -> tradetime ascending.  Nulls last both ways; the key
    columns break ties so pages are stable."""
    out: list[Column] = []
    name = (sort or "").strip()
    desc = name.startswith("-")
    name = name.lstrip("-+")
    if name and name in available:
        out.append(F.col(name).desc_nulls_last() if desc else F.col(name).asc_nulls_last())
    elif "tradetime" in available:
        out.append(F.col("tradetime").asc_nulls_last())
    used = {name} if name in available else {"tradetime"}
    out += [F.col(k).asc_nulls_last() for k in tie_break if k in available and k not in used]
    return out


def clamp_page_limit(limit) -> int:
    """Page size clamped to 1..1000 (O2)."""
    if limit is None:
        return DEFAULT_PAGE_LIMIT
    return max(1, min(int(limit), MAX_PAGE_LIMIT))


def ordered_page(df: DataFrame, sort: str | None, key: list[str], limit=None, after: dict | None = None) -> DataFrame:
    """One page of the ordered result: a top-k (TakeOrderedAndProject), never
    a full sort of the table.  ``after`` is the cursor, the last row of the page
    before (its sort and key columns): following it reaches every row once, when
    ``key`` is unique."""
    order = sort_columns(sort, df.columns, key)
    rows = df if after is None else df.where(after_cursor(sort, df.columns, key, after))
    return rows.orderBy(*order).limit(clamp_page_limit(limit))


def numbered_pages(df: DataFrame, sort: str | None, key: list[str], limit=None) -> DataFrame:
    """Every row with the number of its page (``page``, from 0) in the ordered result: what following the cursor from
    page to page gives, for all pages at once.  Rows are numbered by one range-partitioned sort, no page is a job."""
    numbered = global_index(df, sort_columns(sort, df.columns, key), "__idx")
    return numbered.withColumn("page", F.floor(F.col("__idx") / clamp_page_limit(limit)).cast("long")).drop("__idx")


def after_cursor(sort: str | None, available: list[str], key: list[str], after: dict) -> Column:
    """Rows that follow the cursor row in ``sort_columns`` order (NULLs last)."""
    name = (sort or "").strip()
    desc, name = name.startswith("-"), name.lstrip("-+")
    first = name if name in available else ("tradetime" if "tradetime" in available else None)
    names = ([first] if first else []) + [k for k in key if k in available and k != first]
    out = F.lit(False)
    for c in reversed(names):
        col, value = F.col(c), after[c]
        if value is None:
            beyond, same = F.lit(False), col.isNull()
        else:
            beyond = col.isNull() | (col < F.lit(value) if desc and c == name else col > F.lit(value))
            same = col == F.lit(value)
        out = F.coalesce(beyond, F.lit(False)) | (F.coalesce(same, F.lit(False)) & out)
    return out


def next_page(df: DataFrame, key: str, after, limit=None) -> DataFrame:
    """Keyset paging: rows with key > last key seen, in key order."""
    rows = df if after is None else df.where(F.col(key) > F.lit(after))
    return rows.orderBy(F.col(key).asc()).limit(clamp_page_limit(limit))


def apply_filter_set(df: DataFrame, fs: FilterSet, date_col: str = "tradetime") -> DataFrame:
    """Identity filters + trade-date window + field list.

    The window applies to ``date_col`` only; contracts have no trade date, so
    for them an expiry filter must be given explicitly (no tradetime-on-expiry
    surprise).
    """
    out = df
    for p in contract_predicates(fs):
        out = out.where(p)
    if date_col in df.columns:
        start, end = resolve_window(fs)
        out = apply_window(out, start, end, date_col)
    return project(drop_hidden(out), fs.fields)


def symbol_defaults(symbols: DataFrame, market: str = "stocks", active: bool = True) -> DataFrame:
    """Symbol universe defaults (F7): market = stocks, active only, by ticker."""
    out = symbols
    if "market" in symbols.columns and market is not None:
        out = out.where(F.col("market") == F.lit(market))
    if "active" in symbols.columns and active is not None:
        out = out.where(F.col("active") == F.lit(active))
    return out
