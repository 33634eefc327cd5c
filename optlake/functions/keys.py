"""Key and signature expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Paging keys never take part in a request signature, and the
# trade-date filter keys are left out so that windows of one query shape share
# a slice; the slice name keeps the first 24 hex digits of the SHA-1.
PAGING_PARAM_KEYS = ("page[offset]", "page[limit]")
DATE_FILTER_PARAM_KEYS = ("filter[tradetime_eq]", "filter[tradetime_from]", "filter[tradetime_to]")
SIGNATURE_PREFIX_DIGITS = 24


def sorted_json(fields: dict[str, Column]) -> Column:
    """JSON object text with keys in name order; NULL members are left out."""
    return F.to_json(F.struct(*[fields[name].alias(name) for name in sorted(fields)]))


def request_signature(endpoint: Column | str, params: dict[str, Column], include_date_filters: bool = False) -> Column:
    """SHA-1 hex of {"endpoint":..,"params":{sorted non-null params}} (compact JSON).

    ``to_json`` drops NULL members, which is exactly the "null = not given"
    rule of the filter set.  Booleans are sent as 0/1.
    """
    kept = {}
    for key, value in params.items():
        if key in PAGING_PARAM_KEYS:
            continue
        if not include_date_filters and key in DATE_FILTER_PARAM_KEYS:
            continue
        kept[key] = value
    ep = F.lit(endpoint) if isinstance(endpoint, str) else endpoint
    payload = F.to_json(F.struct(ep.alias("endpoint"), F.struct(*[kept[k].alias(k) for k in sorted(kept)]).alias("params")))
    return F.sha1(payload)


def slice_name(endpoint: Column | str, signature: Column) -> Column:
    ep = F.lit(endpoint) if isinstance(endpoint, str) else endpoint
    return F.concat_ws("_", F.lit("opt"), ep, F.substring(signature, 1, SIGNATURE_PREFIX_DIGITS))


def row_hash(cols: list[str]) -> Column:
    """Fallback row key: SHA-1 of the row as JSON with columns in name order."""
    return F.sha1(F.to_json(F.struct(*[F.col(c) for c in sorted(cols)])))


def first_non_empty(a: Column, b: Column) -> Column:
    """``a`` unless it is NULL or '', then ``b``."""
    return F.coalesce(F.nullif(a, F.lit("")), b)
