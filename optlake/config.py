"""Backfill job configuration record (driver-side, a few rows) and its
table form.

Fixed values: the field names and defaults of the job configuration.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


@dataclass
class BackfillConfig:
    endpoint: str
    underlying_symbol: str | None = None
    contract: str | None = None
    option_type: str | None = None
    exp_date_eq: str | None = None
    exp_date_from: str | None = None
    exp_date_to: str | None = None
    tradetime_eq: str | None = None
    tradetime_from: str | None = None
    tradetime_to: str | None = None
    strike_eq: float | None = None
    strike_from: float | None = None
    strike_to: float | None = None
    fields: tuple[str, ...] | None = None
    sort: str | None = None
    page_limit: int = 1000
    max_pages_per_task: int | None = 25
    max_concurrent_requests: int = 8
    requests_per_minute: int = 90
    max_retries_per_task: int = 3
    request_timeout_seconds: int = 30
    retry_backoff_seconds: float = 1.0
    store_raw_json: bool = False


_TYPES = {"strike_eq": DoubleType(), "strike_from": DoubleType(), "strike_to": DoubleType(),
          "page_limit": IntegerType(), "max_pages_per_task": IntegerType(), "max_concurrent_requests": IntegerType(),
          "requests_per_minute": IntegerType(), "max_retries_per_task": IntegerType(),
          "request_timeout_seconds": IntegerType(), "retry_backoff_seconds": DoubleType(),
          "store_raw_json": BooleanType()}

BACKFILL_CONFIG = StructType([StructField(name, _TYPES.get(name, StringType()), name != "endpoint")
                              for name in BackfillConfig.__dataclass_fields__])


def configs_frame(spark: SparkSession, configs: list[BackfillConfig]) -> DataFrame:
    """Configs as a DataFrame (``fields`` kept as comma text, so it persists
    with the job, as does ``sort``)."""
    rows = []
    for c in configs:
        d = asdict(c)
        d["fields"] = ",".join(d["fields"]) if d["fields"] else None
        for k in ("strike_eq", "strike_from", "strike_to", "retry_backoff_seconds"):
            d[k] = None if d[k] is None else float(d[k])
        rows.append(tuple(d[f.name] for f in BACKFILL_CONFIG.fields))
    return spark.createDataFrame(rows, BACKFILL_CONFIG)
