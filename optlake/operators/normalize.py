"""Vendor records (VARIANT) -> fixed-schema rows per endpoint.

Each output column is a list of candidate paths in precedence order; the
first path that is *present* in the record wins, even when its value is a
JSON null (presence, not non-nullness, decides: a quote's ``"bid": null``
overrides a top-level bid).  Records of the legacy shape
``{id, type, attributes:{...}}`` take their fields from ``attributes`` only.

Precedence for the chain snapshot (end-of-day) endpoint, lowest to highest:
the record, then ``details``, then ``greeks``; then the named sources:
contract/type/expiry/strike from ``details``, underlying from
``underlying_asset.ticker``, open/high/low/close/volume and the trade time
(epoch ns) from ``day``, bid/ask/midpoint and their time (epoch ns) from
``last_quote``, volatility from ``implied_volatility``.

Date columns are coerced row by row (text in any accepted form, or epoch
numbers); unparsable values become NULL.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from optlake.functions.dates import coerce_timestamp, epoch_ms_to_ts, long_ns_to_ts
from optlake.functions.keys import first_non_empty, row_hash
from optlake.schemas import OPTION_EOD

_NUMERIC = r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|DOUBLE|FLOAT)"


def _v(v: Column, t: str) -> Column:
    return F.try_variant_get(v, "$", t)


def _when_ts(v: Column, numeric_unit: str = "ns") -> Column:
    """Timestamp from text (any accepted form) or from an epoch number."""
    num = long_ns_to_ts(_v(v, "bigint")) if numeric_unit == "ns" else epoch_ms_to_ts(_v(v, "bigint"))
    return F.when(F.schema_of_variant(v).rlike(_NUMERIC), num).otherwise(coerce_timestamp(_v(v, "string")))


_CONV = {
    "boolean": lambda v: _v(v, "boolean"),
    "string": lambda v: _v(v, "string"),
    "double": lambda v: _v(v, "double"),
    "long": lambda v: _v(v, "bigint"),
    "ns": lambda v: long_ns_to_ts(_v(v, "bigint")),
    "ms": lambda v: epoch_ms_to_ts(_v(v, "bigint")),
    "ts": lambda v: _when_ts(v, "ns"),
    "date": lambda v: F.to_date(_when_ts(v, "ns")),
}
_TYPES = {"boolean": "boolean", "string": "string", "double": "double", "ns": "timestamp", "ms": "timestamp", "ts": "timestamp",
          "date": "date", "long": "bigint"}


_REC, _VALUES = "__m_rec", "__m_values"


def _obj(name: str) -> Column:
    return F.col(f"__m_{name}")


class Keys:
    """Keys read from each (sub-)object and values settled from them, collected
    while column expressions are built: each object is cast once to a struct of
    just those keys, each value is settled once before it is converted."""

    def __init__(self) -> None:
        self.used: dict[str, list[str]] = {}
        self.settled: list[tuple[Column, Column]] = []

    def field(self, obj: str, key: str) -> Column:
        keys = self.used.setdefault(obj, [])
        if key not in keys:
            keys.append(key)
        return _obj(obj).getField(key)

    def object(self, obj: str) -> Column:
        self.used.setdefault(obj, [])
        return _obj(obj)

    def settle(self, value: Column, legacy: Column | None = None) -> Column:
        """A value, another one in legacy records."""
        name = f"v{len(self.settled)}"
        self.settled.append((value.alias(name), value.alias(name) if legacy is None else legacy.alias(name)))
        return F.col(_VALUES).getField(name)


def _ddl(fields: list[str]) -> str:
    return "struct<" + ",".join(fields or ["`__none`:variant"]) + ">"


def _member(key: str, t: str) -> str:
    return f"`{key.replace('`', '``')}`:{t}"


def with_objects(records: DataFrame, record: str, objects: dict[str, str], keys: Keys) -> DataFrame:
    """Add the (sub-)objects the columns read, the record cast once to a struct
    of variants holding only the keys read, and the values settled from them.

    A JSON null member stays a (non-SQL-NULL) variant null in the struct and
    an absent key is SQL NULL, so presence is a field test; a member that is
    not an object gives a NULL struct.  Later column picks read struct fields
    instead of walking the record again for every path.
    """
    own = keys.used.get("rec", [])
    subs = {name: path[2:] for name, path in objects.items() if name != "rec" and name in keys.used}
    members = {name: _ddl([_member(k, "variant") for k in keys.used[name]]) for name in subs}
    # a member that is read as a value as well is cast apart: a struct has each name once
    inner = [name for name, key in subs.items() if key not in own]
    whole = _ddl([_member(k, "variant") for k in own] + [_member(subs[name], members[name]) for name in inner])
    staged = records.select("*", F.try_variant_get(F.col(record), "$", whole).alias(_REC))
    cols = [F.col(_REC).getField(subs[name]) if name in inner else F.try_variant_get(F.col(record), objects[name], members[name])
            for name in subs]
    staged = staged.select("*", *[c.alias(f"__m_{name}") for name, c in zip(subs, cols)])
    if not keys.settled:
        return staged
    values, old = (F.struct(*side) for side in zip(*keys.settled))
    if "attributes" in subs:
        # one column of another stage, read by every conversion: a generated method each for casting, settling and converting
        values = F.when(_obj("attributes").isNotNull(), old).otherwise(values)
    return staged.select("*", values.alias(_VALUES))


def drop_objects(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__m_")])


def pick(keys: Keys, candidates: list[tuple[str, str, str]], out_type: str, legacy: tuple[str, str, str] | None = None) -> Column:
    """First present candidate wins; ``candidates`` = [(object, key, converter)].

    Neighbours of one converter are settled first and converted once: a
    conversion for each makes the generated method longer than the JVM
    compiles, and every record then runs through its interpreter.  Legacy
    records take the candidate ``legacy`` only, if given; its converter is
    that of the last candidate."""
    runs = [list(run) for _, run in groupby(candidates, key=lambda c: c[2])]
    if legacy is not None and legacy[2] != candidates[-1][2]:
        raise ValueError(f"{legacy} needs the converter of {candidates[-1]}")
    expr = None
    for run in reversed(runs):
        old = None
        if legacy is not None:
            old = keys.field(*legacy[:2]) if expr is None else F.lit(None).cast("variant")
        v = keys.settle(F.coalesce(*[keys.field(obj, key) for obj, key, _ in run]), old)
        value = _CONV[run[0][2]](v).cast(out_type)
        expr = value if expr is None else F.when(v.isNotNull(), value).otherwise(expr)
    return expr


def _spec_type(conv: str) -> str:
    return _TYPES[conv]


# ------------------------------------------------------------------ endpoints

def _eod_kind(name: str) -> str:
    field = next(f for f in OPTION_EOD.fields if f.name == name)
    t = field.dataType.simpleString()
    return {"string": "string", "double": "double", "timestamp": "ts", "date": "date", "int": "long"}[t]


EOD_COLUMNS = [f.name for f in OPTION_EOD.fields if f.name not in ("fetched_at", "raw_json")]

# Named sources of chain snapshot fields (column -> object, key, converter).
EOD_NAMED_SOURCES = {
    "contract": ("details", "ticker", "string"),
    "option_type": ("details", "contract_type", "string"),
    "exp_date": ("details", "expiration_date", "date"),
    "strike": ("details", "strike_price", "double"),
    "underlying_symbol": ("underlying_asset", "ticker", "string"),
    "open": ("day", "open", "double"),
    "high": ("day", "high", "double"),
    "low": ("day", "low", "double"),
    "last": ("day", "close", "double"),
    "volume": ("day", "volume", "double"),
    "tradetime": ("day", "last_updated", "ns"),
    "bid": ("last_quote", "bid", "double"),
    "ask": ("last_quote", "ask", "double"),
    "midpoint": ("last_quote", "midpoint", "double"),
    "bid_date": ("last_quote", "last_updated", "ns"),
    "ask_date": ("last_quote", "last_updated", "ns"),
    "volatility": ("rec", "implied_volatility", "double"),
}
EOD_OBJECTS = {"rec": "$", "details": "$.details", "greeks": "$.greeks", "day": "$.day",
               "last_quote": "$.last_quote", "underlying_asset": "$.underlying_asset", "attributes": "$.attributes"}

# Flat contract record aliases (column -> vendor name), used only
# when the column itself is absent.
CONTRACT_ALIASES = {
    "contract": "ticker",
    "underlying_symbol": "underlying_ticker",
    "option_type": "contract_type",
    "exp_date": "expiration_date",
    "strike": "strike_price",
}

# Bar record fields (column -> vendor name); the vendor name wins.
BAR_FIELDS = {"open": "o", "high": "h", "low": "l", "last": "c", "volume": "v", "vwap": "vw"}


def _is_legacy(keys: Keys) -> Column:
    keys.object("attributes")
    return keys.settle(F.lit(False), F.lit(True))


def _legacy_ids(keys: Keys, legacy: Column) -> list[Column]:
    return [F.when(legacy, pick(keys, [("rec", "id", "string")], "string")).alias("response_id"),
            F.when(legacy, pick(keys, [("rec", "type", "string")], "string")).alias("response_type")]


def _legacy_option_type(keys: Keys) -> Column:
    return first_non_empty(pick(keys, [("attributes", "option_type", "string")], "string"),
                           pick(keys, [("attributes", "type", "string")], "string"))


def _either(keys: Keys, legacy: Column, name: str, candidates: list[tuple[str, str, str]], kind: str, out_type: str) -> Column:
    """The column from ``attributes`` in legacy records, else from its candidates."""
    if name == "option_type":
        return F.when(legacy, _legacy_option_type(keys)).otherwise(pick(keys, candidates, out_type))
    return pick(keys, candidates, out_type, ("attributes", name, kind))


def normalize_eod(records: DataFrame, record: str = "record", keep: list[str] = (),
                  columns: list[str] | None = None) -> DataFrame:
    """N2 (+N4 legacy, N7 dates, N9 event date): chain snapshot rows.

    ``columns`` limits the output to the columns a caller reads: each column
    is a sizeable expression, and building only the needed ones keeps query
    planning short and the per-object structs narrow.
    """
    rec = F.col(record)
    keys = Keys()
    legacy = _is_legacy(keys)
    wanted = EOD_COLUMNS if columns is None else [c for c in EOD_COLUMNS if c in columns]
    cols = []
    for name in wanted:
        kind = _eod_kind(name)
        out_type = "int" if name == "dte" else _spec_type(kind)
        cands = [("greeks", name, kind), ("details", name, kind), ("rec", name, kind)]
        if name in EOD_NAMED_SOURCES:
            cands = [EOD_NAMED_SOURCES[name]] + cands
        cols.append(_either(keys, legacy, name, cands, kind, out_type).alias(name))
    ids = _legacy_ids(keys, legacy)
    extra = [F.to_json(rec).alias("raw_json")] if columns is None or "raw_json" in columns else []
    staged = with_objects(records, record, EOD_OBJECTS, keys)
    out = staged.select(*keep, *ids, *cols, *extra)
    return out.withColumn("event_date", F.to_date("tradetime")) if "tradetime" in wanted else out


def normalize_contracts(records: DataFrame, record: str = "record", keep: list[str] = ()) -> DataFrame:
    """N1 (+N4): flat contract records; vendor names fill absent columns."""
    rec = F.col(record)
    keys = Keys()
    legacy = _is_legacy(keys)
    spec = {"contract": "string", "underlying_symbol": "string", "exp_date": "date", "expiration_type": "string",
            "option_type": "string", "strike": "double", "exchange": "string", "currency": "string"}
    cols = []
    for name, kind in spec.items():
        out_type = _spec_type(kind)
        cands = [("rec", name, kind)]
        if name in CONTRACT_ALIASES:
            cands.append(("rec", CONTRACT_ALIASES[name], kind))
        cols.append(_either(keys, legacy, name, cands, kind, out_type).alias(name))
    ids = _legacy_ids(keys, legacy)
    staged = with_objects(records, record, {"rec": "$", "attributes": "$.attributes"}, keys)
    return staged.select(*keep, *ids, *cols, F.to_json(rec).alias("raw_json"))


def normalize_bars(records: DataFrame, record: str = "record", page_ticker: str = "page_ticker",
                   keep: list[str] = (), raw: bool = False) -> DataFrame:
    """N3 (+S2): bar records; the page ticker fills a record without one.
    ``raw`` adds the whole record as ``raw_json``, so unknown vendor keys stay."""
    keys = Keys()
    contract = F.coalesce(
        pick(keys, [("rec", "contract", "string"), ("rec", "ticker", "string")], "string"),
        F.col(page_ticker) if page_ticker in records.columns else F.lit(None).cast("string"))
    cols = [contract.alias("contract"),
            pick(keys, [("rec", "t", "ms"), ("rec", "tradetime", "ts")], "timestamp").alias("tradetime")]
    for name, short in BAR_FIELDS.items():
        cols.append(pick(keys, [("rec", short, "double"), ("rec", name, "double")], "double").alias(name))
    staged = with_objects(records, record, {"rec": "$"}, keys)
    out = staged.select(*keep, *cols, *([F.to_json(F.col(record)).alias("raw_json")] if raw else []))
    return out.withColumn("event_date", F.to_date("tradetime"))


def normalize_symbols(records: DataFrame, record: str = "record", keep: list[str] = (), raw: bool = False) -> DataFrame:
    """A bare string is the symbol; an object gives its fields (the
    symbol from ``underlying_symbol``, else ``ticker``).  ``raw`` adds the whole
    record as ``raw_json``, so unknown vendor keys stay."""
    rec = F.col(record)
    keys = Keys()
    is_obj = keys.object("rec").isNotNull()
    symbol = F.when(is_obj, pick(keys, [("rec", "underlying_symbol", "string"), ("rec", "ticker", "string")], "string")) \
        .otherwise(F.try_variant_get(rec, "$", "string"))
    cols = [symbol.alias("underlying_symbol"),
            F.when(is_obj, pick(keys, [("rec", "market", "string")], "string")).alias("market"),
            F.when(is_obj, pick(keys, [("rec", "active", "boolean")], "boolean")).alias("active"),
            F.when(is_obj, pick(keys, [("rec", "name", "string")], "string")).alias("name"),
            *([F.to_json(rec).alias("raw_json")] if raw else [])]
    staged = with_objects(records, record, {"rec": "$"}, keys)
    return staged.select(*keep, *cols)


def normalize_generic(records: DataFrame, record: str = "record", keep: list[str] = ()) -> DataFrame:
    """N4/N6 for other endpoints: legacy ids, a scalar record as ``value``,
    the record as JSON, and a fallback row key (SHA-1 of the record)."""
    rec = F.col(record)
    keys = Keys()
    is_obj = keys.object("rec").isNotNull()
    ids = _legacy_ids(keys, _is_legacy(keys))
    staged = with_objects(records, record, {"rec": "$", "attributes": "$.attributes"}, keys)
    return staged.select(
        *keep, *ids,
        F.when(~is_obj, F.try_variant_get(rec, "$", "string")).alias("value"),
        F.to_json(rec).alias("record_json"),
        F.sha1(F.to_json(rec)).alias("row_key"))


NORMALIZERS = {
    "eod": normalize_eod,
    "contracts": normalize_contracts,
    "bars": normalize_bars,
    "underlying-symbols": normalize_symbols,
}

# Typed composite keys per endpoint (fallback: row hash)
ROW_KEYS = {
    "eod": ["contract", "tradetime"],
    "contracts": ["contract"],
    "bars": ["contract", "tradetime"],
    "underlying-symbols": ["underlying_symbol"],
}


def normalize(records: DataFrame, endpoint: str, keep: list[str] = ()) -> DataFrame:
    fn = NORMALIZERS.get(endpoint)
    if fn is None:
        return normalize_generic(records, keep=list(keep))
    return fn(records, keep=list(keep))


def row_key(df: DataFrame, endpoint: str) -> Column:
    """Key of a normalised row: the endpoint key, else a hash of the row."""
    key = ROW_KEYS.get(endpoint)
    if key and all(k in df.columns for k in key):
        return F.struct(*[F.col(k) for k in key])
    return F.struct(row_hash([c for c in df.columns]).alias("row_hash"))
