"""Every registered query against its DuckDB oracle (or, without one, that
it runs) on the smallest driver scale."""

import pytest

from oracle_check import compare
from support import SMALL

import __spark_entry__ as entry_mod

from optlake.plans.registry import ORACLES, QUERIES, load_all

load_all()
NAMES = sorted(QUERIES)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["underlying_symbol", "tradetime", "exp_date", "spot", "target", "contract", "strike", "midpoint"]


def test_every_query_has_docstring_and_most_have_oracles():
    qs, os_ = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(QUERIES) <= set(qs) and set(ORACLES) <= set(os_) <= set(qs)
    assert len(ORACLES) >= len(QUERIES) - 2


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    rec = compare(spark, SMALL, [name], verbose=False)[name]
    assert "error" not in rec, rec
    if rec["oracle_rows"] is not None:
        assert rec["rows"] == rec["oracle_rows"], rec
        assert rec["cols_match"] and rec["hash_match"], rec
