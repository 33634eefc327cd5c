"""The registered SQL twins of the training-data queries give the same rows."""

import pytest

from oracle_check import digest, duck
from optlake.llm.oracles import ORACLES
from optlake.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(llm, name):
    sf = "/root/testdata/sf0.001"
    df = QUERIES[name](llm, sf)
    got = [tuple(r) for r in df.collect()]
    res = duck(sf).execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns) and got
    assert digest(df.columns, got) == digest(cols, res.fetchall())
