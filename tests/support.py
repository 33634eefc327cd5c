"""Helpers shared by the tests."""

SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Collect (small test results) as sorted tuples of the given columns."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
