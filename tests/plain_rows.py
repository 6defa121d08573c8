"""What several test modules share; not in conftest, since the folders below have one of that name too."""

SMALL = "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as tuples, sorted by the given columns or by all."""
    found = [tuple(r) for r in df.collect()]
    keys = [df.columns.index(c) for c in order] or range(len(df.columns))
    return sorted(found, key=lambda r: tuple((r[k] is not None, r[k]) for k in keys))
