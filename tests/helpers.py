"""Helpers shared by the tests."""


def rows(df, *cols):
    """Collected rows as plain tuples, sorted, for the given columns."""
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
