"""Shared by the library's tests."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Sorted list of tuples of the given (or all) columns."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r) for r in df.select(*cols).collect())
