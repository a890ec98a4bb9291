"""Helpers of the tests outside the corpus operators (not in ``conftest``: two files of that name cannot both be imported)."""


def rows(df, *cols):
    """Sorted list of tuples (NULLs first) for order-insensitive asserts."""
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, str(v)) for v in t))
