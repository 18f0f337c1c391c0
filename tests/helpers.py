"""Rows of frames in an order that tests can compare."""


def ordered(rows):
    """Natural order, nulls first."""
    return sorted(rows, key=lambda row: [(v is not None, 0 if v is None else v) for v in row])


def tuples(df, *columns):
    rows = df.select(*columns) if columns else df
    return ordered([tuple(r) for r in rows.collect()])
