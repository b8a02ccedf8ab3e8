"""What the tests of the core share."""


def rows(df, *order):
    """All rows as tuples, sorted; NULLs first."""
    found = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(found, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()
