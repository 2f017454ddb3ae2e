"""Shared by the test modules."""


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else sorted(tuple(r) for r in df.collect())
