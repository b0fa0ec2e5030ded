"""Comparing results of two engines."""

import math
from datetime import date, datetime, timezone


def plain(value):
    if isinstance(value, datetime):
        value = value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else round(value, 9)
    return value


def as_set(columns, rows):
    """Rows as a sorted list, columns by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def same_rows(df, relation):
    assert sorted(df.columns) == sorted(relation.columns)
    assert as_set(df.columns, df.collect()) == as_set(relation.columns, relation.fetchall())
