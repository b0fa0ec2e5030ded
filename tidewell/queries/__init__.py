"""Registered queries: each operator applied to whole given tables, with SQL that says the same."""

from tidewell.queries import cleansing, documents, landing, layout, ledger, merging, requests

GROUPS = (cleansing, requests, merging, landing, documents, layout, ledger)


def queries() -> dict:
    return {name: fn for group in GROUPS for name, (fn, _) in group.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for group in GROUPS for name, (_, sql) in group.QUERIES.items()}
