"""Compositions of the operators: ingest runs and the registered queries."""


def all_queries():
    from . import queries_files, queries_runs, queries_tables, queries_values  # noqa: F401 - they register themselves
    from .registry import QUERIES

    return dict(QUERIES)


def all_sql():
    all_queries()
    from .registry import SQL

    return dict(SQL)
