"""All registered queries on the driver tables and their DuckDB oracles."""

from __future__ import annotations

from playmart.plans import q_geo, q_io, q_revenue, q_song, q_text, q_users

_MODULES = (q_song, q_text, q_revenue, q_users, q_geo, q_io)


def _load():
    queries, oracle = {}, {}
    for mod in _MODULES:
        queries.update(mod.QUERIES)
        oracle.update(mod.ORACLE)
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
