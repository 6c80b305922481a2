"""All queries and their SQL."""

from __future__ import annotations

from . import news, reports, series, similarity

_GROUPS = (series, news, similarity, reports)


def queries():
    return {name: query for group in _GROUPS for name, query in group.QUERIES.items()}


def oracles():
    return {name: sql for group in _GROUPS for name, sql in group.ORACLES.items()}
