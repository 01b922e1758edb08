"""Registered queries and the SQL that says what each must return."""

from __future__ import annotations

from plenum.plans import comparisons, decisions, evaluations, orders, packet_queries, rasters, texts, votes

_GROUPS = (decisions, votes, evaluations, texts, orders, comparisons, packet_queries, rasters)

QUERIES: dict = {}
ORACLES: dict = {}
for _group in _GROUPS:
    QUERIES.update(_group.QUERIES)
    ORACLES.update(_group.ORACLES)
