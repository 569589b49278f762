"""Registered queries of the engine and their oracle SQL."""

from __future__ import annotations

from .plans import audit_queries, envelope_queries, market_queries, stream_queries, tape_queries

QUERIES = {**tape_queries.QUERIES, **market_queries.QUERIES, **audit_queries.QUERIES, **envelope_queries.QUERIES, **stream_queries.QUERIES}
ORACLES = {**tape_queries.ORACLES, **market_queries.ORACLES, **audit_queries.ORACLES, **envelope_queries.ORACLES, **stream_queries.ORACLES}
