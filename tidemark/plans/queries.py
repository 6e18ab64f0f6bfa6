"""Queries of the analytics operators by name, with an equal SQL text for each that SQL can express."""

from __future__ import annotations

from tidemark.plans import models, relational, similarity, streams, text, topics

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _m in (relational, text, topics, similarity, streams, models):
    QUERIES |= _m.QUERIES
    ORACLES |= _m.ORACLES
