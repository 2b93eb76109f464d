"""All registered queries and their SQL, collected from the query modules of this package."""

from __future__ import annotations

from . import q_calendar, q_documents, q_ledger, q_limits, q_members, q_qualification, q_scalars, q_series, q_sets, q_sources, q_streams  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401

FLAGSHIP = "ag_5_market_breadth"
