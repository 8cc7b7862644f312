"""All registered queries. Importing the modules registers them."""

from __future__ import annotations

from proofmark.plans import base, datasets_and_order, joined_and_aggregated, scoring, serving, streams, tables_and_filters, written  # noqa: F401

QUERIES = base.QUERIES
ORACLES = base.ORACLES
