"""Every registered query: batch catalogue plus streaming queries."""

from __future__ import annotations

from flowlab.plans.catalogue import BATCH_QUERIES
from flowlab.plans.streams import STREAM_QUERIES

ALL_QUERIES = {**BATCH_QUERIES, **STREAM_QUERIES}
