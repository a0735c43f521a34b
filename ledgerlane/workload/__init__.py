"""The registered queries: every operator run over the test tables, with an SQL twin."""

from . import (  # noqa: F401  (each module registers its queries)
    portfolio_queries,
    ingest_queries,
    masking_queries,
    quality_queries,
    relational_queries,
    scalar_queries,
    streaming_queries,
    table_queries,
    trip_queries,
)
from .registry import QUERIES, SQL  # noqa: F401
