"""Queries that exercise every operator on the given tables, each with plain SQL for the same result."""

from stationtide.suite.registry import ORACLES, QUERIES  # noqa: F401
from stationtide.suite import (  # noqa: F401  (importing registers the queries)
    catalogue_queries, check_queries, ingest_queries, product_queries, reading_queries, relation_queries,
    shaping_queries, tile_queries,
)
