"""Named queries over the provided tables, each with an equivalent SQL text where SQL can say it."""

from loyalscope.catalogue import (  # noqa: F401  (importing a module registers its queries)
    cleaning_queries, distribution_queries, encoding_queries, fitted_queries, learning_queries, offer_queries,
    report_queries, segment_queries, source_queries, table_queries)
from loyalscope.catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
