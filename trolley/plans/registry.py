"""All registered queries: name -> (query, reference SQL or None)."""

from __future__ import annotations

from trolley.plans import evaluation_queries, feature_queries, log_queries, retrieval_queries, text_queries

REGISTRY = {
    **log_queries.QUERIES,
    **feature_queries.QUERIES,
    **retrieval_queries.QUERIES,
    **evaluation_queries.QUERIES,
    **text_queries.QUERIES,
}
