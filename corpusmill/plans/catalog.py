"""Imports every query module so the registry is complete."""

from corpusmill.plans import (  # noqa: F401
    feedback_queries,
    graph_queries,
    model_queries,
    prep_queries,
    search_queries,
    stream_queries,
    tag_queries,
)
from corpusmill.plans.registry import ORACLES, QUERIES  # noqa: F401
