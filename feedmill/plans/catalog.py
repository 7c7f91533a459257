"""All registered queries; importing the query modules fills the registry."""

from feedmill.plans import (  # noqa: F401
    dialog_queries,
    metric_queries,
    nlp_queries,
    source_queries,
    table_queries,
)
from feedmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
