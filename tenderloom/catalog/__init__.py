"""All registered queries."""

from . import (  # noqa: F401
    aggregate_queries, filter_queries, io_queries, join_queries, page_queries, tender_queries, text_queries,
)
from .registry import ORACLE, QUERIES  # noqa: F401
