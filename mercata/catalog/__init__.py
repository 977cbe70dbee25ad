"""The operators and queries bound to the shared test tables, each with its SQL twin."""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import cleaning_queries, column_queries, feature_queries, kpi_queries, model_queries  # noqa: F401
from . import relational_queries, source_queries, stream_queries  # noqa: F401
