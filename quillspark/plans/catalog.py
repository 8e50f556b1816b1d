"""All registered queries."""

from . import feature_queries, model_queries, profile_queries, text_queries, vector_queries  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
