"""Importing this module registers every query."""

from . import (chain_queries, check_queries, extract_queries, feature_queries, histories,  # noqa: F401
               join_queries, stored_queries, upkeep_queries, value_queries)
from .registry import QUERIES, SQL  # noqa: F401
