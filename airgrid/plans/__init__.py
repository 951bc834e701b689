"""End-to-end jobs and the registered queries."""

from airgrid.plans import page_queries, table_queries, text_queries  # noqa: F401
from airgrid.plans.registry import QUERIES, SQL  # noqa: F401
