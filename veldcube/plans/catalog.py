"""Every operator as a named query over a data folder, with its SQL where SQL can state it."""

from veldcube.plans import (  # noqa: F401
    catalog_compare,
    catalog_quality,
    catalog_refresh,
    catalog_sources,
    catalog_spatial,
    catalog_tables,
    catalog_views,
)
from veldcube.plans import catalog_masked  # noqa: F401  (builds on the others)
from veldcube.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
