"""All registered queries.  Importing this module fills the registry."""

from __future__ import annotations

from vireo.plans import catalog_aggregate, catalog_analytics, catalog_combiners, catalog_functions, catalog_relational, catalog_sources, catalog_streaming  # noqa: F401
from vireo.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
