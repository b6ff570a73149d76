"""All registered queries: importing a module registers its queries."""

from checks import (  # noqa: F401
    analysis,
    facet,
    maintenance,
    pages,
    predicates,
    projections,
    relevance,
    scans,
)
from checks.base import ORACLE, QUERIES  # noqa: F401
