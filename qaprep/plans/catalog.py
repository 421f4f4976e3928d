"""All registered queries; importing the modules fills the registry."""

from qaprep.plans import (  # noqa: F401
    catalog_molecules,
    catalog_similarity,
    catalog_sources,
    catalog_streams,
    catalog_tables,
    catalog_text,
    catalog_tokens,
)
from qaprep.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
