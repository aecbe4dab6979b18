"""Queries over the star-schema tables, each with its SQL counterpart."""

from ratewell.catalog import calculations, enrichment, files, projections, rollups
from ratewell.catalog.registry import QUERIES, run

__all__ = ["QUERIES", "calculations", "enrichment", "files", "projections", "rollups", "run"]
