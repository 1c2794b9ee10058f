"""Registered queries: every operator applied to views of the given tables."""

from . import aggregations, catalogue, chains, checks, files, relations, scalars, spatial
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "aggregations", "catalogue", "chains", "checks", "files", "relations", "scalars", "spatial"]
