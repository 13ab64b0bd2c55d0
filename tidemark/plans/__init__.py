"""Registered queries."""

from tidemark.plans import aggregates, alignment, audits, contracts, io, kernels, scalars, sequences  # noqa: F401
from tidemark.plans.registry import COVERS, ORACLE_SQL, QUERIES

__all__ = ["COVERS", "ORACLE_SQL", "QUERIES"]
