"""Registered queries; importing the package registers all of them."""

from carespan.queries import assessments, claims, costs, outreach, patients, sources  # noqa: F401
from carespan.queries.registry import QUERIES, oracle_sql  # noqa: F401
