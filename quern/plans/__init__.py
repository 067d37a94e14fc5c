"""Registered queries, each next to the SQL that must give the same rows."""

from quern.plans import aggregates, features, models, relational, scalars, sources, text  # noqa: F401
