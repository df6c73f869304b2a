"""Registered queries over the test tables, each with the SQL that checks it."""

from leadspark.catalog import collecting, reporting, scoring, state, streams  # noqa: F401
from leadspark.catalog.registry import QUERIES, SQL  # noqa: F401
