"""Queries over the example tables, one or more for each operator, with the SQL that gives the same rows."""

from gridloom.queries.base import ORACLES, QUERIES
from gridloom.queries import fitting  # noqa: F401
from gridloom.queries import product  # noqa: F401,E402
from gridloom.queries import sources  # noqa: F401,E402
