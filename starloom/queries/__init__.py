"""Registered queries: each operator on the given tables, next to the SQL that must agree with it."""

from starloom.queries import arrivals, checks, cleaning, jobs, loads, music, profiles, staging  # noqa: F401
from starloom.queries.registry import ORACLE, QUERIES  # noqa: F401
