"""Registered queries and the SQL each one is checked against."""

from tallyhouse.checks import operators, reports  # noqa: F401
from tallyhouse.checks.registry import ORACLE, QUERIES  # noqa: F401
