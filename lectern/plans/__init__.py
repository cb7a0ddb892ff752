"""Registered queries over the test tables."""

from lectern.plans import builds, queries, questions, textbooks
from lectern.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "builds", "queries", "questions", "textbooks"]
