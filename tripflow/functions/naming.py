"""Turning named SQL text into columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRIPS = {"trips": "count(1)"}


def named(**texts: str) -> list[Column]:
    """One column per keyword, parsed from its text."""
    return [F.expr(f"{text} AS `{name}`") for name, text in texts.items()]
