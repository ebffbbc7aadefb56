"""Code tables and label expressions as SQL text."""

from __future__ import annotations

from collections.abc import Mapping

# Payment codes with a label of their own.
PAYMENT_LABELS: dict[int, str] = {1: "Card", 2: "Cash", 3: "NoCharge", 4: "Dispute"}
OTHER_PAYMENT = "Other"

# Pickup zones of the three airports.
AIRPORTS: dict[int, str] = {132: "JFK", 138: "LGA", 1: "EWR"}

# Labels of the payment share columns.
SHARE_LABELS: dict[str, str] = {"pct_card": "Card", "pct_cash": "Cash", "pct_other": "Other"}

UNKNOWN_PLACE = "Unknown"
UNKNOWN_RATE_CODE = 99


def literal(value: int | str) -> str:
    if isinstance(value, int):
        return str(value)
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def lookup(code: str, table: Mapping) -> str:
    """Label of ``code`` in a small literal table, null where absent."""
    pairs = " ".join(f"WHEN {literal(key)} THEN {literal(label)}" for key, label in table.items())
    return f"CASE {code} {pairs} END"


def payment_label(code: str) -> str:
    """Label of a payment code; unknown and null codes are both 'Other'."""
    return f"coalesce({lookup(code, PAYMENT_LABELS)}, {literal(OTHER_PAYMENT)})"


def known_place(name: str) -> str:
    return f"coalesce({name}, {literal(UNKNOWN_PLACE)})"
