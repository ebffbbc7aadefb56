"""Wall-clock time helpers that never pass through the session time zone.

Everything stays TIMESTAMP_NTZ; ``date_trunc``, ``date_format`` and
``timestampdiff`` are avoided because they convert to an instant first and so
bend around daylight-saving changes when a session is not pinned to UTC.
Every helper takes and returns SQL text.
"""

from __future__ import annotations

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def parse_wall_clock(text: str) -> str:
    """TIMESTAMP_NTZ from the first 19 characters; bad or short text gives null."""
    parsed = f"try_cast(substring({text}, 1, 19) AS TIMESTAMP_NTZ)"
    return f"CASE WHEN length({text}) >= 19 THEN {parsed} END"


def format_wall_clock(moment: str) -> str:
    """Text ``yyyy-MM-dd HH:mm:ss.SSSSSS`` with all six fraction digits."""
    text = f"CAST({moment} AS STRING)"
    return f"concat(substring({text}, 1, 19), '.', rpad(substring({text}, 21, 6), 6, '0'))"


def wall_seconds(moment: str) -> str:
    """Whole seconds since 1970-01-01 on the wall clock, as BIGINT."""
    return f"CAST(({moment} - {EPOCH}) AS BIGINT)"


def from_wall_seconds(seconds: str) -> str:
    return f"timestampadd(SECOND, {seconds}, {EPOCH})"


def minutes_between(start: str, end: str) -> str:
    """Minutes from ``start`` to ``end``, both cut to whole seconds; may be negative."""
    return f"CAST({wall_seconds(end)} - {wall_seconds(start)} AS DOUBLE) / 60.0D"


def hour_text(text: str) -> str:
    """The two-character hour of a text time, as it stands."""
    return f"substring({text}, 12, 2)"
