"""Sums and means of doubles that do not depend on the order of the rows.

A plain sum of doubles changes with the shuffle order and, past 1e13, loses
whole cents. Summing DECIMALs is exact but builds one BigDecimal per value
(about ten times slower than adding doubles). Here every value below ``SMALL``
becomes a count of 1e-8 units of at most 42 bits, which is added as two plain
BIGINT sums, of the upper and of the lower 21 bits. Larger values are added as
DECIMALs behind a filter. All sums combine map-side. A group has room for 4e12
rows of the smaller values, whatever they are, so that no BIGINT wraps, and the
DECIMALs for 1e30 of the larger; a sum past that fails in ANSI mode.

No value is left out: NaN, the infinities and magnitudes of 1e18 and more, for
which no exact sum is kept, turn the group's result into that of a plain sum.

Every helper takes and returns SQL text for ``F.expr`` and ``selectExpr``: one
parsed text replaces dozens of driver round trips for nested Column objects.
"""

from __future__ import annotations

#: Units of a value below this fit in twice ``LIMB`` bits.
SMALL = "4.0E4D"
LIMB = 21


def _let(parts: dict[str, str], body: str) -> str:
    """``body`` over a struct ``s`` of the aggregates ``parts``: each stands in the text
    once, however often the body uses it."""
    named = ", ".join(f"{text} AS {name}" for name, text in parts.items())
    return f"transform(array(struct({named})), s -> {body})[0]"


def _parts(value: str) -> dict[str, str]:
    """The aggregates an exact sum is made of."""
    units = f"CASE WHEN abs({value}) < {SMALL} THEN CAST(rint(({value}) * 1.0E8D) AS BIGINT) END"
    # The filters keep these sums out of every row they do not concern.
    return {
        "high": f"sum(shiftright({units}, {LIMB}))",
        "low": f"sum(({units}) & {(1 << LIMB) - 1}L)",
        "large": f"sum(try_cast({value} AS DECIMAL(26,8))) "
        f"FILTER (WHERE abs({value}) >= {SMALL} AND abs({value}) < 1.0E18D)",
    }


_UNITS = f"CAST(s.high AS DECIMAL(20,0)) * CAST({1 << LIMB} AS DECIMAL(7,0)) + CAST(s.low AS DECIMAL(20,0))"
_FEW = f"CAST(({_UNITS}) * CAST('0.00000001' AS DECIMAL(8,8)) AS DECIMAL(37,8))"
_MANY = "CAST(s.large AS DECIMAL(37,8))"
#: The sum from its parts, null if there was no value.
_EXACT = f"CAST(coalesce({_FEW} + {_MANY}, {_FEW}, {_MANY}) AS DECIMAL(38,8))"


def exact_sum(value: str) -> str:
    """DECIMAL(38,8) sum of the DOUBLEs below 1e18; null for a group without any."""
    return _let(_parts(value), _EXACT)


def _wild(value: str) -> str:
    """Sum of the values without an exact one; null if there is none. NaN compares as greatest."""
    return f"sum({value}) FILTER (WHERE abs({value}) >= 1.0E18D)"


def _joined(exact: str, wild: str) -> str:
    return f"coalesce({wild} + coalesce(CAST({exact} AS DOUBLE), 0.0D), CAST({exact} AS DOUBLE))"


def exact_total(value: str) -> str:
    """The sum as DOUBLE; that of a plain sum if a value has no exact one."""
    return _let(_parts(value) | {"wild": _wild(value)}, _joined(_EXACT, "s.wild"))


def exact_mean(value: str) -> str:
    """Mean of the present values as DOUBLE; null for a group without values."""
    return f"try_divide({exact_total(value)}, CAST(count({value}) AS DOUBLE))"


def round_half_up(value: str, places: int = 2) -> str:
    """Round through DECIMAL, so 1.005 gives 1.01 rather than its binary neighbour.

    Magnitudes of 1e18 and more have no places to round and stay as they are.
    """
    decimal = f"CAST(round(try_cast(s.x AS DECIMAL(28,8)), {places}) AS DOUBLE)"
    return _let({"x": value}, f"CASE WHEN abs(s.x) < 1.0E18D THEN {decimal} ELSE s.x END")


def rounded_sum(value: str, places: int = 2) -> str:
    parts = _parts(value) | {"wild": _wild(value)}
    return _let(parts, _rounded(_EXACT, "s.wild", places))


def _rounded(exact: str, wild: str, places: int) -> str:
    finite = f"CAST(round({exact}, {places}) AS DOUBLE)"
    return f"CASE WHEN {wild} IS NULL THEN {finite} ELSE {_joined(exact, wild)} END"


def rounded_mean(value: str, places: int = 2) -> str:
    return round_half_up(exact_mean(value), places)


def percent(part: str, whole: str) -> str:
    """``part`` in percent of ``whole`` to two places; null for a whole of zero."""
    return round_half_up(f"try_divide(CAST({part} AS DOUBLE) * 100.0D, CAST({whole} AS DOUBLE))")


def percent_of_rows(condition: str) -> str:
    """Share of the group's rows for which ``condition`` is TRUE, in percent."""
    return percent(f"count_if({condition})", "count(1)")


# Sums that are finished later ---------------------------------------------------


def partial_sums(value: str, name: str) -> dict[str, str]:
    """Columns from which ``Rolled`` finishes the sum and mean of ``value``."""
    return {
        f"{name}_sum": exact_sum(value),
        f"{name}_wild": _wild(value),
        f"{name}_n": f"count({value})",
    }


class Rows:
    """Measures of groups of single rows."""

    trips = "count(1)"
    rounded_sum = staticmethod(rounded_sum)
    rounded_mean = staticmethod(rounded_mean)
    percent_of_rows = staticmethod(percent_of_rows)


class Rolled:
    """The same measures of groups of rollup rows with ``trips`` and partial sums.

    Partial sums are exact, so the results are those of ``Rows``.
    """

    trips = "sum(trips)"

    @staticmethod
    def rounded_sum(name: str, places: int = 2) -> str:
        parts = {"exact": f"sum({name}_sum)", "wild": f"sum({name}_wild)"}
        return _let(parts, _rounded("s.exact", "s.wild", places))

    @staticmethod
    def rounded_mean(name: str, places: int = 2) -> str:
        parts = {"exact": f"sum({name}_sum)", "wild": f"sum({name}_wild)"}
        total = _let(parts, _joined("s.exact", "s.wild"))
        return round_half_up(f"try_divide({total}, CAST(sum({name}_n) AS DOUBLE))", places)

    @staticmethod
    def percent_of_rows(condition: str) -> str:
        return percent(f"sum(CASE WHEN {condition} THEN trips ELSE 0L END)", "sum(trips)")
