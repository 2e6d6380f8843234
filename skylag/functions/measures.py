"""Ratios, cause groups and lenient numbers."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from skylag import fixed

# Spark's own cast also takes suffixes such as "12d"; a number in the feed must look like one.
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_ratio(numerator, denominator) -> Column:
    """numerator / denominator, and 0 where the denominator is null, 0 or negative."""
    num, den = _col(numerator), _col(denominator)
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def cause_column(code: str) -> str:
    return f"DLY_ERT_{code}_1"


def cause_rollup(groups: dict[str, tuple[str, ...]] = fixed.CAUSE_GROUPS) -> dict[str, Column]:
    """One summed column per cause group, for `withColumns`."""
    return {
        name: reduce(add, [F.col(cause_column(code)) for code in codes])
        for name, codes in groups.items()
    }


def residual_cause(total="total_delay", groups=tuple(fixed.CAUSE_GROUPS)) -> Column:
    """The part of the total that no cause group explains."""
    return _col(total) - reduce(add, [_col(g) for g in groups])


def lenient_int(value) -> Column:
    """Number-like text or number, cut to a whole number; anything else is null."""
    text = _col(value).cast("string")
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return number.try_cast("bigint")


def delay_minutes(*candidates) -> Column:
    """First candidate that is neither missing nor 0; the last one may be 0."""
    numbers = [lenient_int(c) for c in candidates]
    return F.coalesce(*[F.nullif(n, F.lit(0).cast("bigint")) for n in numbers[:-1]], numbers[-1])
