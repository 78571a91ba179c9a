"""Text helpers.

The reference database compares text case-blind and ignores trailing blanks
(collation ``1033, CI``). ``ci`` normalises a column the same way for equality
tests and join keys; values are kept as stored in the output.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ci(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.rtrim(c))


def ci_eq(col: Column | str, value: str) -> Column:
    return ci(col) == F.lit(value.lower().rstrip())


def ci_in(col: Column | str, values: list[str]) -> Column:
    return ci(col).isin([v.lower().rstrip() for v in values])


def hr_representative_of(role: Column) -> Column:
    """Department named by an ``HR_Representative_<dept>`` role: the text after the
    second underscore. With no second underscore ``locate`` returns 0, so the
    whole name comes back, as ``CHARINDEX`` does in the reference."""
    first = F.call_function("locate", F.lit("_"), role)
    second = F.call_function("locate", F.lit("_"), role, first + 1)
    return F.call_function("substring", role, second + 1, F.length(role))


def role_suffix_fixed(role: Column) -> Column:
    """The role trigger's fixed-offset suffix: ``SUBSTRING(r, 19, LEN(r) - 18)``."""
    return F.call_function("substring", role, F.lit(19), F.length(F.rtrim(role)) - 18)
