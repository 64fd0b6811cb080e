"""Processing windows and scoped replacement (late-data recomputation)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_for(processing_date, lookback_days: int) -> tuple[str, str]:
    """``[d - lookback, d]`` as ISO strings, derived from the parameter only."""
    d = processing_date if isinstance(processing_date, dt.date) else dt.date.fromisoformat(
        str(processing_date))
    return str(d - dt.timedelta(days=lookback_days)), str(d)


def date_bounds(df: DataFrame, col: str) -> DataFrame:
    """One-row DataFrame ``(min_d, max_d)`` of a date column (partial+final agg)."""
    return df.agg(F.min(col).alias("min_d"), F.max(col).alias("max_d"))


def full_window(df: DataFrame, col: str) -> tuple[str, str] | None:
    """Min/max of a date column as strings; ``None`` for an empty table.

    A bounded fetch: two scalars through the driver.
    """
    row = date_bounds(df, col).first()
    if row is None or row["min_d"] is None:
        return None
    return str(row["min_d"]), str(row["max_d"])


def date_ranges(dates, join_days: int = 0) -> list[tuple[str, str]]:
    """Dates as sorted ranges of days; ranges at most ``join_days`` apart become one."""
    out: list[list[dt.date]] = []
    for d in sorted({dt.date.fromisoformat(str(x)) for x in dates}):
        if out and (d - out[-1][1]).days <= join_days + 1:
            out[-1][1] = d
        else:
            out.append([d, d])
    return [(str(a), str(b)) for a, b in out]


def days_between(lo, hi) -> list[str]:
    a, b = dt.date.fromisoformat(str(lo)), dt.date.fromisoformat(str(hi))
    return [str(a + dt.timedelta(days=i)) for i in range((b - a).days + 1)]


def in_scope(col: str, lo, hi) -> Column:
    return F.col(col).between(F.lit(dt.date.fromisoformat(str(lo))),
                              F.lit(dt.date.fromisoformat(str(hi))))


def in_ranges(col: str, ranges) -> Column:
    """Whether a date lies in one of the ranges; in none of none."""
    out = F.lit(False)
    for lo, hi in ranges:
        out = in_scope(col, lo, hi) | out
    return out


def replace_scope(existing: DataFrame, new: DataFrame, predicate: Column) -> DataFrame:
    """Rows of ``existing`` outside ``predicate``, plus all of ``new``.

    The pure form of delete-and-replace by scope: an in-scope date that gets no
    new rows ends up empty (no ghost rows survive). NULL predicate values count
    as out of scope.
    """
    keep = existing.filter(~F.coalesce(predicate, F.lit(False)))
    return keep.unionByName(new.select(*existing.columns))
