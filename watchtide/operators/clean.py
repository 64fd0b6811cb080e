"""Cleaning operators: slices, guards, struct reshaping, latest-wins dedup."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchtide.schemas import SILVER_EVENTS, SILVER_TITLE, conform


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def ingest_day(df: DataFrame, day, col: str = "_ingest_ts") -> DataFrame:
    """Half-open slice ``[day, day + 1)`` on a timestamp column."""
    lo = dt.datetime.combine(_as_date(day), dt.time())
    c = F.col(col)
    return df.filter((c >= F.lit(lo)) & (c < F.lit(lo + dt.timedelta(days=1))))


def date_window(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Closed date window ``lo <= col <= hi`` (prunes date partitions)."""
    return df.filter(F.col(col).between(F.lit(_as_date(lo)), F.lit(_as_date(hi))))


def snapshot(df: DataFrame, snap: str, col: str = "_snapshot_date") -> DataFrame:
    """Rows of one snapshot (equality on the partition column)."""
    return df.filter(F.col(col) == F.lit(str(snap)))


def current(dim: DataFrame) -> DataFrame:
    """Current SCD2 versions."""
    return dim.filter(F.col("is_current"))


def require_not_null(df: DataFrame, cols) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def flatten(df: DataFrame, struct_col: str) -> DataFrame:
    """Lift the fields of a struct column to top-level columns (struct kept)."""
    fields = df.schema[struct_col].dataType.fieldNames()
    return df.withColumns({f: F.col(f"{struct_col}.{f}") for f in fields})


def nest(df: DataFrame, struct_col: str, cols) -> DataFrame:
    """Pack columns into one struct column and drop the originals."""
    return df.withColumn(struct_col, F.struct(*cols)).drop(*cols)


def dedup_latest(df: DataFrame, keys, order_cols, tie_cols=()) -> DataFrame:
    """Keep one row per key: the greatest ``order_cols`` (then ``tie_cols``).

    Rows are ranked with ``row_number`` over ``partitionBy(keys)``; the
    ``rn = 1`` filter lets Catalyst insert a partial WindowGroupLimit before the
    shuffle, so even a key holding a large share of rows is cut to one row per
    map task before it is exchanged. Order is descending with NULLs last.
    """
    order = [F.col(c).desc_nulls_last() for c in [*order_cols, *tie_cols]]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def accepted(events: DataFrame) -> DataFrame:
    """Rows silver takes: parsed without rescue, with a time and a title."""
    return require_not_null(events.filter(F.col("_rescued_data").isNull()), ["event_ts", "title_id"])


def clean_events(bronze: DataFrame, filter_first: bool = False) -> DataFrame:
    """Bronze heartbeats -> rows of the silver contract, the latest accepted copy per event.

    By default the latest copy of an event decides, and if it isn't accepted the
    event is left out; ``filter_first`` lets an older good copy stand instead.
    """
    rows = dedup_latest(accepted(bronze) if filter_first else bronze,
                        ["event_id"], ["_ingest_ts"], ["_source_file"])
    rows = flatten(accepted(rows), "device").withColumn("event_date", F.to_date("event_ts"))
    return conform(rows, SILVER_EVENTS)


def clean_titles(bronze: DataFrame, snap: str | None = None) -> DataFrame:
    """Bronze titles -> silver rows, the latest copy per snapshot and title.

    All dated snapshots, or one of them.
    """
    rows = snapshot(bronze, snap) if snap else bronze.filter(F.col("_snapshot_date") != "")
    rows = dedup_latest(rows, ["_snapshot_date", "title_id"], ["_ingest_ts"], ["_source_file"])
    return conform(require_not_null(rows, ["title_id"]), SILVER_TITLE)
