"""Insert-only merge (cross-batch dedup) without a transactional table format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchtide.operators.scope import full_window


def insert_new(target: DataFrame, source: DataFrame, keys, prune_col: str | None = None,
               bounds: tuple[str, str] | None = None) -> DataFrame:
    """Source rows whose key is absent from ``target`` — the rows to append.

    Matching target rows are left untouched and nothing is rewritten. A NULL
    key never matches, so such rows are inserted (as in MERGE). With
    ``prune_col`` (a partition column that is part of ``keys``) the target is
    first cut to ``bounds`` — by default the source's ``[min, max]`` of that
    column; pass cheaper bounds (e.g. from the raw batch) to avoid computing
    the source twice — so only those partitions are scanned.
    """
    keys = list(keys)
    t = target
    if prune_col is not None:
        if bounds is None:
            bounds = full_window(source, prune_col)
        if bounds is None:
            return source.limit(0)
        t = t.filter(F.col(prune_col).between(F.lit(bounds[0]).cast("date"),
                                              F.lit(bounds[1]).cast("date")))
    return source.join(t.select(*keys), keys, "left_anti")
