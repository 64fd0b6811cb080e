"""Column expressions shared by the operators (all built-in, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from watchtide.config import ATTR_HASH_SEP, GENRE_SEP, TITLE_ATTRS


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds of a timestamp, floored (cast to BIGINT).

    TIMESTAMP_NTZ cannot be cast to BIGINT, so it is read in the session zone first.
    """
    return col_(ts).cast("timestamp").cast("long")


def attr_hash(df, cols=TITLE_ATTRS, sep: str = ATTR_HASH_SEP) -> Column:
    """sha2-256 over business attributes of ``df``.

    Every value is rendered as text (arrays with ``array_join(…, ',')``, which
    drops NULL elements) and NULL becomes '' — so NULL and '' hash alike and the
    order of array elements matters.
    """
    types = dict(df.dtypes)
    parts = []
    for name in cols:
        c = F.col(name)
        if types.get(name, "").startswith("array"):
            c = F.array_join(c, GENRE_SEP)
        parts.append(F.coalesce(c.cast("string"), F.lit("")))
    return F.sha2(F.concat_ws(sep, *parts), 256)


def pick(pool: list, index) -> Column:
    """pool[index mod len(pool)] — deterministic choice from a literal pool."""
    arr = F.array(*[F.lit(v) for v in pool])
    return F.element_at(arr, (F.pmod(col_(index), F.lit(len(pool))) + 1).cast("int"))


def stable_salt(n: int, *cols) -> Column:
    """Deterministic salt in [0, n) from row content (safe under task retries)."""
    return F.pmod(F.xxhash64(*[col_(c) for c in cols]), F.lit(n)).cast("int")
