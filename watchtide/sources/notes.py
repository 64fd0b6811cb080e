"""Small durable records in shared storage: notes, and a ledger of work that is still owed.

Every record is a file of its own under a new name, visible only when complete, and older
ones are removed after it. A run that dies in between leaves the old record, the new
one or both, never neither.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from watchtide.sources.tables import folder


def _names(spark: SparkSession, store: str) -> list[str]:
    fs, p = folder(spark, store)
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.endswith(".json") and not n.startswith("."))


def _put(spark: SparkSession, store: str, name: str, note: dict) -> None:
    fs, p = folder(spark, f"{store}/{name}")
    _, half = folder(spark, f"{store}/.{name}-{uuid.uuid4().hex[:8]}")
    out = fs.create(half, True)
    out.write(bytearray(json.dumps(note), "utf-8"))
    out.close()
    if not fs.rename(half, p):
        raise OSError(f"{store}/{name} could not be written")


def _get(spark: SparkSession, store: str, name: str) -> dict:
    fs, p = folder(spark, f"{store}/{name}")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _drop(spark: SparkSession, store: str, names) -> None:
    for n in names:
        fs, p = folder(spark, f"{store}/{n}")
        fs.delete(p, False)


def load_note(spark: SparkSession, store: str) -> dict | None:
    """The last note kept in a folder; None if there is none."""
    names = _names(spark, store)
    return _get(spark, store, names[-1]) if names else None


def save_note(spark: SparkSession, note: dict, store: str) -> None:
    """Keep a note in place of the folder's last one. Names count up; the clock only starts them."""
    old = _names(spark, store)
    at = max([time.time_ns(), *(int(n.removesuffix(".json")) + 1 for n in old[-1:])])
    _put(spark, store, f"{at:020d}.json", note)
    _drop(spark, store, old)


@dataclass(frozen=True)
class Owed:
    """Dates a loader has to do again, the first of the dates from which it has to do all, and
    the ledger's entries that say so."""

    dates: list[str] = field(default_factory=list)
    since: str | None = None
    entries: list[str] = field(default_factory=list)


class Ledger:
    """What loaders owe because of what others have written.

    A loader enters what it will change before it commits the change, and the loader that
    has to follow strikes the entries it has read after its own write. A run that dies
    anywhere leaves too much work owed, never too little; all of it is idempotent.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def owe(self, loader: str, dates=(), since: str | None = None) -> list[str]:
        """Enter work for a loader; the entry's name, for :meth:`strike`."""
        dates = sorted({str(d) for d in dates})
        if not dates and since is None:
            return []
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}.json"
        _put(self.spark, f"{self.root}/{loader}", name, {"dates": dates, "since": since})
        return [name]

    def owed(self, loader: str) -> Owed:
        names = _names(self.spark, f"{self.root}/{loader}")
        notes = [_get(self.spark, f"{self.root}/{loader}", n) for n in names]
        return Owed(sorted({d for n in notes for d in n["dates"]}), min((n["since"] for n in notes if n["since"]), default=None), names)

    def strike(self, loader: str, entries) -> None:
        _drop(self.spark, f"{self.root}/{loader}", entries)
