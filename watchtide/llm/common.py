"""Helpers the training-data operators share: tables, shared scratch, text scanning."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java character class of the white space between words: space and U+0009..U+000D.
SPACES = "\\x20\\x09-\\x0D"
_SPACE_CHARS = " \t\n\x0b\x0c\r"
_MULT = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a single-process ``local[...]`` session may go without: it gets a
    temporary folder. Anything else fails clearly.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="watchtide-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut,
    and safe against lost executors. The folder stays until the caller's results are used."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Delete the folder of a table made by :func:`cut` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for f in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(f).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def packed(docs: DataFrame, *cols: str) -> DataFrame:
    """The rows as one struct ``doc`` beside ``cols``, so that no other column's name can clash.

    ``select("doc.*")`` gives the rows back.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *cols)


def slots(spark: SparkSession) -> int:
    """How many ways hot groups are split: the session's shuffle parallelism."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for NULL and blank texts."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE_CHARS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, f"[{SPACES}]+"))


def prefix_counts(hist: DataFrame, group: list[str], bucket: str, n: str, out: str,
                  fold: int = 1024) -> DataFrame:
    """Add ``out``: the sum of ``n`` over the group's smaller buckets.

    Two levels, so that no window holds more than ``fold`` buckets of one block or one
    row per block: sums within blocks of ``fold`` buckets, then over the blocks.
    """
    from pyspark.sql import Window as W

    h = hist.withColumn("_hi", F.floor(F.col(bucket) / fold))
    blocks = h.groupBy(*group, "_hi").agg(F.sum(n).alias("_block"))
    before = W.partitionBy(*group).orderBy("_hi").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("_base", F.coalesce(F.sum("_block").over(before), F.lit(0)))
    inner = W.partitionBy(*group, "_hi").orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    h = h.withColumn("_in", F.coalesce(F.sum(n).over(inner), F.lit(0)))
    b = blocks.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_hi").alias("_g_hi"), "_base")
    cond = F.col("_hi") == F.col("_g_hi")
    for c in group:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return (h.join(b, cond).withColumn(out, F.col("_base") + F.col("_in"))
            .select(*hist.columns, out))


# ---- scanning texts in numpy, inside tasks -------------------------------------------

def chunks(batch: pa.RecordBatch, col: str, max_bytes: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``max_bytes`` of text each; one long text is one slice."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(col)), 0), dtype=np.int64)
    block = (np.cumsum(size) - size) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the offset of each (NULL as empty)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index of every word."""
    n = len(data)
    word = ~_IS_SPACE[data]
    first = np.empty(n + 1, bool)  # a word can start here: a break lies before
    first[0] = True
    first[1:] = ~word
    first[offsets] = True
    starts = np.flatnonzero(word & first[:-1])
    last = np.ones(n + 1, bool)
    last[:n] = ~word
    last[offsets] = True
    ends = np.flatnonzero(word & last[1:]) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 19)
        _powers[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, m, np.uint64))), dtype=np.uint64)
                      for m in (_MULT, pow(_MULT, -1, 1 << 64))]
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (SplitMix64's finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_SPAN = 1 << 22  # bytes hashed at once: what a very long text needs beside itself stays small


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each byte span (ascending, apart), whatever its place."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + _SPAN, side="right")))
        low, part = starts[a], data[starts[a]:ends[b - 1]]
        up, down = _power_tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:])
        out[a:b] = mix((sums[ends[a:b] - low] - sums[starts[a:b] - low]) * down[starts[a:b] - low])
        a = b
    return out


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased word of the texts, and the index of its text."""
    data, offsets = text_bytes(texts)
    starts, ends, doc = word_bounds(data, offsets)
    return span_hashes(lower_ascii(data), starts, ends), doc
