"""Parquet tables on shared storage: reads, scoped overwrites, layout jobs.

Without a transactional table format, ``MERGE``/``replaceWhere`` become:
* scoped overwrite — one dynamic partition overwrite of the dates that got rows;
  partitions of the scope that got none are removed right after it;
* single-partition overwrite — a static write into that partition's folder;
* insert-only merge — anti join + append (``operators.merge.insert_new``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from watchtide.operators.layout import cluster_by, cluster_by_curve, compact, rebalance, small_partitions


@dataclass(frozen=True)
class RunReport:
    """What one write did: rows written, partition dates written and emptied."""

    rows: int = 0
    dates: list[str] = field(default_factory=list)
    emptied: list[str] = field(default_factory=list)


def folder(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything was ever written to the table's folder."""
    fs, p = folder(spark, path)
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a Parquet table; with ``schema`` no file footers are read for it, and the
    partition columns keep the contract's types instead of inferred ones."""
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.parquet(path)


def _cols(partition_by) -> list[str]:
    return [partition_by] if isinstance(partition_by, str) else list(partition_by)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """Write a table; a partitioned one with its rows brought together by partition first."""
    if partition_by:
        cols = _cols(partition_by)
        rebalance(df, cols).write.mode(mode).partitionBy(*cols).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def _observed(df: DataFrame, col: str) -> tuple[DataFrame, Observation]:
    """``df`` with its rows and distinct dates counted by the job that writes it."""
    obs = Observation("written")
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(col).cast("string")).alias("dates")), obs


def _report(obs: Observation, df: DataFrame) -> RunReport:
    """What the write of ``df`` counted. A plan that turns out empty at run time carries no
    metrics; any other one without them is a failure."""
    try:
        seen = obs.get
    except Py4JJavaError:
        if df.isEmpty():
            return RunReport()
        raise
    return RunReport(seen["rows"], sorted(seen["dates"] or []))


def append_table(df: DataFrame, path: str, partition_by: str) -> RunReport:
    """Append to a table partitioned by a date; reports what was written, without a second scan."""
    out, obs = _observed(df, partition_by)
    write_table(out, path, "append", partition_by)
    return _report(obs, df)


def overwrite_partition(df: DataFrame, path: str, col: str, value) -> None:
    """Replace exactly one partition ``col=value`` (static overwrite)."""
    df.drop(col).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{col}={value}")


def partition_values(spark: SparkSession, path: str, col: str) -> list[str]:
    """Values of the partition folders of a table; a listing, no job."""
    fs, p = folder(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{col}="))


def move_folder(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename a folder, in place of what is there; whether there was one to rename."""
    fs, a = folder(spark, src)
    _, b = folder(spark, dst)
    if fs.exists(b):
        fs.delete(b, True)
    if not fs.exists(a):
        return False
    if not fs.rename(a, b):
        raise OSError(f"{src} could not be renamed to {dst}")
    return True


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, p = folder(spark, path)
    fs.delete(p, True)


def drop_partition(spark: SparkSession, path: str, col: str, value: str) -> None:
    """Remove one partition's folder."""
    drop_folder(spark, f"{path.rstrip('/')}/{col}={value}")


def overwrite_dates(df: DataFrame, path: str, col: str, lo, hi) -> RunReport:
    """Replace every ``col`` partition in ``[lo, hi]`` with the rows of ``df``.

    ``df`` must only hold rows inside the scope. Dates that receive rows are
    replaced by one write job; partitions of the scope that exist and received none are
    removed afterwards (folders only, no job). The dates written are observed during
    the write, so ``df`` is computed once. A failure between the two steps leaves old
    partitions standing; running the load again removes them.
    """
    spark = df.sparkSession
    out, obs = _observed(df, col)
    (rebalance(out, [col]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(col).parquet(path))
    done = _report(obs, df)
    emptied = [d for d in partition_values(spark, path, col) if str(lo) <= d <= str(hi) and d not in done.dates]
    for d in emptied:
        drop_partition(spark, path, col, d)
    return RunReport(done.rows, done.dates, emptied)


def replace_table(df: DataFrame, path: str) -> None:
    """Create-or-replace a whole (unpartitioned) table."""
    df.write.mode("overwrite").parquet(path)


def run_noop(df: DataFrame) -> None:
    """Compute everything, write nothing (benchmark sink)."""
    df.write.format("noop").mode("overwrite").save()


def file_count(spark: SparkSession, path: str) -> int:
    """Number of data files behind a table, empty ones included."""
    return data_files(spark, path).count()


def compact_table(spark: SparkSession, path: str, out_path: str, target_files: int = 1,
                  partition_by=None) -> tuple[int, int]:
    """Rewrite a table into fewer files; returns the file counts (before, after).

    An unpartitioned table gets ``target_files`` files; a partitioned one as few per
    partition as the advisory partition size allows. Writes to a new path, never over
    its input.
    """
    before = file_count(spark, path)
    df = read_table(spark, path)
    write_table(df if partition_by else compact(df, target_files), out_path, "overwrite", partition_by)
    return before, file_count(spark, out_path)


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """(part, size) of a table's data files: a listing that opens none of them."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    root = folder(spark, path)[1].getName()
    part = F.regexp_extract("path", f"/{re.escape(root)}/(.+)/[^/]+$", 1)
    return found.select(part.alias("part"), F.col("length").alias("size"))


def compact_small(spark: SparkSession, path: str, partition_by: str, target_bytes: int = 128 << 20) -> list[str]:
    """Rewrite, in place, the partitions of a table that hold more files than their bytes need.

    Only those are read, and one dynamic overwrite replaces them: its files are written aside and
    take the old ones' place when all are complete. Returns them; a run that finds nothing to do does nothing.
    One row per partition that needs it goes through the driver.
    """
    todo = small_partitions(data_files(spark, path), target_bytes).filter(F.col("part").startswith(f"{partition_by}=")).collect()
    if not todo:
        return []
    wanted = {r["part"].split("=", 1)[1]: r["wanted"] for r in todo}
    part = F.col(partition_by).cast("string")
    rows = spark.read.parquet(path).filter(part.isin(list(wanted)))
    # a partition's rows, dealt by their content, go to as many tasks as it is to have files
    pieces = spark.createDataFrame(list(wanted.items()), "_part string, _wanted int")
    dealt = rows.join(F.broadcast(pieces), part == F.col("_part")).withColumn("_piece", F.pmod(F.xxhash64(*rows.columns), F.col("_wanted")))
    (dealt.repartition(sum(wanted.values()), partition_by, "_piece").select(*rows.columns)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))
    return sorted(wanted)


def cluster_curve_table(spark: SparkSession, path: str, out_path: str, cols, n: int) -> None:
    """Rewrite a table along a curve through several columns, for data skipping on each of them."""
    write_table(cluster_by_curve(read_table(spark, path), cols, n), out_path)


def write_bucketed(df: DataFrame, name: str, path: str, cols, n: int) -> DataFrame:
    """Write a table in ``n`` buckets by ``cols``, sorted, known to the session as ``name``.

    Two tables with equal buckets are joined on these columns without a shuffle or a sort. One
    task writes a bucket, so that it is one file.
    """
    cols = _cols(cols)
    (df.repartition(n, *cols).write.mode("overwrite").bucketBy(n, cols[0], *cols[1:]).sortBy(cols[0], *cols[1:])
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def cluster_table(spark: SparkSession, path: str, out_path: str, cols, n: int) -> None:
    """Rewrite a table range-clustered on ``cols`` for min/max data skipping."""
    write_table(cluster_by(read_table(spark, path), cols, n), out_path)
