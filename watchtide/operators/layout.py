"""File-layout operators: compaction, partition-wise rebalancing, clustering for data skipping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def compact(df: DataFrame, target_files: int) -> DataFrame:
    """Rewrite plan with ``target_files`` output files of even size.

    A round-robin ``repartition`` (a shuffle that balances bytes) rather than
    ``coalesce``, which would merge neighbouring partitions unevenly and shrink
    the upstream parallelism too.
    """
    return df.repartition(target_files)


def rebalance(df: DataFrame, cols) -> DataFrame:
    """Rows of one partition value together, for a write partitioned by ``cols``.

    Without it every task writes a file into every partition it has rows of. Adaptive
    execution sizes the pieces by the advisory partition size: small partitions share a
    task, and a large one (a hot date) is split over several.
    """
    return df.hint("rebalance", *cols)


def cluster_by(df: DataFrame, cols, n: int) -> DataFrame:
    """Range-partition by ``cols`` and sort inside each partition.

    Written out, every file then covers a narrow, non-overlapping key range,
    so Parquet row-group min/max statistics let selective reads skip files.
    Range bounds come from a sample of the data (no full collect).
    """
    cols = list(cols)
    return df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)


# ---- several keys -----------------------------------------------------------------------

def rank_bounds(df: DataFrame, cols, bits: int = 8, accuracy: int = 10_000) -> dict[str, list]:
    """Values that cut each column into 2 ** bits ranges of about equal rows, by approximate quantiles.

    A fetch of that many values per column, whatever the rows. A value that fills several ranges is
    there as often, so that the ranks of every column go up to the same number.
    """
    n = 1 << bits
    shares = [i / n for i in range(1, n)]
    row = df.agg(*[F.percentile_approx(_number(df, c), shares, accuracy).alias(c) for c in cols]).first()
    return {c: sorted(row[c] or []) for c in cols}


def _number(df: DataFrame, col: str) -> Column:
    """A column in numbers of the same order: dates in days, times in microseconds."""
    kind = df.schema[col].dataType.typeName()
    if kind == "date":
        return F.datediff(F.col(col), F.lit("1970-01-01").cast("date"))
    return F.unix_micros(col) if kind == "timestamp" else F.col(col)


def _at_most(values: Column, x: Column, bits: int) -> Column:
    """How many of a sorted array's values are at most ``x``: a binary search (arrays of less than 2 ** bits)."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda r, s: F.when((r + s <= F.size(values)) & (F.get(values, r + s - 1) <= x), r + s).otherwise(r))


def with_curve(df: DataFrame, cols, bounds: dict[str, list], bits: int = 8, out: str = "_z") -> DataFrame:
    """Add a row's place on the curve that goes through all columns alike: the bits of its ranks, interleaved (NULL ranks first)."""
    ranks = {f"_rank{i}": _at_most(F.array(*[F.lit(v) for v in bounds[c]]), _number(df, c), bits).cast("long") if bounds[c] else F.lit(0).cast("long")
             for i, c in enumerate(cols)}
    z = F.lit(0).cast("long")
    for i, r in enumerate(ranks):
        for b in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(F.col(r), b).bitwiseAND(F.lit(1).cast("long")), b * len(cols) + i))
    return df.withColumns(ranks).withColumn(out, z).drop(*ranks)


def cluster_by_curve(df: DataFrame, cols, n: int, bits: int = 8) -> DataFrame:
    """Range-partition by the place on a curve through several columns, and sort by it.

    Each file then covers a narrow range of every column, where ``cluster_by`` narrows the first
    one only.
    """
    if bits * len(cols) > 62:
        raise ValueError("more bits than a place on the curve has")
    placed = with_curve(df, cols, rank_bounds(df, cols, bits), bits)
    return placed.repartitionByRange(n, "_z").sortWithinPartitions("_z").drop("_z")


FILE_BITS = 22  # of the number of file bounds that lookup_cost can take


def lookup_cost(table: DataFrame, col: str) -> DataFrame:
    """What one lookup ``col = value`` reads of a stored table whose files are pruned by their least and
    greatest values, on average over the column's values: files, touched, bytes, read_bytes.

    Values are counted between the files' bounds (two per file), so what is put in order is
    as long as the list of files, not of values.
    """
    files = table.groupBy(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("size")).agg(
        F.min(col).alias("lo"), F.max(col).alias("hi")).filter("lo IS NOT NULL")
    points = files.agg(F.array_sort(F.array_union(F.collect_set("lo"), F.collect_set("hi")))).scalar()
    values = table.select(F.col(col).alias("v")).filter("v IS NOT NULL").distinct()
    p = F.col("_points")  # a column of its own: higher-order functions take no subquery
    gaps = values.withColumn("_points", points).groupBy(_at_most(p, F.col("v"), FILE_BITS).alias("gap")).agg(F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.col("gap").desc())  # as many rows as files have bounds
    gaps = gaps.withColumn("above", F.sum("n").over(above))
    lo, hi = (gaps.select(F.col("gap").alias(f"_{x}"), F.col("above").alias(f"_above_{x}")) for x in ("lo", "hi"))
    met = (files.withColumn("_points", points).withColumns({f"_g{x}": _at_most(p, F.col(x), FILE_BITS) for x in ("lo", "hi")})
           .join(lo, F.col("_glo") == F.col("_lo")).join(hi, F.col("_ghi") == F.col("_hi"))
           .withColumn("met", F.col("_above_lo") - F.col("_above_hi") + 1))  # the greatest itself is met
    n = gaps.agg(F.sum("n")).scalar()
    return met.agg(F.count(F.lit(1)).alias("files"), (F.sum("met") / n).alias("touched"), F.sum("size").alias("bytes"),
                   (F.sum(F.col("met") * F.col("size")) / n).alias("read_bytes"))


# ---- compaction of what needs it ----------------------------------------------------------

def small_partitions(files: DataFrame, target_bytes: int) -> DataFrame:
    """(part, files, bytes, wanted) of partitions that hold more files than their bytes need.

    ``files`` has a row per data file: part (its folder below the table) and size.
    """
    per = files.groupBy("part").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
    wanted = F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1)).cast("int")
    return per.withColumn("wanted", wanted).filter(F.col("files") > F.col("wanted"))
