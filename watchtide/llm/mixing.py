"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a seeded hash. For each source the words are summed by hash
bucket, the bucket in which the running sum crosses the source's budget is found, and
only that bucket is summed again by the next bits of the hash. What lies below the
threshold is taken; nothing is sorted.

Defined cases: a NULL text has size 0; a NULL source is a source of its own, last in
order; rows with the same id, text and source share the leading bits of their hash but not the last,
which come from the row's place in the table, so that as many of them are taken as are needed (which
ones makes no difference); an empty table gives an empty result; columns other than those named in
the docstrings are ignored by :func:`op10_mix` and kept by :func:`mixed_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from watchtide.llm.common import cut, packed, slots, word_array

BITS = 12  # of the hash, for each level of histogram
LEVELS = 5
CONTENT_BITS = 36  # of the hash, from id and text; those below tell equal rows apart


def waterfill(sources: DataFrame, weight: Column, max_repeats: float) -> DataFrame:
    """Targets that share the total by weight, capped at ``max_repeats`` x the source.

    A source is capped before another if its size per weight is smaller, so with the
    sources in that order the first k are capped, k being the first at which the rest
    shares what is left without passing a cap. ``sources``: source, source_size, one
    row per source.
    """
    s = sources.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(float(max_repeats)))
    order = W.orderBy(F.col("_cap") / F.col("_w"), F.col("_pos"))
    s = (s.withColumn("_total", F.sum("source_size").over(W.partitionBy()).cast("double"))
         .withColumn("_all_w", F.sum("_w").over(W.partitionBy()))
         .withColumn("_cap_before", F.coalesce(F.sum("_cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("_w_before", F.coalesce(F.sum("_w").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("_level", (F.col("_total") - F.col("_cap_before")) / (F.col("_all_w") - F.col("_w_before")))
         .withColumn("_fits", F.col("_level") * F.col("_w") <= F.col("_cap")))
    first = F.min(F.when(F.col("_fits"), F.col("_cap") / F.col("_w"))).over(W.partitionBy())
    level = F.max(F.when((F.col("_cap") / F.col("_w") == first) & F.col("_fits"), F.col("_level"))).over(W.partitionBy())
    return (s.withColumn("_share", level)
            .withColumn("target", F.least(F.col("_cap"), F.coalesce(F.col("_share") * F.col("_w"), F.col("_cap"))))
            .select("source", "source_size", "target"))


def sources_of(sized: DataFrame, cycle: int, max_repeats: float) -> DataFrame:
    """Size and target of each source; weights 1..cycle repeat along the sources' order."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on: the only windows over everything are over these.
    pos = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    ranked = totals.withColumn("_pos", pos)
    return waterfill(ranked, ((F.col("_pos") - 1) % cycle + 1).cast("long"), max_repeats)


def _prefix(levels: int) -> Column:
    """The leading bits of the hash that ``levels`` levels of histogram look at."""
    return F.shiftrightunsigned("_h", 64 - BITS * levels) if levels else F.lit(0).cast("long")


def _in_boundary(sized: DataFrame, state: DataFrame, level: int) -> DataFrame:
    """Rows of each source's boundary bucket. The few sources are repeated per salt, so that
    a source with a third of all rows is spread wherever Spark doesn't broadcast them."""
    salt = slots(sized.sparkSession)
    s = state.select(F.col("source").alias("_s"), F.col("_below").alias("_at"),
                     F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("_salt"))
    on = (F.col("source").eqNullSafe(F.col("_s")) & (_prefix(level) == F.col("_at"))
          & (F.pmod("_h", F.lit(salt)).cast("int") == F.col("_salt")))
    return sized.join(s, on, "left_semi")


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, ``_below``: rows whose leading ``BITS * LEVELS`` hash bits are smaller are taken.

    ``budgets``: source, budget (words). Each level sums words by the next ``BITS`` bits
    within the boundary bucket of the level before, finds the bucket in which the running
    sum passes what is left of the budget, and takes the buckets before it off the budget.
    The last boundary bucket is taken as well if that brings the sum nearer.
    """
    state = budgets.select("source", F.col("budget").cast("double").alias("_left"), F.lit(0).cast("long").alias("_below"))
    for level in range(LEVELS):
        rows = _in_boundary(sized, state, level) if level else sized
        digit = _prefix(level + 1).bitwiseAND((1 << BITS) - 1)
        hist = rows.groupBy("source", digit.alias("_b")).agg(F.sum("size").alias("_n"))
        # At most 2**BITS rows a source.
        run = hist.withColumn("_upto", F.sum("_n").over(W.partitionBy("source").orderBy("_b")))
        s = state.select(F.col("source").alias("_s"), "_left", "_below")
        passed = F.min(F.when(F.col("_upto") > F.col("_left"), F.struct("_b", "_upto", "_n"))).alias("_x")
        found = (run.join(s, F.col("source").eqNullSafe(F.col("_s")), "right").groupBy("_s")
                 .agg(F.first("_left").alias("_left"), F.first("_below").alias("_below"), passed))
        over, under = F.col("_x._upto") - F.col("_left"), F.col("_left") - (F.col("_x._upto") - F.col("_x._n"))
        at = F.col("_x._b") + (F.when(over < under, 1).otherwise(0) if level == LEVELS - 1 else 0)
        at = F.coalesce(at, F.lit(1 << BITS))  # no bucket passes the budget: all are taken
        state = cut(found.select(F.col("_s").alias("source"), F.coalesce(under, F.lit(0.0)).alias("_left"),
                                 (F.col("_below") * (1 << BITS) + at).alias("_below")), "mix-level")
    return state.select("source", "_below")


def hashed(seed: int, doc_id: str, text: str, row: str) -> Column:
    """Leading bits from the document, the others from the row."""
    low = (1 << (64 - CONTENT_BITS)) - 1
    content = F.xxhash64(F.lit(seed), F.col(doc_id), F.coalesce(F.col(text), F.lit("")))
    return content.bitwiseAND(~low).bitwiseOR(F.xxhash64(F.lit(seed), F.col(row)).bitwiseAND(low))


def numbered(docs: DataFrame) -> DataFrame:
    """The rows as ``doc``, with a number ``row``."""
    return packed(docs).withColumn("row", F.monotonically_increasing_id())


def source_plan(rows: DataFrame, cycle: int = 3, max_repeats: float = 3.0, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """Sized rows (doc_id, source, size, _h), and per source what the mix takes of it.

    The second table has source, source_size, target, ``_whole`` (every document is taken
    floor(target / source_size) times) and ``_below`` (and once more if its hash prefix is
    smaller). At most one document's size separates what is taken from the target.
    ``rows`` are :func:`numbered`.
    """
    sized = cut(rows.select("doc.doc_id", "doc.source", F.size(word_array(F.col("doc.text"))).cast("long").alias("size"),
                            hashed(seed, "doc.doc_id", "doc.text", "row").alias("_h")), "mix-sizes")
    src = cut(sources_of(sized, cycle, max_repeats), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    src = src.withColumn("_whole", whole)
    rest = F.col("target") - F.col("_whole") * F.col("source_size")
    below = thresholds(sized, src.select("source", rest.alias("budget"))).withColumnRenamed("source", "_s")
    plan = src.join(below, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return sized, cut(plan, "mix-plan")


def taken_copies(rows: DataFrame, plan: DataFrame, salt: int) -> DataFrame:
    """Rows (with ``source`` and ``_h``) joined with their source's plan; adds ``_copies``.

    The plan has one row a source. It is repeated per salt, so that a source with a third
    of all rows is spread over as many tasks wherever Spark doesn't broadcast the plan.
    """
    p = plan.select(*[F.col(c).alias(f"_plan_{c}") for c in plan.columns],
                    F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("_plan_salt"))
    rows = rows.withColumn("_row_salt", F.pmod("_h", F.lit(salt)).cast("int"))
    once_more = F.shiftrightunsigned("_h", 64 - BITS * LEVELS) < F.col("_plan__below")
    return (rows.join(p, rows["source"].eqNullSafe(F.col("_plan_source")) & (F.col("_row_salt") == F.col("_plan_salt")))
            # the cap matters for empty documents alone, which share the hash order but no words
            .withColumn("_copies", F.least(F.col("_plan__whole") + once_more.cast("long"), F.when(
                F.col("_plan_source_size") > 0, F.ceil(F.col("_plan_target") / F.col("_plan_source_size"))))))


def op10_mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes of the document), copies, source."""
    sized, plan = source_plan(numbered(docs), **options)
    return taken_copies(sized, plan, slots(docs.sparkSession)).select(
        "doc_id", "size", F.col("_plan_source_size").alias("source_size"), F.col("_plan_target").alias("target"),
        (F.col("size") * F.col("_copies")).alias("taken"), F.col("_copies").alias("copies"), "source")


def mixed_documents(docs: DataFrame, seed: int = 11, **options) -> DataFrame:
    """The documents as often as the mix takes them, with their own columns; texts are not shuffled."""
    rows = cut(numbered(docs), "mix-rows")  # the numbers of both passes must be the same
    _, plan = source_plan(rows, seed=seed, **options)
    rows = rows.select("doc", F.col("doc.source").alias("source"), hashed(seed, "doc.doc_id", "doc.text", "row").alias("_h"))
    rows = taken_copies(rows, plan, slots(docs.sparkSession))
    copies = F.explode(F.expr("filter(sequence(0, cast(_copies as int)), i -> i > 0)")).alias("_copy")
    return rows.select("doc", copies).select("doc.*")
