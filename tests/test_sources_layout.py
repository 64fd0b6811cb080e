"""Schema inference with hints and add-only evolution; layout jobs; sketches."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchtide.operators import distinct as D
from watchtide.sources.files import evolve_schema, infer_schema
from watchtide.sources.tables import cluster_table, compact_table, file_count, write_table


def test_infer_schema_hints_and_evolution(spark, tmp_dir):
    land, store = f"{tmp_dir}/land", f"{tmp_dir}/_ops/schema"
    with open(f"{tmp_dir}/a.json", "w") as fh:
        fh.write(json.dumps({"event_id": 1, "title_id": 2, "event_ts": "2024-01-01T00:00:00Z"}) + "\n")
    import os
    os.makedirs(land)
    os.rename(f"{tmp_dir}/a.json", f"{land}/a.json")
    s1 = infer_schema(spark, land, hints="event_ts timestamp, title_id int", store=store)
    assert dict((f.name, f.dataType) for f in s1.fields) == {
        "event_id": T.LongType(), "event_ts": T.TimestampType(), "title_id": T.IntegerType()}
    with open(f"{land}/b.json", "w") as fh:
        fh.write(json.dumps({"event_id": 2, "title_id": 3, "new_col": "x"}) + "\n")
    s2 = infer_schema(spark, land, hints="event_ts timestamp, title_id int", store=store)
    assert s2.fieldNames()[:3] == s1.fieldNames() and s2.fieldNames()[3] == "new_col"
    assert s2["title_id"].dataType == T.IntegerType()


def test_schema_inside_scanned_folder_is_refused(spark, tmp_dir):
    import pytest
    with pytest.raises(ValueError):
        infer_schema(spark, tmp_dir, store=f"{tmp_dir}/_schema")


def test_evolve_is_add_only():
    a = T.StructType([T.StructField("x", T.IntegerType())])
    b = T.StructType([T.StructField("x", T.StringType()), T.StructField("y", T.LongType())])
    assert evolve_schema(a, b) == T.StructType([T.StructField("x", T.IntegerType()),
                                                T.StructField("y", T.LongType())])


def test_compaction_and_clustering(spark, tmp_dir):
    src, dst, cl = f"{tmp_dir}/src", f"{tmp_dir}/dst", f"{tmp_dir}/cl"
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("k"))
    write_table(df.repartition(20), src)
    before, after = compact_table(spark, src, dst, 2)
    assert before == 20 and after == 2
    assert spark.read.parquet(dst).count() == 5000
    cluster_table(spark, src, cl, ["k"], 4)
    # every file covers a disjoint k range -> a selective read touches one file
    ranges = (spark.read.parquet(cl).groupBy(F.col("_metadata.file_path"))
              .agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect())
    assert all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))
    sel = spark.read.parquet(cl).filter(F.col("k") == 500)
    assert sel.select(F.col("_metadata.file_path")).distinct().count() == 1


def test_partitioned_writes_make_few_files(spark, tmp_dir):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 5).alias("day")).repartition(6)
    df.write.partitionBy("day").parquet(f"{tmp_dir}/small")
    before, after = compact_table(spark, f"{tmp_dir}/small", f"{tmp_dir}/dst", partition_by="day")
    assert before == 30 and after == 5
    write_table(df, f"{tmp_dir}/direct", partition_by="day")
    assert file_count(spark, f"{tmp_dir}/direct") == 5
    assert spark.read.parquet(f"{tmp_dir}/dst").count() == 3000


def test_count_min_never_counts_too_little(spark):
    df = spark.range(20_000).select((F.col("id") * F.col("id") % 997).alias("k"))
    table = {(r.row, r.cell): r.n for r in D.count_min(df, "k", width=256, depth=4).collect()}
    assert len(table) <= 4 * 256
    keys = df.groupBy("k").count().select("k", "count", F.array(*D._cells("k", 4, 256, 7)).alias("cells")).collect()
    over = [min(table[i, c] for i, c in enumerate(r.cells)) - r["count"] for r in keys]
    assert min(over) >= 0 and sum(x > 2.72 * 20_000 / 256 for x in over) <= len(over) * 0.1


def test_sketches_merge_and_heavy_hitters(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") % 5).alias("day"),
                                  (F.col("id") % 400).alias("user_id"))
    merged = D.merge_sketches(D.distinct_sketch(df, ["g", "day"]), ["g"])
    exact = {r.g: r.c for r in df.groupBy("g").agg(F.count_distinct("user_id").alias("c")).collect()}
    for r in merged.collect():
        assert abs(r.estimate - exact[r.g]) <= 0.05 * exact[r.g]
    hot = spark.range(1000).select(F.when(F.col("id") < 600, 0).otherwise(F.col("id")).alias("k"))
    for method in ("exact", "count_min"):
        assert [(r.k, r.n) for r in D.heavy_hitters(hot, "k", 100, method=method).collect()] == [(0, 600)]
        assert [(r.k, r.n) for r in D.heavy_hitters(hot, "k", share=0.5, method=method, width=64).collect()] == [(0, 600)]
    sampled = D.heavy_hitters(hot, "k", 100, method="sample", fraction=0.5, seed=3).collect()
    assert [r.k for r in sampled] == [0]
    err = D.distinct_error(df, ["g"]).first()
    assert err.exact == 1200 and err.within_bound  # 400 users in each of 3 groups
