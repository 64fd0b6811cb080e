"""The pipeline over a whole table, stage by stage, and the registered queries."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from conftest import SF001
from pyspark.sql import functions as F
from watchtide.llm import mixing
from watchtide.llm.common import cut, table
from test_simhash_ring import plain_components, plain_fingerprint
from tools.check_oracle import digest


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF001, "documents"), {}
    out["start"] = docs
    for name, f in C.STAGES:
        docs = out[name] = cut(f(spark, docs, SF001), name)
    return out


def ids(df):
    return Counter(r.doc_id for r in df.collect())


def test_columns(stages):
    names = [n for n, _ in C.STAGES]
    assert all(stages[n].columns == stages["start"].columns for n in names[:-1])
    assert stages[names[-1]].columns == [*stages["start"].columns, "shard", "slot"]


def test_quality_keeps_every_document_labelled_good(stages, spark):
    good = {r.doc_id for r in table(spark, SF001, "labels").where("quality = 1").collect()}
    assert good & set(ids(stages["start"])) <= set(ids(stages["quality"]))


def test_one_document_of_each_group_stays(stages):
    rows = stages["quality"].collect()
    comp = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in rows])
    assert set(ids(stages["near_duplicates"])) == set(comp.values())


def test_documents_with_benchmark_items_go(stages, spark):
    items = [r.text for r in table(spark, SF001, "benchmark").collect()]
    want = {r.doc_id for r in stages["near_duplicates"].collect() if not any(t in r.text for t in items)}
    assert set(ids(stages["decontaminate"])) == want


def test_mixture(stages):
    plan = {r.doc_id: r.copies for r in mixing.op10_mix(stages["decontaminate"]).collect()}
    assert ids(stages["mix"]) == Counter({k: v for k, v in plan.items() if v})


def test_shards_hold_every_row_once(stages):
    rows = stages["shard"].collect()
    assert Counter(r.doc_id for r in rows) == ids(stages["mix"])
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert {(r.shard, r.slot) for r in rows} == {(s, i) for s, n in sizes.items() for i in range(n)}
    texts = {r.doc_id: r.text for r in stages["start"].collect()}
    assert all(r.text == texts[r.doc_id] for r in rows)


def test_empty_and_odd_documents_pass_through(spark, tmp_path):
    schema = table(spark, SF001, "documents").schema
    for rows in ([], [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (None, None, None, None, None), (2, "", "en", None, 0)]):
        d = str(tmp_path / f"t{len(rows)}")
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/documents.parquet")
        for t in ("labels", "benchmark"):
            table(spark, SF001, t).write.parquet(f"{d}/{t}.parquet")
        got = C.run(spark, d)
        assert got.columns[-2:] == ["shard", "slot"] and set(ids(got)) <= {1, 2, None}


def test_registered_names():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} <= {k.split("_")[0] for k in E.queries()}
    assert set(E.oracle_sql()) <= set(E.queries())


def test_op1_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF001}/pages.parquet')")
    df = E.queries()["op1_warc_segments"](spark, SF001)
    rel = con.sql(E.oracle_sql()["op1_warc_segments"])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


CLASHES = ("doc", "source_size", "kept", "bad", "gone", "twice", "row", "copy", "size", "text_crc32", "_h", "_copies", "_k", "_f", "shard", "slot",
           "component_id", "fp", "count", "placed_copy", "h", "key")


def test_stages_keep_columns_whose_names_they_use_themselves(spark):
    docs = table(spark, SF001, "documents")
    for c in CLASHES:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c}:"), "doc_id"))
    for name, stage in C.STAGES:
        docs = cut(stage(spark, docs, SF001), f"clash-{name}")
    own = [c for c in CLASHES if c not in ("shard", "slot")]
    assert set(docs.columns) == {*table(spark, SF001, "documents").columns, *CLASHES}
    for r in docs.collect():
        assert all(r[c] == f"{c}:{r.doc_id}" for c in own)
