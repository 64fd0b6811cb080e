"""Bronze ingestion with Structured Streaming: incremental JSON file source
-> lineage columns -> append-only Parquet sink, run to completion.

Exactly-once per file comes from the checkpoint: the file source records the
files it has read in the checkpoint's source log, so a re-run only picks up
new files and a run without new files appends nothing. A restarted run
after an executor or driver loss resumes from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchtide.config import SNAPSHOT_PATH_PATTERN
from watchtide.schemas import RAW_HEARTBEAT, RAW_TITLE
from watchtide.sources.files import RAW_LINES, _check_outside, evolve_from_raw, parse_with_rescue, path_date, read_json, shape, with_lineage

MAX_FILES = 1000  # of one micro-batch: a first load of a large backlog is many batches, each of its own commit


def append_stream(df: DataFrame, path: str, checkpoint: str, partition_by=None,
                  query_name: str | None = None) -> dict:
    """Drain all available input into a Parquet folder, then stop.

    Returns a small summary (batches and input rows of this run).
    """
    w = (df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if query_name:
        w = w.queryName(query_name)
    # a backlog may take any number of batches: keep the progress of all of this run's
    conf, kept = df.sparkSession.conf, "spark.sql.streaming.numRecentProgressUpdates"
    before = conf.get(kept)
    conf.set(kept, str(1 << 30))
    try:
        q = w.start(path)
        q.awaitTermination()
    finally:
        conf.set(kept, before)
    progress = q.recentProgress
    return {"batches": len([p for p in progress if p.get("numInputRows", 0) > 0]),
            "rows": sum(p.get("numInputRows", 0) for p in progress)}


def land_lines(spark: SparkSession, landing: str, raw: str, checkpoint: str, recursive: bool = False,
               max_files: int | None = MAX_FILES) -> dict:
    """Landing lines -> raw table, as they are, with lineage and the shape of each line.

    This is the only time that a landing file is opened.
    """
    reader = spark.readStream.format("text")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(landing).select("value", F.col("_metadata.file_path").alias("_source_file"))
    lines = lines.withColumns({"_ingest_ts": F.current_timestamp(), "_shape": shape("value")}).withColumn("_ingest_date", F.to_date("_ingest_ts"))
    return append_stream(lines, raw, checkpoint, partition_by="_ingest_date")


def _landed(spark: SparkSession, landing: str, checkpoint: str, bronze: str, schema: T.StructType, store: str | None,
            recursive: bool, max_files: int | None) -> DataFrame:
    """A landing folder as a stream with lineage.

    With a schema ``store``, lines go to a raw table beside bronze first, fields that they bring are added to the
    stored schema, and the stream reads the raw table, so that no landing file is opened a second time;
    ``schema`` gives the types that are fixed.
    """
    _check_outside(landing, checkpoint, bronze)
    if not store:
        return with_lineage(read_json(spark, landing, schema, rescue=True, recursive=recursive, streaming=True,
                                      max_files_per_trigger=max_files))
    _check_outside(landing, store)
    raw = f"{bronze.rstrip('/')}_raw"
    land_lines(spark, landing, raw, f"{checkpoint.rstrip('/')}_raw", recursive, max_files)
    schema = evolve_from_raw(spark, raw, schema, store)
    reader = spark.readStream.schema(RAW_LINES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_with_rescue(reader.parquet(raw).drop("_shape", "_ingest_date"), schema)


def ingest_heartbeats(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                      schema=RAW_HEARTBEAT, max_files_per_trigger: int | None = MAX_FILES,
                      schema_store: str | None = None) -> dict:
    """Landing heartbeat JSON -> bronze (raw + rescued data + lineage)."""
    df = _landed(spark, landing, checkpoint, bronze, schema, schema_store, False, max_files_per_trigger)
    # partitioned by ingest day, so the daily silver slice prunes to one folder
    return append_stream(df.withColumn("_ingest_date", F.to_date("_ingest_ts")), bronze, checkpoint, partition_by="_ingest_date")


def ingest_titles(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                  schema=RAW_TITLE, pattern: str = SNAPSHOT_PATH_PATTERN,
                  max_files_per_trigger: int | None = MAX_FILES, schema_store: str | None = None) -> dict:
    """Landing title snapshots (``title/<date>/``) -> bronze with ``_snapshot_date``."""
    df = _landed(spark, landing, checkpoint, bronze, schema, schema_store, True, max_files_per_trigger)
    # partitioned by snapshot, so one snapshot's load reads one folder
    return append_stream(df.withColumn("_snapshot_date", path_date(F.col("_source_file"), pattern)), bronze, checkpoint,
                         partition_by="_snapshot_date")
