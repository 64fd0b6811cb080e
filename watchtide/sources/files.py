"""File sources: JSON landing folders (batch and incremental), schemas,
rescued data, lineage and path-derived columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from watchtide.config import SNAPSHOT_PATH_PATTERN
from watchtide.sources.notes import load_note, save_note
from watchtide.sources.tables import table_exists

CORRUPT = "_corrupt_record"

#: Landing lines as they were read once: text, lineage and the shape of the line.
RAW_LINES = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_ingest_ts", T.TimestampType()),
    T.StructField("_shape", T.StringType()),
    T.StructField("_ingest_date", T.DateType()),
])


def _check_outside(scanned: str, *others: str) -> None:
    """Bookkeeping folders must never sit inside the folder a source scans."""
    root = scanned.rstrip("/") + "/"
    for o in others:
        if o and (o.rstrip("/") + "/").startswith(root):
            raise ValueError(f"{o} lies inside the scanned folder {scanned}")


def schema_from_ddl(spark: SparkSession, ddl: str) -> T.StructType:
    return spark.createDataFrame([], ddl).schema


def apply_hints(schema: T.StructType, hints: T.StructType) -> T.StructType:
    """Force the hinted columns' types (added when absent)."""
    hinted = {f.name: f for f in hints.fields}
    fields = [hinted.pop(f.name, f) for f in schema.fields]
    return T.StructType(fields + list(hinted.values()))


def evolve_schema(stored: T.StructType, observed: T.StructType) -> T.StructType:
    """Add-only evolution: stored fields keep their types, new fields are appended."""
    names = set(stored.fieldNames())
    return T.StructType(list(stored.fields) + [f for f in observed.fields if f.name not in names])


def load_schema(spark: SparkSession, store: str) -> tuple[T.StructType, str | None] | None:
    """The stored schema and the time up to which files were looked at; None without a store."""
    kept = load_note(spark, store)
    return (T.StructType.fromJson(kept["schema"]), kept["seen"]) if kept else None


def save_schema(spark: SparkSession, schema: T.StructType, store: str, seen: str | None = None) -> None:
    save_note(spark, {"schema": schema.jsonValue(), "seen": seen}, store)


def infer_schema(spark: SparkSession, path: str, hints: str | T.StructType | None = None,
                 store: str | None = None, sampling_ratio: float = 1.0,
                 recursive: bool = False) -> T.StructType:
    """Infer a JSON schema (typed, not all-strings), force ``hints`` and persist it.

    With a ``store``, later runs look only at files that came since, and evolve the
    stored schema add-only: known fields keep their types, new ones are appended.
    """
    if store:
        _check_outside(path, store)
    kept = load_schema(spark, store) if store else None
    # Files of the minute before are looked at again: their clock may differ from ours.
    now = spark.range(1).select(F.date_format(F.current_timestamp() - F.expr("INTERVAL 1 MINUTE"),
                                              "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    reader = spark.read.option("samplingRatio", sampling_ratio)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if kept and kept[1]:
        reader = reader.option("modifiedAfter", kept[1])
    try:
        observed = reader.json(path).schema
    except AnalysisException:  # no file, or none that is new
        observed = T.StructType([])
    observed = T.StructType([f for f in observed.fields if f.name != CORRUPT])
    if isinstance(hints, str):
        hints = schema_from_ddl(spark, hints)
    if hints:
        observed = apply_hints(observed, hints)
    schema = evolve_schema(kept[0], observed) if kept else observed
    if store:
        save_schema(spark, schema, store, now)
    return schema


def shape(value) -> Column:
    """The schema of one JSON line, as text; NULL for a malformed line."""
    return F.schema_of_variant(F.try_parse_json(value))


#: Type names of variant schemas that a table column names otherwise. Fractions are read as JSON
#: sources read them; what is NULL everywhere, or differs from line to line, is kept as text.
_VARIANT_TYPES = [(r"\bOBJECT<", "STRUCT<"), (r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE"), (r"\b(VOID|VARIANT)\b", "STRING")]


def _from_variant_schema(spark: SparkSession, text: str | None) -> T.StructType:
    """A variant schema as a table schema; without fields if the lines hold no objects."""
    for pattern, name in _VARIANT_TYPES:
        text = re.sub(pattern, name, text or "")
    if not text.startswith("STRUCT<") or text == "STRUCT<>":
        return T.StructType([])
    return schema_from_ddl(spark, f"v {text}")["v"].dataType


def evolve_from_raw(spark: SparkSession, raw: str, hints: T.StructType, store: str) -> T.StructType:
    """The stored schema with the fields that raw lines since the last look bring; it is stored.

    Lines carry their :func:`shape`, found while they were read from the landing folder. Only
    that column is read for all lines, and one line per shape is looked into.
    """
    kept = load_schema(spark, store)
    lines = spark.read.schema(RAW_LINES).parquet(raw) if table_exists(spark, raw) else spark.createDataFrame([], RAW_LINES)
    if kept and kept[1]:
        lines = lines.filter((F.col("_ingest_date") >= F.to_date(F.lit(kept[1]))) & (F.col("_ingest_ts") > F.lit(kept[1]).cast("timestamp")))
    shapes = lines.groupBy("_shape").agg(F.min("value").alias("value"), F.max("_ingest_ts").alias("at"))
    found = shapes.agg(F.schema_of_variant_agg(F.try_parse_json("value")).alias("schema"), F.max("at").cast("string").alias("at")).first()
    observed = apply_hints(_from_variant_schema(spark, found["schema"]), hints)
    schema = evolve_schema(kept[0], observed) if kept else observed
    save_schema(spark, schema, store, found["at"] or (kept[1] if kept else None))
    return schema


def parse_with_rescue(lines: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Parse JSON text lines, keeping what does not fit. Nothing is dropped.

    ``_rescued_data`` holds the raw line if it is malformed or a value has the wrong
    type (the row keeps what could be parsed); silver turns such rows away. Keys that
    the schema doesn't know are no fault: they go to ``_unknown_fields`` as a JSON
    object, until the schema knows them.
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value_col), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    known = F.array(*[F.lit(n) for n in schema.fieldNames()])
    unknown = F.array_except(F.json_object_keys(F.col(value_col)), known)
    # the values are parsed a second time only for lines that have unknown keys
    values = F.map_filter(F.from_json(F.col(value_col), T.MapType(T.StringType(), T.StringType())),
                          lambda k, v: ~F.array_contains(known, k))
    keep = [c for c in lines.columns if c != value_col]
    out = lines.select(*keep, parsed.alias("_p"), F.when(F.size(unknown) > 0, F.to_json(values)).alias("_unknown_fields"))
    return out.select(*keep, *[F.col("_p").getField(n).alias(n) for n in schema.fieldNames()],
                      F.col("_p").getField(CORRUPT).alias("_rescued_data"), "_unknown_fields")


def with_lineage(df: DataFrame) -> DataFrame:
    """``_ingest_ts`` (one value per micro-batch) and ``_source_file`` (kept
    when the source already captured it, else the hidden file metadata)."""
    cols = {"_ingest_ts": F.current_timestamp()}
    if "_source_file" not in df.columns:
        cols["_source_file"] = F.col("_metadata.file_path")
    return df.withColumns(cols)


def path_date(path_col: Column, pattern: str = SNAPSHOT_PATH_PATTERN) -> Column:
    """Date string captured from the file path; NULL (not '') without a match."""
    return F.nullif(F.regexp_extract(path_col, pattern, 1), F.lit(""))


def read_json(spark: SparkSession, path: str, schema: T.StructType, rescue: bool = True,
              recursive: bool = False, streaming: bool = False,
              max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON landing folder as a (streaming) DataFrame with ``_source_file``.

    ``rescue=True`` reads raw lines and parses them with ``parse_with_rescue``;
    otherwise the JSON source parses with the given schema (no inference).
    """
    reader = spark.readStream if streaming else spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if rescue:
        lines = reader.format("text").load(path)
        lines = lines.select("value", F.col("_metadata.file_path").alias("_source_file"))
        return parse_with_rescue(lines, schema)
    df = reader.schema(schema).format("json").load(path)
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)
