"""Session helpers: defaults every loader relies on, and the shared scratch dir."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "watchtide",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, ANSI and AQE on, UI off."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin the runtime SQL settings the operators' semantics depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set to shared storage. Only a session whose tasks all run
    in this process may go without: it gets a new temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="watchtide-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/watchtide/{name}-{uuid.uuid4().hex[:12]}"


def publish(df, name: str):
    """Write a DataFrame to a new folder of the shared storage and read it back: computed
    once, and of a size the optimizer knows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what :func:`scratch_path` handed out, once no result that reads it is in use."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/watchtide")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def apply_scale(spark: SparkSession, input_bytes: int, cores: int, window_heavy: bool = False) -> None:
    """Set :func:`scale_conf` on a running session (all of it can change between queries)."""
    for k, v in scale_conf(input_bytes, cores, window_heavy).items():
        spark.conf.set(k, v)


WINDOW_ADVISORY = 16 * 1024 * 1024
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def window_sized(spark: SparkSession) -> Iterator[None]:
    """Jobs started within get shuffled partitions of at most :data:`WINDOW_ADVISORY` bytes.

    A task of several windows and joins sorts each of their inputs, and rows take some ten times their shuffled
    bytes there, so the session's advisory size (64 MiB by default) is too much for it. A smaller one stays.
    """
    before = spark.conf.get(ADVISORY)
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(ADVISORY, str(min(size, WINDOW_ADVISORY)))
    try:
        yield
    finally:
        spark.conf.set(ADVISORY, before)


def scale_conf(input_bytes: int, cores: int, window_heavy: bool = False) -> dict:
    """Shuffle sizing for a run reading ``input_bytes`` on ``cores`` task slots.

    * shuffle partitions: enough for ~128 MiB of shuffle input per task, at
      least 2 waves of the cluster, so AQE has room to coalesce;
    * advisory partition size: AQE measures *compressed* shuffle bytes, while
      window sorts hold *decompressed* rows (low-cardinality telemetry expands
      ~10x), so window-heavy stages (sessionization, dedup) target 16 MiB;
    * skew split: a partition over 5x the median and 256 MiB is split; lower the
      byte floor with the advisory size so hot keys are caught early;
    * broadcasts: up to 64 MiB by the size measured at run time;
    * file splits: 128 MiB input partitions.
    """
    per_task = 128 * 1024 * 1024
    parts = max(2 * cores, -(-input_bytes // per_task))
    advisory = (16 if window_heavy else 64) * 1024 * 1024
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * advisory),
        "spark.sql.files.maxPartitionBytes": str(per_task),
    }
