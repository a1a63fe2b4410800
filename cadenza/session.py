"""Session construction and lineage cutting.

The library never assumes a particular cluster: ``get_spark`` only fills in
settings that the caller (or the cluster's spark-defaults) left unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings applied only when the session's configuration (cluster
# defaults, submit options, builder options) does not set them already.
_SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Set at start-up: no web UI (and no console progress bars) in batch runs.
_STATIC = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def get_spark(app: str = "cadenza", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and UTC timestamps.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them ``None`` so the cluster configuration wins.  The SQL
    defaults above only fill settings the configuration leaves unset.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _STATIC.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    explicit = spark.sparkContext.getConf()
    for k, v in _SQL_DEFAULTS.items():
        if not explicit.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is read as is.
    Only when it is unset (tests, a laptop) a fresh local folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is useless to executors on other hosts
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        configured = tempfile.mkdtemp(prefix="cadenza-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used before iterative work (k sweeps, model comparisons) so a lost
    executor re-reads checkpoint files instead of replaying the whole plan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def seats(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers, each of which ``repartition(n, column)`` puts into a partition
    of its own."""
    place = F.pmod(F.hash("seat"), F.lit(n)).alias("place")
    got = spark.range(64 * n).select(F.col("id").cast("int").alias("seat")).groupBy(place).agg(F.min("seat").alias("seat")).collect()
    own = {r["place"]: r["seat"] for r in got}
    return [own.get(k, 64 * n + k) for k in range(n)]


def sf_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(sf_path(sf_dir, table))
