"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators are tuned for. All can be set on a live session.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join inputs even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}
# Only a new session can take this one: call sites of column expressions cost driver time.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

_own_scratch: list[str] = []


def build_session(app: str = "strataward", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **START_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session made elsewhere."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder of the cluster, from ``spark.checkpoint.dir``.

    Only a session in one process may go without: it gets a temporary folder. On a cluster
    the driver's folders are out of the executors' reach, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_scratch:
        _own_scratch.append(tempfile.mkdtemp(prefix="spark-"))
    return _own_scratch[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored_frame(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back, so later changes of the inputs don't reach the rows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
