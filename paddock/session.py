"""Session construction and the shared scratch location.

Scratch data (versioned tables written by multi-step maintenance jobs) lives under the folder the
cluster names in ``spark.checkpoint.dir``; a machine-local folder is only created when that setting
is unset, as in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings every paddock job wants; sizes are per-cluster and left to the caller.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def get_spark(app: str = "paddock", master: str | None = None, shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a local one is made only in local mode, where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="paddock-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system it belongs to (local, shared or remote)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused directory under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/paddock/{purpose}-{uuid.uuid4().hex[:12]}"



def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back: computed once, and planned
    from then on by its real size."""
    return stored_observed(df, purpose, {})[0]


def stored_observed(df: DataFrame, purpose: str, observe: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """``stored``, and aggregates of the rows, collected by the job that writes them."""
    path = scratch_dir(df.sparkSession, purpose)
    seen = Observation() if observe else None
    (df.observe(seen, *[c.alias(n) for n, c in observe.items()]) if seen else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(seen.get) if seen else {}
