"""Session helpers: builder for tests/bench and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def streaming_conf() -> dict[str, str]:
    """Settings every streaming job runs with: state in RocksDB (native
    memory and local disk, checkpointed), so state may outgrow the heap."""
    return {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "shopstream", extra: dict | None = None) -> SparkSession:
    """Session used by tests and bench. On a cluster use spark-submit's own."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**streaming_conf(), **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Day/hour parts follow the session zone (the reference used the JVM
    zone). Registered queries pin UTC so results match the oracle."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master (tests) may leave it unset and gets a temporary
    folder; on a cluster every executor would write to its own disk, so that
    is an error.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all "
                             f"executors share (master is {master})")
        root = "file://" + tempfile.mkdtemp(prefix="shopstream-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one run of one job,
    made through the root's own file system."""
    return f"{checkpoint_root(spark).rstrip('/')}/shopstream/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, and
    the rows outlive any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
