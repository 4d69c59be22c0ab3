"""Session helpers: building a local session for tests/bench and reading
cluster settings (checkpoint folder) from whatever session is running."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(cpus: int | None = None, app: str = "strata", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local session used by tests and bench. On a cluster the caller passes its
    own session; nothing in the library creates one."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset on a local master (tests) a scratch folder is chosen; a
    cluster must name a folder that all its machines share."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001
            d = None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = checkpoint_root(spark)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): the server's setting applies
        pass
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


class Tables:
    """Lazy access to the driver's parquet tables: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        return self.__getattr__(name)
