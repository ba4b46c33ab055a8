"""Session defaults and the shared work folder.

Everything that has to outlive one job (checkpoints, staged tables, stream state) is written below
``spark.checkpoint.dir``.  On a cluster that setting must name a folder every node can reach; only a
``local[...]`` session without it falls back to a fresh temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_ROOTS: dict[str, str] = {}


def local_session(app: str = "millrace", cores: str | int = "*", **conf) -> SparkSession:
    """A ``local[cores]`` session for tests, the oracle check and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, also set as the checkpoint directory if none is."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all nodes")
        root = _LOCAL_ROOTS.get(sc.applicationId)
        if root is None:
            root = _LOCAL_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the shared root."""
    return f"{shared_root(spark).rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are stored in the shared folder and survive lost executors."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out evenly before a fit that reads them many times, whatever their number.

    A file or two with few row groups would otherwise keep most cores idle, and large files hold uneven shares.  ``partitions``
    is the session's number of shuffle partitions if not given.
    """
    return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def sized_broadcast(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only for a frame that is stored and proven to take at most ``max_bytes``.

    The rows are written once and read back, so the work behind them is done once, and the check reads
    a file size, not the rows.  Parquet is compressed, so a quarter of the limit is allowed on disk.
    Above it the join stays a shuffle join that adaptive execution may still re-plan or de-skew.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "small-side")
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(stored) if size <= max_bytes // 4 else stored
