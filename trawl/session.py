"""Session helpers: a tuned builder for tests/bench and a lineage cutter."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "trawl") -> SparkSession:
    """Local/test session. On a cluster the submitter's own session is used
    as is; nothing here is required by the library code."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    return (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`; set one only when the
    session has none (tests, local runs)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="trawl-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared checkpoint dir, survives
    executor loss); used between BFS levels."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` as parquet under the shared checkpoint folder and read it
    back: lineage is cut, the data survives executor loss, and later readers
    get columnar pruning (preferred over `checkpoint` for wide tables)."""
    import uuid

    base = checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
