"""Session-level helpers: recommended confs and lineage cutting.

Nothing here builds a session for production use; the caller owns the
session. ``local_session`` exists for tests and the bench.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Confs the library relies on for scale: AQE re-plans shuffles at run time
# (coalescing small partitions, splitting skewed join partitions, turning a
# shuffle join into a broadcast join once the measured side is small).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Scratch tables are written once and read a few times.
SCRATCH_CODEC = "zstd"
# A job's shuffle files are removed when it ends (Spark 4.1; unknown to older
# versions, which keep them until the driver's memory is collected).
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "haulwise") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset
    *and* the master is local (tests, bench) do we create our own folder;
    on a cluster an unset value is an error, because a machine-local temp
    folder would not survive executor loss.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="haulwise-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root for a written table."""
    root = checkpoint_root(spark)
    return os.path.join(root, "haulwise", f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs started within leave no shuffle files behind: a query of many jobs
    then needs disk for its stored tables and one job's shuffles, not for the
    shuffles of all. The session's own setting is put back at the end."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a table at or under a :func:`scratch_path` that no later job reads."""
    if not re.search(r"/haulwise/[\w-]+-[0-9a-f]{12}(/[\w-]+)?$", path):
        raise ValueError(f"{path!r} is no scratch table")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and
    read it back.

    Used where several passes read the same derived data: one job computes
    and writes it (an RDD checkpoint of an uncached frame would compute it
    twice), and a lost executor later re-reads files instead of recomputing
    the whole lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", SCRATCH_CODEC).parquet(path)
    return spark.read.parquet(path)
