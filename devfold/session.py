"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)
_local: dict[str, str] = {}
_scratch: list[str] = []

# Runtime re-planning carries three of our scale rules: skewed join partitions
# are split, small sides are broadcast only once their real size is known, and
# shuffle partitions are sized by bytes: they start out many and are merged up to
# the advisory size, as adaptive execution merges but does not add partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Shuffles of a cluster run begin with this many partitions. A local run keeps the
# session's own number, since each of them is a file and a task there.
CLUSTER_PARTITIONS = "20000"


def get_session(app: str = "devfold", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session; ``conf`` entries win over the defaults."""
    if master is None or not master.startswith("local"):
        conf = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": CLUSTER_PARTITIONS, **conf}
    else:
        conf = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "true", **conf}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        key = spark.sparkContext.applicationId
        if key not in _local:
            _local[key] = tempfile.mkdtemp(prefix="devfold-")
            log.warning("spark.checkpoint.dir is not set: this local run writes to %s", _local[key])
        return _local[key]
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, under this session's own folder."""
    path = f"{shared_dir(spark)}/devfold-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, the scratch paths handed out inside it."""
    before = len(_scratch)
    try:
        yield
    finally:
        release(spark, before)


def release(spark: SparkSession, keep: int = 0) -> int:
    """Remove all scratch paths but the first ``keep``; frames over them end with that.

    Works on any file system Spark can write to. Returns how many paths went.
    """
    gone = _scratch[keep:]
    del _scratch[keep:]
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for name in gone:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(hadoop).delete(path, True)
    return len(gone)


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once and hand back the written table.

    Cuts the lineage with files that outlive executors, so a frame that several
    fits re-read is neither recomputed nor lost with a cached block.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "table")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
