"""Session set-up and the shared scratch folder.

Scratch data (landed test files, staged tables, checkpoints) always lives
under the folder the cluster names in ``spark.checkpoint.dir``.  Only when a
session has none (unit tests, a laptop) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE may merge shuffle output down to partitions of this size; small
    # enough that a few MB of landing data still gets parallel writers.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # cp949 landed files need the JDK charset table (SRC-4).
    "spark.sql.legacy.javaCharsets": "true",
}


def get_session(master: str | None = "local[*]", shuffle_partitions: int | None = None,
                app_name: str = "bourse", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide: its number
    of shuffle partitions stays unless ``shuffle_partitions`` is given (see
    ``scale_conf``).  A local session without one gets 8.
    """
    if shuffle_partitions is None and (master or "").startswith("local"):
        shuffle_partitions = 8
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a run over ``input_bytes`` of Parquet on ``cores``
    executor cores.

    Scans split files at ``target_partition_bytes`` (compressed), so a task
    holds a few hundred MB decoded.  Shuffles start with enough reducers for
    the same size per reducer (at least 3 waves of the cores) and let AQE
    coalesce small ones; skewed reducers over 4x the median (and 1 GB) are
    split.  Example: 100 TB (1e14 bytes) on 4,000 cores -> about 372,500 scan
    splits and initial reducers, coalesced by AQE after each stage.
    """
    reducers = max(3 * cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(reducers),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(reducers),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        # on a shared cluster size reducers by bytes, not by idle cores
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.  Only a local session (tests, a
    laptop) without one gets a folder of its own; on a cluster executors do
    not see the driver's disk, so a missing setting is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.path.join(tempfile.gettempdir(), "bourse-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for one run of one job, under the shared folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/bourse-scratch/{name}-{uuid.uuid4().hex[:12]}"


#: Tasks for each core that list or write folders.
WAVES = 4
_LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listing(spark: SparkSession):
    """Reads that are made inside list many folders by a few tasks for each core;
    Spark's own choice is a task for each folder, up to 10,000."""
    before = spark.conf.get(_LISTERS)
    spark.conf.set(_LISTERS, str(min(int(before), WAVES * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTERS, before)


_FEWEST_WRITERS = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
_LEAST_WRITTEN = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


@contextmanager
def writing(spark: SparkSession):
    """Writes that are made inside cost by folders more than by bytes: AQE merges
    their shuffle output no further than to ``WAVES`` tasks for each core, of 64 KB
    at least.  Its own choice is about a task for each core, where one task
    more than cores takes the time of two rounds."""
    before = {k: spark.conf.get(k, None) for k in (_FEWEST_WRITERS, _LEAST_WRITTEN)}
    fewest = max(int(before[_FEWEST_WRITERS] or 1), WAVES * spark.sparkContext.defaultParallelism)
    spark.conf.set(_FEWEST_WRITERS, str(fewest))
    spark.conf.set(_LEAST_WRITTEN, _DEFAULT_CONF[_LEAST_WRITTEN])
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
