"""Session construction and cluster-level settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants: adaptive execution (runtime re-plan, partition
# coalescing, skew-join splitting), UTC session time, ANSI semantics, no UI, counts from footers.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def get_session(master: str | None = None, app: str = "cinelens",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set when given, so on a cluster the submitter's choice
    wins. ``shuffle_partitions`` should be sized so one shuffle partition is
    ~128-256 MB at the target scale; AQE coalesces it down for small inputs.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is only read here;
    a cluster session without it is an error (a machine-local folder would not
    survive the loss of that machine). Only in local mode (tests) is a fresh
    scratch folder created and registered when it is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        d = tempfile.mkdtemp(prefix="cinelens-ckpt-")
        try:  # record it for later readers; some builds refuse core confs at runtime
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - the context setting below is what counts
            pass
    spark.sparkContext.setCheckpointDir(d)
    return d


def local_session(cpus: int | None = None) -> SparkSession:
    """Session for tests and the bench: local[cpus], shuffle partitions = cpus."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return get_session(master=f"local[{n}]", shuffle_partitions=n,
                       extra={"spark.driver.memory": "8g"})
