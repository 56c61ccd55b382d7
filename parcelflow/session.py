"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution re-plans joins and
# partition counts from runtime sizes, splits skewed join partitions and
# coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # remove reliable checkpoints (key numbering) once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str = "parcelflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests and
    the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value
    always wins. Only a bare local session (tests) gets a fresh scratch
    folder of its own; a cluster session without the setting is an error,
    because a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for this cluster")
        configured = tempfile.mkdtemp(prefix="parcelflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
