"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on.  ANSI stays on (Spark 4 default) so bad casts
# fail loudly unless an operator asks for ``try_*`` semantics.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # reliable checkpoints (global windows, materialized aggregates) are
    # removed once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "bizlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when none is set.

    The cluster names its shared folder in ``spark.checkpoint.dir``; we always
    use that.  Where it is unset (tests, a plain local session) the folder lies
    in the warehouse, which driver and executors share too; a machine's own
    temporary folder is never used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = (spark.conf.get("spark.checkpoint.dir", None)
              or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def default_parallelism(spark: SparkSession) -> int:
    """Shuffle partition count of the session (the default width of distributed steps)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
