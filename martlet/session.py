"""Session helpers: building a local session for tests/bench, runtime tuning,
and the shared scratch folder (``spark.checkpoint.dir``) used for lineage
cuts, materialised tables and stream checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings that only steer planning; they are safe to set on an
# existing session and are what a 100 TB run needs: AQE re-plans joins from
# real sizes, splits skewed partitions and coalesces tiny ones.
_RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "martlet") -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in _RUNTIME_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime defaults above where the session leaves them unset; an
    explicit setting, also an explicit ``false``, stays."""
    for key, value in _RUNTIME_DEFAULTS.items():
        if key == "spark.sql.session.timeZone":
            # Dates in this library never depend on the session zone (the
            # driver tables are TIMESTAMP_NTZ), but pin UTC for oracle parity.
            if spark.conf.get(key, None) in (None, ""):
                spark.conf.set(key, value)
            continue
        if key not in spark.conf.getAll and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide scratch folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object-store) folder there; it is read
    from the session and never replaced.  Only a local-mode session without
    one (tests) gets a fresh folder; on a cluster an unset value is an error.
    ``checkpoint()`` and everything written by :func:`scratch_path` land there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("set spark.checkpoint.dir to a shared (cluster-wide) folder")
        return current.rstrip("/")
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            # a machine-local folder is invisible to executors on other hosts
            raise RuntimeError("set spark.checkpoint.dir to a shared (cluster-wide) folder")
        current = tempfile.mkdtemp(prefix="martlet-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (one per call)."""
    return f"{shared_dir(spark)}/martlet/{name}-{uuid.uuid4().hex[:12]}"
