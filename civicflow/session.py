"""SparkSession construction and the shared checkpoint folder.

On a cluster the session is built by the platform; ``configure`` only fills in
settings that are still unset, so cluster-provided values always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE re-plans joins at runtime
# (broadcast when a side is measured small, split skewed partitions of a
# sort-merge join), which is what keeps a hot borough / type / user from
# landing in one task.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "civicflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    # Local mode runs every task inside the driver JVM.
    conf.setdefault("spark.driver.memory", os.environ.get("CIVICFLOW_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply runtime SQL defaults that are still unset on an existing session."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.ui") or k == "spark.sql.session.timeZone":
            continue
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # static conf on a running session
            pass
    # Tickets are TIMESTAMP_NTZ (wall-clock): durations, hours and weekdays do
    # not depend on the session time zone, so the caller's zone is left as is.
    try:
        ensure_checkpoint_dir(spark)
    except Exception:  # no SparkContext access (e.g. Spark Connect)
        pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there and it is used as is.  Only a local
    session (tests, single machine) with nothing set gets a private folder; a
    cluster session without the setting gets none (never a machine-local one).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            return None
        configured = tempfile.mkdtemp(prefix="civicflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A path inside the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    if base is None:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the session was started."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, have) if x)
