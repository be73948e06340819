"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that ``local_session`` makes and a cluster's session should make (results do
# not depend on them; a caller's session is left as it is):
# * all clustering keys as partition keys: a window/aggregate on (user, day) after a
#   join on user must not reuse the join's partitioning by user alone, or a hot user
#   is one task and AQE cannot split the skewed join partition.
REQUIRED_CONF = {
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # keyed and pane state of streams on local disk instead of the executors' heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings every job relies on: the required ones, AQE for runtime re-planning
# (coalescing, skew splitting, broadcast conversion), ANSI mode.
BASE_CONF = {
    **REQUIRED_CONF,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window fan-out multiplies the rows of a small pane stage (x12 .. x720); AQE must
    # not coalesce that stage below the cluster's parallelism just because its input
    # is small (default floor 1 MB per partition).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "streamlytics", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench on one machine (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Make the package importable by the Python workers (idempotent); called by the
    sources. The session's settings are the caller's and stay as they are."""
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors' Python workers (``addPyFile`` of a
    zip, as ``--py-files`` would), once per SparkContext. The stream state functions
    run in Python workers and are pickled by reference to this package."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import warnings
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    try:
        # a code archive on the driver; Spark itself copies it to every executor
        out = os.path.join(tempfile.mkdtemp(prefix="streamlytics-pkg-"), "streamlytics.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for d, _, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(d, f)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(out)
    except Exception as e:  # batch plans are JVM-only and do not need it; tried again next time
        warnings.warn(f"could not ship streamlytics to the Python workers ({e}); "
                      "pass it with --py-files for the streaming state functions")
        return
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the setting names a shared folder and is used as is; without one a
    cluster's session is an error, as each host would get a folder of its own. In local
    mode (tests) a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d and not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all hosts share")
    if not d:
        d = tempfile.mkdtemp(prefix="streamlytics-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (stream state, sinks)."""
    import uuid
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
