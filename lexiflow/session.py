"""Session construction and the runtime settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that are safe to apply at runtime to any session the caller hands us.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # str_to_map on a bundle with a repeated key: the last value wins, as a dict would.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # texts of any length go to Python tasks: a batch is cut by bytes as well
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings and ship the package to the executors (idempotent)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lexiflow`` importable in the Python workers.

    The alignment kernel and the pandas UDFs are pickled by module reference,
    so every executor must be able to import the package. It is zipped once
    per SparkContext and handed to ``addPyFile``, which distributes it to all
    executors (the same as ``--py-files``)."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="lexiflow-pkg-"), "lexiflow.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "lexiflow") -> SparkSession:
    """Session for tests and the bench; a cluster passes its own master and conf."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.driver.memory", os.environ.get("LEXIFLOW_DRIVER_MEMORY", "16g"))
          .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
          .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024)))
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the
    one the SparkContext was given. Where neither is set, a local session (tests)
    gets a temporary folder; on a cluster that folder would not be shared, so
    that is an error."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="lexiflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def materialise(df):
    """Cut the lineage of a small shared intermediate: write it once to the
    shared checkpoint folder and read it back, so every consumer reads the same
    rows and a lost executor does not recompute the upstream scan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared folder (see ``ensure_checkpoint_dir``)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
