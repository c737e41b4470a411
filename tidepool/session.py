"""Session helpers: a tuned local session for tests/bench, and the shared folder.

On a cluster the session is created by the platform; library code never
builds one.  It only reads ``spark.checkpoint.dir`` to find the shared folder
for checkpoints, replay tables and streaming state, and sets its own folder
only when none is configured (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every session used by this library should carry.  All are plain
# Spark SQL options; nothing here is engine internals.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Times are compared with an SQL oracle; keep them zone-free.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidepool") -> SparkSession:
    """Session for tests and the bench: local mode, UI off, AQE on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def apply_recommended_conf(spark: SparkSession) -> None:
    """Set the library's session options on an existing session (idempotent)
    and make the package importable by the Python workers."""
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors' Python workers
    (``addPyFile`` of a zip), once per SparkContext.  Pandas-UDF stages and
    stateful stream operators unpickle functions defined here, so workers
    must be able to import it.  Not needed where the package is installed
    on the cluster's Python.  The zip is code, built on the driver and
    shipped by Spark's file server."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tidepool-code-"), "tidepool.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Reads the setting from the session.  Only when it is unset in a local run
    (tests) a fresh folder is registered with the context; on a cluster an
    unset folder is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            conf_dir = jdir.get()
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tidepool-ckpt-")
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def materialize(df):
    """Compute ``df`` once and cut its lineage (reliable ``checkpoint()``
    into the shared checkpoint folder).  For an intermediate that several
    branches of a plan read -- recomputing it would repeat its shuffles."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique path under the shared folder (never reused, never cleared)."""
    base = shared_dir(spark)
    if "://" not in base:
        os.makedirs(base, exist_ok=True)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
