"""Session helpers: build a local session for tests/bench and resolve the shared
checkpoint folder from the session (never a machine-local temp dir on a cluster)."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "panelcast") -> SparkSession:
    """A local-mode session configured the way the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PANELCAST_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name it: a machine-local folder there would be a different folder on every executor, so an unset
    name is an error unless the master is local, where a temporary folder is set.
    """
    current = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if not current:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^-]*\])?", master):
            raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that all executors share (master is {master})")
        current = tempfile.mkdtemp(prefix="panelcast-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written intermediate tables)."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the Python workers (``addPyFile`` of a zip),
    so Arrow-batched tasks can import it wherever the driver was started."""
    import shutil

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="panelcast-pkg-")  # driver-side staging; Spark ships the file
    archive = shutil.make_archive(
        os.path.join(out_dir, "panelcast"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir="panelcast"
    )
    sc.addPyFile(archive)
    _SHIPPED.add(key)
