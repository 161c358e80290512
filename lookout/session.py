"""Session helpers: building a local session for tests and benches, and
finding the shared work folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings for a large cluster (100 TB scale); the session builder of the
# cluster owns them -- listed here so a deployment can apply them.
LARGE_CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def default_driver_memory(cap_gb: int = 8) -> str:
    """Heap for a local (single-JVM) session: 60 % of physical memory, at
    most ``cap_gb`` -- so a small container does not get a heap larger
    than itself."""
    try:
        pages, page = os.sysconf("SC_PHYS_PAGES"), os.sysconf("SC_PAGE_SIZE")
        total_gb = pages * page / 1024**3
    except (ValueError, OSError, AttributeError):
        return f"{cap_gb}g"
    return f"{max(1, min(cap_gb, int(total_gb * 0.6)))}g"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "lookout") -> SparkSession:
    """A local session as the tests and the bench use it (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", default_driver_memory())
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only when the
    session has none (local tests). On a cluster the setting comes from the
    cluster configuration and points at shared storage."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # A Spark Connect client may not see the master: not taken for a local one.
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="lookout-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors as a zip, once per session, so that
    Python code there imports it wherever the driver was started."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if getattr(sc or spark, "_lookout_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="lookout-pkg-"), "lookout.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    if sc is not None:
        sc.addPyFile(archive)
        sc._lookout_shipped = True
    else:
        spark.addArtifacts(archive, pyfile=True)
        spark._lookout_shipped = True


def prepare(spark: SparkSession) -> None:
    """What every job needs: the shared folder, and the package on executors."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def prepare_active() -> None:
    """:func:`prepare` for the active session, where a function that makes a
    Python UDF is given none (without a session there is nothing to send to)."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        prepare(spark)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Inside, the session has these settings; afterwards it has its own again."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables
    (round trips, sinks, stream checkpoints). Never a machine-local temp dir
    on a cluster: the parent is ``spark.checkpoint.dir``."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/lookout-work/{name}-{uuid.uuid4().hex[:12]}"


def local_fs_path(path: str) -> str | None:
    """Path on the local file system for a ``file:`` URI or plain path, else None."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
        return path
    if "://" in path:
        return None
    return os.path.abspath(path)
