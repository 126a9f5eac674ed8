"""Session set-up and the shared checkpoint folder.

On a cluster the session is built by the platform; ``get_session`` is for
local runs and tests.  ``checkpoint_root`` reads ``spark.checkpoint.dir``
from the session and only sets one when it is unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the engine relies on, applied only by ``get_session``.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming joins keep state per key/window; RocksDB spills it to disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A commit writes the batch's changes, not a full state snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str = "local[8]", app: str = "tandem",
                shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """Driver and executors are one process."""
    return master == "local" or master.startswith("local[")


_OWN_KEY = "tandem.checkpoint.dir"  # a plain session key: settable at run time


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    In order: ``spark.checkpoint.dir`` as the cluster names it; the folder
    the application gave ``SparkContext.setCheckpointDir``; a folder made
    by an earlier call.  Only a local master may go without: a fresh folder
    under /tmp is made and remembered in the session.  With any other master
    that would be a folder each machine has for itself, so it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_KEY, None)
    if not path:
        try:
            path = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext in a Connect client
            path = None
    if not path:
        master = spark.conf.get("spark.master", "")
        if not is_local(master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines share (master: {master!r})")
        path = tempfile.mkdtemp(prefix="tandem-ckpt-")
        spark.conf.set(_OWN_KEY, path)
        try:
            spark.sparkContext.setCheckpointDir(path)
        except Exception:
            pass
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    if "://" not in root:
        os.makedirs(root, exist_ok=True)
    return f"{root}{sep}{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of all executors.

    Functions that run in workers are pickled by reference to their module, so
    a driver that finds the package only through its own ``sys.path`` has to
    send it along.  The zip is made once per application and handed out by the
    driver's own file service (``addPyFile``).
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tandem-code-"), "tandem_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
