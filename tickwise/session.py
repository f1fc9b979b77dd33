"""Session construction and the shared working folder.

Every job in this package is a plain DataFrame program; the only session
settings it depends on are the UTC session time zone (tick text is produced
from TIMESTAMP_NTZ columns) and ANSI mode being on (Spark 4 default), which is
why all divisions go through ``try_divide``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tickwise", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster pass ``master=None`` and size ``shuffle_partitions`` to the
    data (about 128-256 MB of shuffle output per partition); AQE coalesces
    small ones at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # getOrCreate on an existing session ignores builder options: re-apply
    # the SQL ones, which are session-scoped and safe to set at run time.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Lineage cuts, stream checkpoints and intermediate tables go there, never to
    a machine-local temp folder. Only when the setting is absent and the master
    is ``local`` (unit tests, ad-hoc runs) a private folder is created and
    registered; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    d = sc.getCheckpointDir()
    if d:
        # set through setCheckpointDir: that path is <dir>/<app uuid>
        return d.rstrip("/")
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    d = tempfile.mkdtemp(prefix="tickwise-ckpt-")
    sc.setCheckpointDir(d)
    return d


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (for one run of a job)."""
    base = shared_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}tickwise/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few pandas/os helpers used in tests."""
    return path[5:] if path.startswith("file:") else path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tickwise`` importable by the Python workers (as ``--py-files``
    does): zip the package into the shared folder once per application and
    register it with ``addPyFile``.  Needed by the operators that run Python
    on executors (the keyed-state count window, payload delivery).  When the
    shared folder is a remote file system the package must be installed on
    the cluster instead."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    base = shared_dir(spark)
    if "://" in base and not base.startswith("file:"):
        _SHIPPED.add(app)
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(local_path(base), "tickwise-py", f"tickwise-{uuid.uuid4().hex[:12]}.zip")
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("tickwise", os.path.relpath(full, pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(app)


class session_settings:
    """Context manager: session settings inside, the old ones after.  A
    streaming query copies the settings when it starts, so wrapping ``start()``
    fixes them for that query without touching the caller's session."""

    def __init__(self, spark: SparkSession, settings: dict[str, str]):
        self.spark, self.settings, self.old = spark, settings, {}

    def __enter__(self):
        for k, v in self.settings.items():
            self.old[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def keyed_state(spark: SparkSession, partitions: int | None = None) -> session_settings:
    """Settings a query with keyed state is started with: the RocksDB state
    store, and ``partitions`` state store partitions where given (kept in the
    checkpoint, so they stay as they are on later starts)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    settings = {key: DEFAULT_CONF[key]}
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(int(partitions))
    return session_settings(spark, settings)
