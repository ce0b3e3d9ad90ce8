"""Spark session helpers.

Cluster settings win: anything already configured on the session
(``spark.checkpoint.dir`` in particular) is read, never overwritten.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Per-session stages are compute-heavy on few bytes (a session's bar array
    # feeds thousands of parameter combinations): let AQE keep small shuffles
    # spread over the cluster's parallelism instead of merging them to 1 MB.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Sessions are small groups; 128 MB splits keep scan tasks short.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "barlab") -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master``/``shuffle_partitions`` are only applied when given (tests and
    the bench); on a cluster the submitter's settings are used as they are.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("BARLAB_DRIVER_MEM", "16g"))
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


@contextlib.contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streaming queries started inside keep their state in RocksDB, which state
    variables need; the session's own setting is as before afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3) folder and
    is used unchanged.  Only local test sessions get a fresh temp folder; on a
    cluster without the setting this fails, as executors don't share ``/tmp``.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        cur = spark.sparkContext.getCheckpointDir()
    if not cur:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        cur = tempfile.mkdtemp(prefix="barlab-ckpt-", dir="/tmp")  # one machine: tests and the bench
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(cur)
    return spark.sparkContext.getCheckpointDir() or cur


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/barlab/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clean_scratch(spark: SparkSession) -> None:
    """Remove what this application has written with :func:`scratch_dir`; call
    it when no result that reads from there is needed any more."""
    jvm, path = spark.sparkContext._jvm, _scratch_root(spark)
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder that was written is still there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def object_store_settings(endpoint: str, access_key: str, secret_key: str, *, path_style: bool = True,
                          ssl: bool | None = None, region: str | None = None) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings for an S3-compatible store.

    The scheme is stripped from ``endpoint`` (``http://host:9000`` ->
    ``host:9000``) and decides SSL unless ``ssl`` is given.  Pass the result to
    ``SparkSession.builder.config(map=...)``; credentials are the caller's.
    """
    scheme, _, host = endpoint.partition("://")
    if not host:
        scheme, host = "", endpoint
    use_ssl = (scheme == "https") if ssl is None else ssl
    conf = {
        "spark.hadoop.fs.s3a.endpoint": host.rstrip("/"),
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(bool(path_style)).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(bool(use_ssl)).lower(),
    }
    if region:
        conf["spark.hadoop.fs.s3a.endpoint.region"] = region
    return conf


_SHIPPED: set[str] = set()
_ZIP: list[str] = []


def ship_package(spark: SparkSession) -> None:
    """Make ``barlab`` importable by the Python workers of every executor.

    The per-session Python steps (``applyInPandas``, streaming state) pickle
    barlab functions by reference, so executors must be able to import the
    package.  It is zipped once per driver process and added with
    ``addPyFile`` once per application -- the same mechanism as
    ``spark-submit --py-files``."""
    import zipfile
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    if not _ZIP:
        root = os.path.dirname(os.path.abspath(__file__))
        fd, path = tempfile.mkstemp(prefix="barlab-pkg-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for dirpath, _, files in os.walk(root):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(dirpath, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        _ZIP.append(path)
    sc.addPyFile(_ZIP[0])
    _SHIPPED.add(sc.applicationId)
