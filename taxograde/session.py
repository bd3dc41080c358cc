"""Session creation and shared scratch locations.

Intermediate tables (exports, checkpoints, caches written by tests and by the
registered queries) go under the folder the cluster names in
``spark.checkpoint.dir``. That folder is shared by all executors on a real
cluster; a machine-local temporary folder is only chosen when the setting is
absent, which happens in local test sessions.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that keep the plans adaptive and skew-aware at any scale.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A technology called "0017" must stay a string when read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # An external inference call must not be duplicated by speculation.
    "spark.speculation": "false",
}


def get_session(master: str | None = None, app: str = "taxograde",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()  # application ids


def ship_package(spark: SparkSession) -> None:
    """Make ``taxograde`` importable in Python workers (pandas UDFs, mapInPandas).

    The package is zipped once per SparkContext into the shared checkpoint
    folder and registered with ``addPyFile``, so executors on other machines
    import the same code as the driver.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    target = shared_path(spark, "pyfiles") + "/taxograde.zip"
    write_bytes(spark, target, buf.getvalue())
    sc.addPyFile(target if _is_remote(target) else local_path(target))
    _SHIPPED.add(sc.applicationId)


def _is_remote(path: str) -> bool:
    return "://" in path and not path.startswith("file:")


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write one small file to ``path`` on whatever filesystem holds it.

    Local paths are written directly; any other scheme (HDFS, object stores)
    goes through the Hadoop FileSystem of the session, so the shared folder
    named by ``spark.checkpoint.dir`` works the same on a cluster.
    """
    if not _is_remote(path):
        local = local_path(path)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "wb") as f:
            f.write(data)
        return
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="taxograde-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder (fresh when ``unique``)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex)
    return "/".join([base, "taxograde", *tail])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever filesystem holds it (Hadoop API)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly under ``path``; none where it does not exist."""
    if not path_exists(spark, path):
        return []
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hpath)
    return [f.getPath().getName() for f in found]


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own, on whatever filesystem holds it."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access in local mode."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
