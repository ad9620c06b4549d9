"""Session construction and shared scratch locations.

Intermediate files (rendered fixtures, checkpoints, stream sinks) always go
below the folder named by ``spark.checkpoint.dir``; a cluster sets that to a
shared file system.  Only when the session has none (local tests) do we pick
a private temporary folder and register it as the checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "sparkfold", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session (set one only if unset)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="sparkfold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder URI under the session's checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/sparkfold/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder as compressed columns, and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, uri: str) -> bool:
    """Whether a Hadoop-FS path exists; errors other than absence are raised."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path))


def remove_path(spark: SparkSession, uri: str) -> None:
    """Delete a file or a folder with all it holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def is_directory(spark: SparkSession, uri: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory())


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme so Python code can open a local-mode path."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sparkfold`` importable in Python workers (the ``--py-files``
    mechanism): zip the package once per SparkContext and ``addPyFile`` it."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    if "sparkfold" in (sc.getConf().get("spark.submit.pyFiles", "") or ""):
        _SHIPPED.add(key)           # deployed with --py-files: executors already have it
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="sparkfold-pyfiles-")
    zpath = os.path.join(out_dir, "sparkfold.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)
