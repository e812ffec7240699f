"""Session helpers: UTC time zone and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_utc(spark: SparkSession) -> None:
    """All epoch conversions in this library assume the session time zone is UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


_LOCAL_CKPT: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared file system) and only
    read here. When it is unset (local runs and tests) a scratch folder is
    created once per application and registered with ``setCheckpointDir``.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store): "
                           "executors must read what the driver's jobs write there")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_CKPT:
        _LOCAL_CKPT[app] = tempfile.mkdtemp(prefix="pricestream-ckpt-")
        spark.sparkContext.setCheckpointDir(_LOCAL_CKPT[app])
    return _LOCAL_CKPT[app]


def build_session(master: str | None = None, app: str = "pricestream",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the library is tuned for (tests and bench)."""
    master = master or os.environ.get("PRICESTREAM_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("PRICESTREAM_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        # keyed streaming state (one row per product) lives off-heap in RocksDB
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.driver.memory", os.environ.get("PRICESTREAM_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared checkpoint folder and
    return a scan of it: lineage is cut, every later reader shares one
    computation, and the files survive the loss of executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/pricestream-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    if getattr(_TEMPORARY, "paths", None) is not None:
        _TEMPORARY.paths.append(path)
    return spark.read.parquet(path)


_TEMPORARY = threading.local()


@contextlib.contextmanager
def collected_tables():
    """The paths of the tables that ``materialize`` writes inside, in this thread."""
    outer, _TEMPORARY.paths = getattr(_TEMPORARY, "paths", None), []
    try:
        yield _TEMPORARY.paths
    finally:
        _TEMPORARY.paths = outer


@contextlib.contextmanager
def temporary_tables(spark: SparkSession):
    """Tables that ``materialize`` writes inside are deleted at the end (a job that runs for
    months must not fill the shared folder)."""
    with collected_tables() as paths:
        try:
            yield
        finally:
            for path in paths:
                delete_path(spark, path)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark reads."""
    fs, p = _path(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it is not there)."""
    fs, p = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder of this library's own (an old state version, an intermediate table)."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pricestream`` importable in Python workers (needed only by the
    grouped-map state function): zip the package once and ``addPyFile`` it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="pricestream-pkg-"), "pricestream")
    archive = shutil.make_archive(base, "zip", root_dir=os.path.dirname(pkg), base_dir="pricestream")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
