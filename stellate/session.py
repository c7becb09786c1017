"""Session construction and the shared scratch folder.

Lineage cuts and intermediate tables go under ``spark.checkpoint.dir``: on a
cluster that setting names a shared, fault-tolerant folder.  We read it from
the session and only fill it in ourselves when it is unset on a local master
(tests, laptops).
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings every stellate job wants; the caller may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "stellate", master: str | None = None,
                conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        pass
    return spark


_MB = 1 << 20


def sizing_conf(input_bytes: int, total_cores: int, *,
                target_partition_bytes: int = 256 * _MB) -> dict[str, str]:
    """Shuffle and scan sizing for a job over ``input_bytes`` of Parquet.

    Initial shuffle partitions are chosen so each holds about
    ``target_partition_bytes`` of input (at least two per core); AQE then
    coalesces small ones and splits skewed ones, aiming at the same size.  Scan splits use the same target, so a task's input fits
    comfortably in executor memory and spills cleanly when it does not.  For
    small inputs the floor of AQE coalescing is lowered (down to 256 KB) so
    every core still gets work; large inputs keep Spark's 1 MB floor.
    """
    by_size = -(-int(input_bytes) // target_partition_bytes)
    partitions = max(2 * total_cores, by_size)
    min_coalesced = max(256 << 10, min(_MB, int(input_bytes) // (16 * total_cores)))
    return {
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(min_coalesced),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes under the paths, by the file system that holds them (a metadata
    call); 0 for what doesn't exist or can't be asked for."""
    total = 0
    for path in paths:
        try:
            hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            total += fs.getContentSummary(hpath).getLength() if fs.exists(hpath) else 0
        except Exception:  # noqa: BLE001 - no local JVM gateway
            return 0
    return total


def size_session(spark: SparkSession, nbytes: int) -> None:
    """Give a running session the sizing of ``sizing_conf`` for an input of
    ``nbytes`` on the cores it has.  Settings the user made are kept."""
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in sizing_conf(nbytes, spark.sparkContext.defaultParallelism).items():
        if key not in given:
            spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, setting it up if needed.

    ``spark.checkpoint.dir`` wins (read through the session conf, so this
    also works on a Spark Connect session).  When nothing is configured we
    only invent a folder for a local master; a cluster must name a shared one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/object store) before running stellate jobs on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stellate-ckpt-"))
    return sc.getCheckpointDir()


_scopes = threading.local()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the checkpoint root for an intermediate
    table; recorded in the innermost open :func:`scratch_scope`."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{label}-{uuid.uuid4().hex[:12]}"
    for scope in getattr(_scopes, "stack", [])[-1:]:
        scope.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop FileSystem of its path (driver-side
    metadata call; works for local, HDFS and object-store paths).  Without a
    JVM handle (Spark Connect) the folder is left for the folder's own
    retention policy."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no local JVM gateway
        return
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(conf).delete(hpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, hpath = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    fs, hpath = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory())


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file as a whole."""
    fs, hpath = _file_system(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, content: bytes) -> bool:
    """Make a small file; False if there is one already."""
    fs, hpath = _file_system(spark, path)
    if fs.exists(hpath):
        return False
    try:
        stream = fs.create(hpath, False)
    except Exception as e:  # noqa: BLE001 - made by another driver since we looked
        if "already exists" in str(e) or "FileAlreadyExists" in str(e):
            return False
        raise
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    return True


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the intermediate tables made inside the block when it ends.

    Only for blocks whose results no longer read them (written tables,
    collected values): a DataFrame built on an intermediate must not
    outlive the scope.
    """
    stack = getattr(_scopes, "stack", None)
    if stack is None:
        stack = _scopes.stack = []
    paths: list[str] = []
    stack.append(paths)
    try:
        yield paths
    finally:
        stack.pop()
        for path in paths:
            remove_path(spark, path)
