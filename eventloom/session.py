"""Session construction and the shared scratch / checkpoint location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings of sessions that this package builds.
RUNTIME_CONF = {
    # Event times are stored as TIMESTAMP_NTZ; casts to TIMESTAMP (needed for
    # watermarks) must round-trip exactly, which only a zone without DST does.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast a join side only when its size is known, not estimated: lookups
    # are hinted after their files' size was read (joins.broadcast_if_small), and
    # AQE converts a join once the side's shuffle stage measured it small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # Merge session windows inside each map partition before the shuffle, so
    # a hot key ships sessions, not raw events.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Prepare a session that someone else built: only the time zone, on which
    results depend, is set; all else stays as its owner wants it."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    _ship_package(spark)
    return spark


_SHIPPED: set = set()


def _ship_package(spark: SparkSession) -> None:
    """Make the package importable by Python workers in local mode (UDFs and
    stateful functions reference it). On a cluster the package is deployed
    the usual way (``--py-files eventloom.zip`` or installed on executors),
    so nothing is written to a machine-local folder there."""
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.applicationId in _SHIPPED:
        return
    out = build_zip(os.path.join(tempfile.mkdtemp(prefix="eventloom-pyfiles-"), "eventloom.zip"))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def build_zip(out: str) -> str:
    """Zip the package for ``--py-files`` (``python -m eventloom out.zip``)."""
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    with zipfile.ZipFile(out, "w") as z:
        for d, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    return out


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "eventloom", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, build the session with
    the cluster's own settings and pass it to :func:`configure` instead."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
         # State of streaming aggregations and joins lives in RocksDB, which
         # spills to local disk instead of holding every key on the heap.
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset (local tests) a private temporary folder is made and
    registered, so lineage cuts and stream checkpoints always land in one
    place that every executor can read.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(checkpoints, topic folders and sink output go below it)")
        root = tempfile.mkdtemp(prefix="eventloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_RUN_ID = uuid.uuid4().hex[:12]


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the checkpoint root, unique to this process run."""
    root = _checkpoint_root(spark)
    return "/".join([root, "eventloom", f"run-{os.getpid()}-{_RUN_ID}", *parts])


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this process wrote below the checkpoint root for its own
    queries (one-off sinks, intermediate tables). Call it when their results
    have been read; checkpoints and derived folders that later runs reuse stay."""
    path, fs = _fs(spark, scratch_path(spark))
    fs.delete(path, True)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 128 << 20) -> dict:
    """Settings for a large cluster, to pass to the session builder.

    Scan splits and shuffle partitions aim at ``target_partition_bytes`` so a
    task's data fits executor memory; AQE coalesces small shuffle partitions
    and splits skewed ones from there. Streaming state keeps the partition
    count of its first run, so start a checkpoint with the final setting.
    """
    slots = executors * cores_per_executor
    parts = int(max(slots * 2, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **RUNTIME_CONF,
    }


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on any Hadoop file system (local, HDFS, object stores)."""
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def path_fingerprint(spark: SparkSession, path: str) -> str:
    """Hash of the path, length and time of every file below a path, for cache keys."""
    import hashlib
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return "missing"
    h, files = hashlib.sha1(), []
    it = fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        files.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    h.update("\n".join(sorted(files)).encode())
    return h.hexdigest()


def _code_hash() -> str:
    import hashlib
    h = hashlib.sha1()
    pkg = os.path.dirname(os.path.abspath(__file__))
    for d, _dirs, files in sorted(os.walk(pkg)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(d, f), "rb") as fh:
                    h.update(f.encode() + fh.read())
    return h.hexdigest()[:16]


_MEMO: dict = {}

# Reuse derived folders written by earlier runs (off in the benchmark, which
# must time their construction).
REUSE_DERIVED = True


def derived_path(spark: SparkSession, name: str, inputs: list, build) -> str:
    """A folder of data derived from ``inputs`` (paths), written once under
    the shared checkpoint root and reused by later runs and processes.

    The folder name is a hash of the inputs' sizes and times and of this
    package's code, so changed inputs or code give a new folder. A folder
    counts as present only with its marker file, which is written before the
    folder is moved into place.
    """
    import hashlib
    key = (spark.sparkContext.applicationId, name, tuple(inputs))
    if key in _MEMO:
        return _MEMO[key]
    parts = [name, _code_hash(), *[f"{i}={path_fingerprint(spark, i)}" for i in inputs]]
    digest = hashlib.sha1("|".join(parts).encode()).hexdigest()[:20]
    path = "/".join([_checkpoint_root(spark), "eventloom", "derived", f"{name}-{digest}"])
    if not REUSE_DERIVED:
        path = f"{path}-{_RUN_ID}"
    marker = "_EVENTLOOM_COMPLETE"
    if not path_exists(spark, f"{path}/{marker}"):
        # Build in a private staging folder and move it into place, so the
        # final folder only ever appears complete, even when several
        # processes build it at once (the first move wins).
        staging = f"{path}.staging-{uuid.uuid4().hex[:8]}"
        build(staging)
        m, fs = _fs(spark, f"{staging}/{marker}")
        fs.create(m, True).close()
        src, _ = _fs(spark, staging)
        dst, _ = _fs(spark, path)
        if fs.exists(dst) or not fs.rename(src, dst):
            fs.delete(src, True)
        if not fs.exists(dst.suffix("/" + marker)):
            raise RuntimeError(f"derived folder {path} is incomplete")
    _MEMO[key] = path
    return path
