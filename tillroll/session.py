"""Spark session and shared-folder helpers.

The warehouse, dimension key checkpoints and streaming checkpoints all live
under the folder named by ``spark.checkpoint.dir``: on a cluster that is the
shared file system every executor can reach.  A folder of our own is made
only where the session leaves the setting empty (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tillroll") -> SparkSession:
    """Session for tests and the bench: local mode, AQE on, UTC, no UI."""
    builder = SparkSession.builder
    event_dir = os.environ.get("TILLROLL_EVENT_LOG_DIR")
    if event_dir:  # stage/task timings without the UI
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder; sets the context checkpoint dir if unset."""
    sc = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, base)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_dir(spark), *parts])


def fs_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through Hadoop FileSystem, so it works on HDFS / object stores."""
    jvm = spark._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def fs_mkdirs(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jpath)


def fs_delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder; no error where there is none."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def fs_write_text(spark: SparkSession, path: str, text: str) -> None:
    jvm = spark._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def code_version() -> str:
    """Hash of this package's source, so a stored build from other code is not reused."""
    import hashlib

    root = os.path.dirname(os.path.abspath(__file__))
    h = hashlib.sha1()
    for dirpath, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(dirpath, f), "rb") as fh:
                    h.update(f.encode() + fh.read())
    return h.hexdigest()[:8]


def fs_read_text(spark: SparkSession, path: str) -> str:
    jvm = spark._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.open(jpath)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def input_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Identity of a set of inputs (leaf files with sizes and modification times) and of the code.

    Asked of the file system that holds them, so that remote and edited
    inputs are told apart like local files.
    """
    import hashlib

    h = hashlib.sha1(code_version().encode())
    for path in sorted(paths):
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
        h.update(path.rsplit("/", 1)[-1].encode())
        if not fs.exists(jpath):
            continue
        files = fs.listFiles(jpath, True)
        found = []
        while files.hasNext():
            st = files.next()
            found.append(f"{st.getPath().toUri().getPath()}|{st.getLen()}|{st.getModificationTime()}")
        h.update("\n".join(sorted(found)).encode())
    return h.hexdigest()[:16]
