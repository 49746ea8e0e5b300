"""Helpers shared by the corpus operators: tables in the shared folder, Arrow maps, grouped streams."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import shared_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application, so that workers can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tillroll-src-"), "tillroll_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(d, f), os.path.relpath(os.path.join(d, f), os.path.dirname(root)))
    sc.addPyFile(path)  # Spark's file server hands it to every executor
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to a table of its own in the shared folder and read it back.

    This cuts the lineage (a lost executor costs a re-read, not a re-run) and
    pins values such as row ids.  The shuffle files of the write are dropped
    when it is done, as nothing reads them again.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path, partitionBy=partition_by)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path  # for discard()
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by :func:`staged`, once nothing that is still to run reads them."""
    for t in tables:
        spark = t.sparkSession
        jpath = spark._jvm.org.apache.hadoop.fs.Path(t._staged_at)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def append_arrow(df: DataFrame, fields: str, make: Callable[[], Callable[[pa.RecordBatch], list]]) -> DataFrame:
    """``df`` with the columns of the DDL ``fields`` appended, computed batch by batch.

    ``make`` runs once per task and returns a function from a record batch to
    one list (or Arrow array) per field; the other columns pass through as
    Arrow data without being turned into Python objects.
    """
    new = T._parse_datatype_string(fields)
    schema = T.StructType([*df.schema.fields, *new.fields])
    types = [pa_type(f.dataType) for f in new.fields]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in batches:
            if b.num_rows:
                cols = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(fn(b), types)]
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=names)

    return map_arrow(df, run, schema)


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def pa_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


_STATE: dict = {}


def worker_state(key, build: Callable):
    """What a worker keeps between tasks: one operator's state at a time, so that the stages of a pipeline don't add up."""
    if key not in _STATE:
        if _STATE:
            _STATE.clear()
            give_back()
        _STATE[key] = build()
    return _STATE[key]


def give_back() -> None:
    """Returns freed memory to the system: a worker lives on, and the next stage's counts against the same limit."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def utf8_list(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` from batches sorted by it, one table a run.

    Holds one run at a time: callers bound the size of a run beforehand.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        edges = [0, *cuts.tolist(), b.num_rows]
        for s, e in zip(edges, edges[1:]):
            if held and k[s] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(s, e - s))
            last = k[s]
    if held:
        yield pa.Table.from_batches(held)


def spanning_edges(adj: np.ndarray) -> tuple[list[int], list[int]]:
    """Tree edges of each component of a boolean adjacency matrix: at most n - 1 in place of all linked pairs."""
    n = len(adj)
    unseen = np.ones(n, bool)
    a: list[int] = []
    b: list[int] = []
    for root in range(n):
        if not unseen[root]:
            continue
        unseen[root] = False
        stack = [root]
        while stack:
            u = stack.pop()
            new = np.flatnonzero(adj[u] & unseen)
            if len(new):
                unseen[new] = False
                found = new.tolist()
                a.extend([u] * len(found))
                b.extend(found)
                stack.extend(found)
    return a, b


def block_pairs(members: DataFrame, key: list[str], block: int, salt: str) -> DataFrame:
    """Members of every key with two rows or more, dealt to block pairs.

    A key of up to ``block`` members is one work unit.  A larger one is cut
    into blocks by a hash of ``salt`` and each pair of blocks is a unit of its
    own, so any two members meet in some unit and no task holds a hot key.
    Adds ``_unit`` (a hash of key and block pair; units that happen to collide
    are merely compared together), ``_own`` (the row's block) and ``_cross``
    (the unit is of two different blocks; pairs within one of them meet in
    that block's own unit).
    """
    sizes = members.groupBy(*key).count().filter("count > 1").withColumnRenamed("count", "_n")
    m = members.join(sizes, key)
    blocks = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(F.lit("block"), F.col(salt)), blocks.cast("bigint")).cast("int")
    m = m.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    m = m.withColumn("_unit", F.xxhash64(*key, F.least("_own", "_other"), F.greatest("_own", "_other")))
    return m.withColumn("_cross", F.col("_own") != F.col("_other")).drop("_n", "_other")


def by_unit(df: DataFrame) -> DataFrame:
    """Rows of a unit side by side in one partition, for :func:`grouped`."""
    return df.repartition(F.col("_unit")).sortWithinPartitions("_unit")
