"""Surrogate keys, and the size of what they are looked up in.

``dense_keys`` numbers rows 1..n in the order of a total sort key, like
``row_number() OVER (ORDER BY k)`` -- but without the single-partition window
Spark would plan for that.  Rows are range-partitioned and sorted, each row
gets (partition id, position), and the frame is checkpointed so both are
fixed even if a stage is recomputed.  A tiny table of per-partition counts
(one row per partition, so its size is bounded by the partition count, not
the data) turns positions into global offsets through a broadcast join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import shared_dir

_PART, _POS = "_key_part", "_key_pos"

#: Rows of a side of a join that Spark may broadcast: about 60 MB as a hash table of ids.
BROADCAST_ROWS = 500_000


def by_rows(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` as a side of a join: of more than ``BROADCAST_ROWS`` rows it is dealt by the key, whatever its files' size.

    Spark goes by the bytes of files, and a row of ids that takes four there takes
    120 in the hash table that the driver and every executor hold of a broadcast.
    ``rows``, the number or a bound of it, is counted where it is not known; no more are read for that
    than it takes to tell.
    """
    if rows is None:
        rows = df.limit(BROADCAST_ROWS + 1).count()
    return df.hint("merge") if rows > BROADCAST_ROWS else df


def dense_keys(
    df: DataFrame,
    order_cols: list[str],
    sk_col: str,
    start: int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``sk_col`` = start + 1 + rank of the row under ``order_cols``.

    ``order_cols`` must be unique over ``df`` (dimension natural keys are),
    otherwise ties are numbered in an arbitrary but fixed order.  The same way
    is taken for every number of rows.
    """
    shared_dir(df.sparkSession)  # checkpoints go to the shared folder
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"), F.min(_POS).alias("_first"))
    # One row per partition: the window below sees at most n rows.
    offsets = counts.select(
        _PART,
        "_first",
        F.coalesce(
            F.sum("_n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_before"),
    )
    keyed = placed.join(F.broadcast(offsets), _PART).withColumn(
        sk_col,
        (F.lit(start) + F.col("_before") + (F.col(_POS) - F.col("_first")) + 1).cast("bigint"),
    )
    return keyed.drop(_PART, _POS, "_before", "_first")


def lookup_keys(df: DataFrame, dim: DataFrame, natural: str, sk: str, how: str = "inner") -> DataFrame:
    """Natural key -> surrogate key by equi-join on the natural key."""
    return df.join(dim.select(natural, sk), natural, how)
