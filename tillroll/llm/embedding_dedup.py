"""Embedding near-duplicates by Euclidean p-stable hashing with exact cosine checks.

Vectors are normalised and hashed in ``tables`` tables, each the
``projections`` quantised values ``floor((x . a + b) / width)`` of Gaussian
projections.  Of unit vectors with cosine 0.93 (Euclidean distance 0.374) the
default parameters bring 93 % together in some table, of closer ones more;
with cosine 0.98 over 99 %.  Every vector is hashed and every bucket is
compared whole, so nothing but that chance is lost.

The number of projections grows with the logarithm of the number of vectors, so
that a vector meets about as many strangers in a table whatever the size, and
the number of tables with it, so that the chance at the threshold stays.

Equal vectors of a label are one class with a multiplicity.  Large buckets are
cut into block pairs; a unit of work returns link counts and a spanning forest,
not pairs.  A pair that shares several buckets counts in the first table only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_arrow, block_pairs, by_unit, grouped, map_arrow, spanning_edges, staged
from .components import components

MIN_COSINE = 0.93
WIDTH = 2.0
#: Chance that one projection puts two unit vectors into one cell: at cosine 0.93, and at cosine 0.
NEAR, FAR = 0.851, 0.486
#: Projections of a table for up to so many vectors, and the chance to meet at cosine 0.93 that the tables are to give.
PROJECTIONS, FEW, RECALL = 10, 8192, 0.93
BLOCK = 512
SEED = 9


def _vector(values: list | None) -> np.ndarray | None:
    """The vector in double precision; None if it can't be compared."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    return x if np.isfinite(x).all() and x.any() else None


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max()  # no overflow or underflow in the norm
    return x / np.sqrt((x * x).sum())


def parameters(n: int) -> tuple[int, int]:
    """(tables, projections) for ``n`` vectors."""
    projections = PROJECTIONS + max(0, math.ceil(math.log(max(n, 1) / FEW) / -math.log(FAR)))
    return math.ceil(math.log(1 - RECALL) / math.log(1 - NEAR**projections)), projections


def hash_keys(x: np.ndarray, tables: int, projections: int, width: float = WIDTH, seed: int = SEED) -> np.ndarray:
    """Bucket keys of unit vectors (rows), one column a table; the projections depend on the dimension and seed only."""
    rng = np.random.default_rng([seed, x.shape[1]])
    a = rng.standard_normal((x.shape[1], tables * projections))
    b = rng.random(tables * projections) * width
    q = np.floor((x @ a + b) / width).astype(np.int64).reshape(len(x), tables, projections).astype(np.uint64)
    h = np.full((len(x), tables), x.shape[1], np.uint64)
    for i in range(projections):
        h = (h ^ q[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _prepare(df: DataFrame, tables: int, projections: int, width: float) -> DataFrame:
    """Adds the unit vector as bytes (null if it can't be compared) and its bucket keys."""

    def make():
        def fn(b):
            found = [_vector(v) for v in b.column("_vec").to_pylist()]
            raw: list[bytes | None] = [None] * len(found)
            keys: list[list[int] | None] = [None] * len(found)
            by_dim: dict[int, list[int]] = {}
            for i, x in enumerate(found):
                if x is not None:
                    by_dim.setdefault(len(x), []).append(i)
            for at in by_dim.values():
                u = np.stack([unit(found[i]) for i in at])
                for i, x, k in zip(at, u, hash_keys(u, tables, projections, width)):
                    raw[i], keys[i] = x.tobytes(), k.tolist()
            return [raw, keys]

        return fn

    return append_arrow(df, "_unit_vec binary, _keys array<bigint>", make).drop("_vec")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    min_cosine: float = MIN_COSINE,
    tables: int | None = None,
    projections: int | None = None,
    width: float = WIDTH,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Links join vectors of equal, non-null labels and equal dimension with
    cosine >= ``min_cosine``.  Vectors that are null, empty, zero or hold null
    or non-finite components have no link, are their own component and kept.
    n_links counts other rows, repeated ones too; component_id is the smallest
    id reached (null ids are not counted as smallest); kept is id =
    component_id (false for a null id in a component with an id, else true).
    Repeated rows each get a row; a very long vector is compared as any other;
    an empty table gives no rows.  Other columns are not read.
    """
    if tables is None or projections is None:
        tables, projections = parameters(vectors.count())
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vec_col).cast("array<double>").alias("_vec"))
    rows = staged(_prepare(rows, tables, projections, width), "vectors")
    able = F.col("_label").isNotNull() & F.col("_unit_vec").isNotNull()
    classes = rows.filter(able).groupBy("_label", "_unit_vec", "_keys").agg(F.min("_id").alias("low"), F.count("*").alias("n"))
    classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    members = classes.select("cid", "_label", F.posexplode("_keys").alias("t", "key"))
    members = members.select("cid", "t", F.xxhash64("_label", "t", "key").alias("bucket"))
    units = block_pairs(members, ["bucket", "t"], block, "cid").join(classes.select("cid", "_label", "_unit_vec", "_keys", "n"), "cid")
    found = staged(map_arrow(by_unit(units), _verify(min_cosine), "a bigint, b bigint, links bigint"), "vector-links")
    cc = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "cid")
    lows = cc.join(classes, "cid").groupBy("component").agg(F.min("low").alias("lowest"))
    counts = found.filter("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    result = classes.join(cc, "cid", "left").join(lows, "component", "left").join(counts, "cid", "left")
    result = result.select(
        "_label", "_unit_vec", (F.coalesce("links", F.lit(0).cast("bigint")) + F.col("n") - 1).alias("links"), F.coalesce("lowest", "low").alias("lowest")
    )
    # rows that can't be compared get a key of their own each, so that they don't meet in one task
    own = F.when(able, F.col("_unit_vec")).otherwise(F.encode(F.concat(F.lit("-"), F.xxhash64("_id").cast("string")), "utf-8"))
    out = rows.withColumn("_unit_vec", own).join(result, ["_label", "_unit_vec"], "left")
    component = F.coalesce("lowest", "_id")
    return out.select(
        F.col("_id").alias(id_col),
        F.coalesce("links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )


def _verify(min_cosine: float):
    def run(batches):
        for t in grouped(batches, "_unit"):
            if t.num_rows < 2:
                continue
            cid = t.column("cid").to_numpy()
            dims = np.array([len(b.as_py()) for b in t.column("_unit_vec")])
            size = dims.max()
            # other dimensions are another label; shorter vectors are padded
            x = np.stack([np.frombuffer(b.as_py().ljust(size, b"\0"), np.float64) for b in t.column("_unit_vec")])
            near = x @ x.T >= min_cosine
            table, bucket, own = (t.column(c).to_numpy() for c in ("t", "bucket", "_own"))
            label = t.column("_label").to_numpy(zero_copy_only=False)
            for same in (bucket, table, label, dims):
                near &= same[:, None] == same[None, :]
            cross = t.column("_cross").to_numpy(zero_copy_only=False)
            near &= cross[:, None] == cross[None, :]
            near &= ~cross[:, None] | (own[:, None] != own[None, :])
            np.fill_diagonal(near, False)
            i, j = np.nonzero(np.triu(near))
            if not len(i):
                continue
            keys = np.stack([np.array(k.as_py(), np.int64) for k in t.column("_keys")])
            for s in range(int(table.max())):  # only the first table in which two vectors meet counts
                near[i, j] &= (keys[i, s] != keys[j, s]) | (table[i] <= s)
            near &= np.triu(near)
            near |= near.T
            on = np.flatnonzero(near.any(1))
            if not len(on):
                continue
            links = near @ t.column("n").to_numpy()
            a, b = spanning_edges(near)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([cid[on], cid[a]])),
                    pa.array([None] * len(on) + cid[b].tolist(), pa.int64()),
                    pa.array(np.concatenate([links[on], np.zeros(len(a), np.int64)])),
                ],
                names=["a", "b", "links"],
            )

    return run
