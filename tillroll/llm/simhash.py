"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into ``segments`` equal parts.  Two fingerprints
that differ in at most ``max_bits`` bits differ in at most
``max_bits // segments`` bits of some part, so every fingerprint is indexed
under each of its parts and looked up under all keys of the Hamming ball of
that radius around each part; what meets under a key is verified on all 64
bits.  Of the two directions of a lookup only the one from the smaller to the
larger key is made.

Equal fingerprints are one class, so copies are never paired.  Keys with many
members are cut into block pairs (``common.block_pairs``); a unit of work
returns a spanning forest of its links, not the links, so a dense group yields
as many rows as it has members.  Components are the same either way.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import append_arrow, block_pairs, by_unit, grouped, map_arrow, spanning_edges, staged, utf8_list
from .components import components

SHINGLE = 3
MAX_BITS = 3
SEGMENTS = 2
BLOCK = 1024
SEED = 42
_CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text: bit set where over half of the shingle hashes have it; 0 for no words."""
    import xxhash

    h = xxhash.xxh64_intdigest
    ws = text.lower().split()
    if not ws:
        return 0
    if len(ws) < shingle:
        return h(b" ".join(ws), SEED)
    norm = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(ws) - shingle + 1
    a, b = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _CHUNK):
        hs = np.array([h(norm[s:e], SEED) for s, e in zip(a[k : k + _CHUNK], b[k : k + _CHUNK])], "<u8")
        ones += np.unpackbits(hs.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id_col, fp): the fingerprint of every whole text as a signed long; null texts have no words."""

    def make():
        def fn(b):
            fps = [fingerprint(t, shingle) for t in utf8_list(b.column("_text"))]
            return [pa.array(np.array(fps, np.uint64).view(np.int64))]

        return fn

    df = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return append_arrow(df, "fp bigint", make).select(id_col, "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of ``fps`` that join whatever is linked by at most ``max_bits`` bits."""
    if 64 % segments:
        raise ValueError("segments must divide 64")
    width, radius = 64 // segments, max_bits // segments
    # a fingerprint makes dozens of probes: dealt by their number, not by the bytes they start from, and by a hash of
    # their own, as Spark leaves out a second shuffle by the column that they are distinct in
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    part = lambda i: F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << width) - 1) if width < 64 else F.lit(-1))
    index = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), part(i).alias("key")) for i in range(segments)])).alias("_"))
    index = index.select("fp", "_.seg", "_.key")
    # (mask, its top bit): the key grows exactly where that bit is not set in it
    masks = [(sum(1 << j for j in js), 1 << max(js)) for r in range(1, radius + 1) for js in combinations(range(width), r)]
    members = index.withColumn("probe", F.lit(False))
    if masks:
        ball = F.filter(
            F.array(*[F.when(F.col("key").bitwiseAND(F.lit(top)) == 0, F.col("key").bitwiseXOR(F.lit(m))) for m, top in masks]),
            lambda k: k.isNotNull(),
        )
        probes = index.select("fp", "seg", F.explode(ball).alias("key"))
        hits = probes.join(index.select("seg", "key").distinct(), ["seg", "key"], "left_semi")
        members = members.unionByName(hits.select("fp", "seg", "key", F.lit(True).alias("probe")))
    members = staged(members, "mih")
    units = by_unit(block_pairs(members, ["seg", "key"], block, "fp").select("_unit", "fp", "probe"))

    def verify(batches):
        for t in grouped(batches, "_unit"):
            fp = t.column("fp").to_numpy().view(np.uint64)
            own = ~t.column("probe").to_numpy()
            if len(fp) < 2 or not own.any():
                continue
            near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= max_bits
            near &= own[:, None] | own[None, :]
            a, b = spanning_edges(near)
            if a:
                fp = fp.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

    return map_arrow(units, verify, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) for every row of ``docs``.

    component_id is the smallest id that links of at most ``max_bits`` bits
    reach.  Texts without words have fingerprint zero and are linked like any
    other.  Rows with a null id take part in linking but name no component: it
    is null only where all rows of a component lack an id.  Repeated rows each
    get a row.  A very long text is one fingerprint; an empty table gives no
    rows.  Other columns are not read.
    """
    sig = staged(signatures(docs, id_col, text_col, shingle).select(F.col(id_col).alias("_id"), "fp"), "simhash")
    out = sig.join(_linked(sig, max_bits, segments), "fp")
    return out.select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _linked(sig: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """(fp, component, component_id) of the fingerprints of ``sig`` (_id, fp): a fingerprint that names the component, its smallest id."""
    classes = sig.groupBy("fp").agg(F.min("_id").alias("low"))
    cc = components(links(classes.select("fp"), max_bits, segments)).withColumnsRenamed({"node": "fp"})
    linked = cc.join(classes, "fp").select("component", "fp", "low")
    lows = linked.groupBy("component").agg(F.min("low").alias("lowest"))
    linked = staged(linked.join(lows, "component").select("fp", "component", "lowest"), "linked")
    # staged, so that the join with the rows is one of two plain exchanges, of which a hot fingerprint's can be split
    by_fp = classes.join(linked, "fp", "left")
    return staged(by_fp.select("fp", F.coalesce("component", "fp").alias("component"), F.coalesce("lowest", "low").alias("component_id")), "components")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
) -> DataFrame:
    """One row of ``docs`` (all columns) per component: the least by id (nulls last), then text (nulls last).

    Rows that share an id with different texts, and rows without an id, count
    one by one.  Of rows equal in id and text one stays, the least by its
    other columns as JSON.  Null, empty and blank texts have fingerprint zero
    and are duplicates of each other; very long texts are read whole; a table
    without rows gives none.  Columns of any name pass through.
    """
    # two hashes of id and text stand for both; only these and the fingerprint are staged
    both = [F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col)]
    hashes = [F.xxhash64(*both).alias("_h1"), F.xxhash64(F.lit(1), *both).alias("_h2")]
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), *hashes).alias("_key"), F.col(text_col).alias("_text"))
    sig = signatures(keyed, "_key", "_text", shingle)
    sig = staged(sig.select(F.col("_key.id").alias("_id"), "_key._h1", "_key._h2", "fp"), "simhash")
    by_fp = _linked(sig.select("_id", "fp"), max_bits, segments)
    least = sig.join(by_fp, "fp").filter(F.col("_id").eqNullSafe(F.col("component_id")))
    least = staged(least.groupBy("component", "_h1", "_h2").agg(F.count("*").alias("copies")), "least")
    sizes = staged(least.groupBy("component").agg(F.count("*").alias("n"), F.min(F.struct("_h1", "_h2")).alias("m")), "least-sizes")
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), *hashes)
    winners = sizes.filter("n = 1").select("m._h1", "m._h2")
    if sizes.filter("n > 1").head(1):  # several texts of the least id: the least text
        tied = least.join(sizes.filter("n > 1"), "component", "left_semi").drop("copies")
        text = F.col(f"_doc.`{text_col}`")
        texts = rows.select(text.alias("text"), "_h1", "_h2").join(tied, ["_h1", "_h2"])
        first = texts.groupBy("component").agg(F.min(F.struct(F.col("text").isNull().alias("none"), "text", "_h1", "_h2")).alias("m"))
        winners = staged(winners.unionByName(first.select("m._h1", "m._h2")), "winners")
    if least.filter("copies > 1").head(1):
        rest = [F.col(f"_doc.`{c}`") for c in docs.columns if c not in (id_col, text_col)]
        order = F.to_json(F.struct(*rest)) if rest else F.col("_h1")
        # before the join, so that copies are reduced to one a task before they are dealt by key
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_h1", "_h2").orderBy(order))).filter("_n = 1")
    return rows.join(winners, ["_h1", "_h2"], "left_semi").select("_doc.*")
