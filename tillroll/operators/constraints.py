"""D5 on write: keys of a batch that is to be loaded, against the keys that are stored.

Every batch leaves a Bloom filter of its keys: 64-bit words, about four keys to
a word, each key five bits of one word.  Keys on offer look up one word per
filter size; a word that lacks one of their bits proves that no batch of that
size holds them.  Only what passes is joined exactly, with the partitions of the
batches that it may be in.  So a load without violations reads the filters,
two bytes a stored key, and no stored row.

``note_keys`` is a ``maintain`` function of a load; ``check_load`` the report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.schemas import DIMENSIONS
from tillroll.session import shared_dir
from tillroll.warehouse import Done, Warehouse

KEYS_PER_WORD = 4
BITS_PER_KEY = 5
SALE = "sales_fact.sale_id"


def kinds() -> dict[str, tuple[str, str]]:
    """Name of a key -> (table, column)."""
    out = {SALE: ("sales_fact", "sale_id")}
    for table, (_, natural, sk) in DIMENSIONS.items():
        out[f"{table}.{sk}"], out[f"{table}.{natural}"] = (table, sk), (table, natural)
    return out


def _keys(rows: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """(kind, key) of the named keys, null ones left out."""
    parts = []
    for name in names:
        table, column = kinds()[name]
        if table in rows:
            parts.append(rows[table].where(F.col(column).isNotNull()).select(F.lit(name).alias("kind"), F.col(column).cast("string").alias("key")))
    return reduce(DataFrame.unionByName, parts)


def _mask() -> Column:
    bits = [F.expr(f"shiftleft(1L, cast(pmod(shiftrightunsigned(_h, {6 * i}), 64) as int))") for i in range(BITS_PER_KEY)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _placed(keys: DataFrame, words: Column) -> DataFrame:
    """``keys`` with the word and the bits that stand for them in a filter of 2**``words`` words."""
    slot = F.pmod(F.xxhash64("key", F.lit("word")), F.pow(F.lit(2.0), words).cast("bigint"))
    return keys.withColumn("slot", slot).withColumn("_h", F.xxhash64("key", F.lit("bits"))).withColumn("mask", _mask()).drop("_h")


def note_keys(wh: Warehouse, batch_id: int) -> None:
    """Writes the filters of a batch's keys."""
    rows = {t: wh.read_batch(t, batch_id) for t in ("sales_fact", *DIMENSIONS)}
    keys = _keys(rows, list(kinds()))
    counts = keys.groupBy("kind").agg(F.count(F.lit(1)).alias("_n"))
    sizes = counts.select("kind", F.greatest(F.lit(0), F.ceil(F.log2(F.col("_n") / F.lit(KEYS_PER_WORD)))).cast("int").alias("words"))
    placed = _placed(keys.join(F.broadcast(sizes), "kind"), F.col("words"))  # a row a kind
    wh.write("key_filters", placed.groupBy("kind", "words", "slot").agg(F.bit_or("mask").alias("bits")), batch_id)


def candidates(wh: Warehouse, keys: DataFrame, done: Done) -> DataFrame:
    """(kind, key, batch_id): earlier batches that may hold a key; no batch that holds it is missing."""
    filters = wh.read("key_filters", done=done)
    sizes = filters.select("kind", "words").distinct()  # at most 62 sizes of a kind
    probes = _placed(keys.select("kind", "key").distinct().join(F.broadcast(sizes), "kind"), F.col("words"))
    met = probes.join(filters, ["kind", "words", "slot"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    return met.select("kind", "key", "batch_id")


def stored(wh: Warehouse, keys: DataFrame, done: Done) -> DataFrame:
    """(kind, key) of the keys that earlier batches hold: candidates joined exactly, in the partitions they may be in."""
    shared_dir(wh.spark)  # checkpoints go to the shared folder
    may = candidates(wh, keys, done).checkpoint()  # the filters are looked up once, not once a kind
    parts = []
    for name, (table, column) in kinds().items():
        own = may.where(F.col("kind") == name).select("kind", F.col("key").alias("_k"), F.col("batch_id").alias("_b"))
        rows = wh.read(table, done=done).select(F.col(column).cast("string").alias("key"), "batch_id")
        parts.append(own.join(rows, (own["_k"] == rows["key"]) & (own["_b"] == rows["batch_id"]), "left_semi").select("kind", F.col("_k").alias("key")))
    return reduce(DataFrame.unionByName, parts).distinct()


def check_load(wh: Warehouse, rows: dict[str, DataFrame], batch_id: int) -> DataFrame:
    """(check_name, violations) for rows on offer as batch ``batch_id``: a dict of fact and dimension rows.

    Unique keys: rows whose key is on another row on offer or is stored.
    References: fact rows whose key neither the dimension rows on offer nor the
    stored ones have.  Null keys refer to nothing and violate nothing.
    """
    done = wh.done(before_batch=batch_id)
    unique = [n for n, (t, _) in kinds().items() if t in rows]
    counts = _keys(rows, unique).groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))
    refs = {f"{t}.{sk}": sk for t, (_, _, sk) in DIMENSIONS.items()} if "sales_fact" in rows else {}
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(sk).cast("string").alias("key")) for n, sk in refs.items()])) if refs else None
    none = counts.where("false")
    used = rows["sales_fact"].select(each.alias("r")).select("r.*").where("key IS NOT NULL").groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n")) if refs else none
    known = stored(wh, counts.select("kind", "key").unionByName(used.select("kind", "key")), done)
    twice = counts.join(known.withColumn("_old", F.lit(True)), ["kind", "key"], "left").where((F.col("n") > 1) | F.col("_old"))
    own = counts.select("kind", "key")
    lost = used.join(known.unionByName(own), ["kind", "key"], "left_anti")
    reported = twice.select(F.concat("kind", F.lit(" unique")).alias("check_name"), "n").unionByName(
        lost.select(F.concat(F.lit("sales_fact references "), F.col("kind")).alias("check_name"), "n")
    )
    zeros = [f"{n} unique" for n in unique] + [f"sales_fact references {n}" for n in refs]
    base = reported.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, zeros))).alias("check_name")).withColumn("n", F.lit(0).cast("bigint"))
    return reported.unionByName(base).groupBy("check_name").agg(F.sum("n").alias("violations"))
