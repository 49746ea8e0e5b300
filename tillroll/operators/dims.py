"""Dimension maintenance, insert-if-absent.

A batch reads the rows stored by *earlier* batches, anti-joins its candidates
against them (first write wins: stored rows are never refreshed), numbers the
new ids after the largest earlier key, and writes them as its own partition.
Running the batch again reproduces the same rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.keys import by_rows, dense_keys
from tillroll.schemas import CUSTOMER_ATTRS, DIMENSIONS, PRODUCT_ATTRS
from tillroll.warehouse import Done, Warehouse


def _seen(master: DataFrame, matched: DataFrame, key: str, attrs: list[str], lines: int) -> DataFrame:
    """Master rows of the ids the batch matched (semi join: the batch's
    distinct ids are the small side).  A matched row carries exactly its
    master row's attributes, so this equals projecting the matched rows."""
    ids = matched.where(F.col(key).isNotNull()).select(key).distinct()
    return master.select(*attrs).join(by_rows(ids, lines), key, "left_semi").dropDuplicates([key])


def seen_customers(matched: DataFrame, customers: DataFrame, lines: int = 0) -> DataFrame:
    """Customers of the batch's matched rows, attributes from the master."""
    return _seen(customers, matched, "customer_id", CUSTOMER_ATTRS, lines)


def seen_products(matched: DataFrame, products: DataFrame, lines: int = 0) -> DataFrame:
    return _seen(products, matched, "product_id", PRODUCT_ATTRS, lines)


def _named_entity(products: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """A store / supplier id seen with several names takes the name of its
    smallest product_id -- arrival order is not stable on a cluster."""
    return (
        products.where(F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(F.min_by(F.col(name_col), F.col("product_id")).alias(name_col))
    )


def date_candidates(matched: DataFrame) -> DataFrame:
    """Only dates seen in matched transactions, not a calendar."""
    d = matched.where(F.col("date").isNotNull()).select("date").distinct()
    return d.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
    )


# Reference order of the upserts inside a batch.
UPSERT_ORDER = ["customer_dim", "store_dim", "supplier_dim", "product_dim", "date_dim"]


def new_members(candidates: DataFrame, existing: DataFrame, natural: str, few: bool = True, stored: int = 0, lines: int = 0) -> DataFrame:
    """Ids already stored are skipped; their attributes are not refreshed.

    The stored dimension is probed with the batch's ids (semi join: the ids
    are the small side, broadcast by the threshold or by AQE), so a large
    dimension is scanned but not shuffled for every batch.  Where the ids are not
    ``few`` beside the stored ones, they would be moved for that once more than
    the anti join moves them.  ``stored`` members and ``lines`` of the batch bound
    what is joined, 0 if that is not known.
    """
    known, most = existing.select(natural), stored
    if few:
        most = min(lines, stored)
        known = known.join(by_rows(candidates.select(natural), most), natural, "left_semi")
    return candidates.join(by_rows(known, most), natural, "left_anti")


def assign_new_keys(new: DataFrame, start: int, natural: str, sk: str) -> DataFrame:
    """New ids get max(stored key) + rank of the id among the new ones."""
    return dense_keys(new, [natural], sk, start=int(start))


def upsert_dimension(
    wh: Warehouse, table: str, candidates: DataFrame, batch_id: int, done: Done, ids: DataFrame, lines: int = 0
) -> tuple[DataFrame, int]:
    """Insert-if-absent for one batch; ``done`` are the batches before it.

    Returns the key map (natural key, surrogate key) of this batch's members
    only -- read back from storage, so it holds exactly the written keys --
    which keeps the fact's key lookups batch-sized, and the largest key given
    out so far.  A batch of more ``lines`` than there are stored members gets
    the map of all members, which is smaller than the batch as it is.  A map of
    many members is dealt in its look-ups, not broadcast.
    """
    _, natural, sk = DIMENSIONS[table]
    start = done.max_keys.get(table, 0)
    few = lines <= start
    earlier = wh.read(table, done=done)
    new = new_members(candidates, earlier, natural, few, start, lines) if start else candidates
    wh.write(table, assign_new_keys(new, start, natural, sk), batch_id)
    own = wh.read_batch(table, batch_id)
    top = int(own.agg(F.max(sk)).first()[0] or start)  # one scalar
    stored = earlier.select(natural, sk).unionByName(own.select(natural, sk)) if start else own.select(natural, sk)
    if few:
        stored = stored.join(by_rows(ids, lines), natural, "left_semi")
    return by_rows(stored, min(top, lines) if few and lines else top), top


def upsert_all(
    wh: Warehouse,
    matched: DataFrame,
    batch_id: int,
    products: DataFrame,
    customers: DataFrame,
    parallel: bool = True,
    lines: int = 0,
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """All five dimensions of a batch: key maps and largest keys by table.

    ``products`` are the batch's products (:func:`seen_products`), computed
    once for the product, store and supplier dimensions; ``customers`` likewise.
    ``lines`` is how many lines the batch has, 0 if that is not known.
    The dimensions are independent, so they run as concurrent Spark jobs: a
    small dimension alone would leave most of a cluster idle.
    """
    candidates = {
        "customer_dim": customers,
        "product_dim": products,
        "store_dim": _named_entity(products, "store_id", "store_name"),
        "supplier_dim": _named_entity(products, "supplier_id", "supplier_name"),
        "date_dim": date_candidates(matched),
    }

    done = wh.done(before_batch=batch_id)

    def run(t: str) -> tuple[DataFrame, int]:
        natural = DIMENSIONS[t][1]
        return upsert_dimension(wh, t, candidates[t], batch_id, done, candidates[t].select(natural), lines)

    if parallel:
        with ThreadPoolExecutor(max_workers=len(UPSERT_ORDER)) as pool:
            done = dict(zip(UPSERT_ORDER, pool.map(run, UPSERT_ORDER)))
    else:
        done = {t: run(t) for t in UPSERT_ORDER}
    return {t: d for t, (d, _) in done.items()}, {t: k for t, (_, k) in done.items()}
