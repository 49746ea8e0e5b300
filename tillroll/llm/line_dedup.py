"""Line deduplication by an exact set-similarity join, in DataFrame functions only.

A line is the set of its five-word shingles (all its words if it has fewer).
Two lines match when the Jaccard similarity of their sets is 0.8 or more; a
line that matches any line earlier in the corpus, by document id and then line
number, is removed; documents that share an id or have none stay apart.

Equal lines form one class first, so copies cost one row.  Shingles are put in
one order for the whole corpus, rare ones first, by a histogram of hashed
shingles over all classes (``2 ** BITS`` counters, whatever the corpus; hash
collisions only blur the order, which need not be exact).  With it:

* prefix filter: matching lines share a shingle within the first
  ``n - ceil(0.8 n) + 1`` of the longer line and the first
  ``n - ceil(8/9 n) + 1`` of the shorter one;
* length filter: the shorter has at least 0.8 of the longer's shingles;
* positional filter: at their first common shingle, what remains behind it in
  either line must suffice for the overlap.

Candidates are verified on their whole sets.  As one earlier match settles a
line, lines meet the earliest line of each of their tokens first
(:func:`later_matches`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, staged

SHINGLE = 5
NUM, DEN = 4, 5  # the similarity 0.8 in whole numbers
BITS = 18
ROUNDS = 1
_BITMAP, _BITMAPS = 1 << 15, 2048  # bits of a bitmap, and how many there are at most
_SPACE, _WORD = r"[\x09-\x0D\x20]+", r"[^\x09-\x0D\x20]"


def _norm(line: Column) -> Column:
    """The line's words in lower case with one space between them; most lines have no other space to replace."""
    odd = line.rlike(r"[\x09-\x0D]|\x20\x20")
    return F.trim(F.lower(F.when(odd, F.regexp_replace(line, _SPACE, " ")).otherwise(line)))


def _gram(at: str, size: int = SHINGLE) -> str:
    """Hash of the ``size`` words from ``at`` in the array ``h`` of word hashes; of the whole array if it has fewer (at < 0)."""
    words = ", ".join(f"get(h, {at} + {k})" for k in range(size))
    return f"CASE WHEN {at} < 0 THEN xxhash64(h) ELSE xxhash64({words}) END"


_PLACES = f"CASE WHEN size(h) < {SHINGLE} THEN array(-1) ELSE sequence(0, size(h) - {SHINGLE}) END"


def _hashed() -> Column:
    return F.transform(F.split("norm", " "), lambda w: F.xxhash64(w)).alias("h")


def _shingles() -> Column:
    """Distinct shingle hashes of a line, from its word hashes ``h``."""
    return F.expr(f"array_distinct(transform({_PLACES}, i -> {_gram('i')}))")


def _ceil(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("int")


def _histogram(classes: DataFrame, bits: int) -> Column:
    """Per counter the level (logarithm) of its shingles, one byte each, as a literal of ``2 ** bits`` bytes."""
    spark = classes.sparkSession
    # places are exploded, not shingles: their hashes and counters then are generated code
    places = classes.select(_hashed()).select("h", F.explode(F.expr(_PLACES)).alias("i"))
    counts = places.select(F.expr(_gram("i")).alias("s")).groupBy(F.pmod("s", F.lit(1 << bits)).alias("k")).count()
    full = spark.range(1 << bits).select(F.col("id").alias("k"), F.lit(0).cast("bigint").alias("count")).unionByName(counts)
    full = full.groupBy("k").agg(F.sum("count").alias("c"))
    level = F.char(F.lit(48) + F.floor(F.log2(F.col("c") + 1)).cast("bigint"))
    row = full.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", level.alias("l")))), lambda x: x["l"]), "").alias("h"),
    ).first()
    return F.lit(row["h"].encode())


def _ordered(shingles: Column, histogram: Column, bits: int) -> Column:
    """Shingles as numbers that sort from rare to frequent: level in the top bits, hash below."""

    def number(s: Column) -> Column:
        at = (F.pmod(s, F.lit(1 << bits)) + 1).cast("int")
        level = F.ascii(F.substring(histogram, at, F.lit(1)).cast("string")) - 48
        return F.shiftleft(level.cast("bigint"), 57).bitwiseOR(s.bitwiseAND(F.lit((1 << 57) - 1)))

    return F.sort_array(F.transform(shingles, number))


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_doc, _id, _text, _row, _hash): the rows of ``docs`` and what tells them apart besides the id.

    Rows without an id are staged with a number each (few or none, as a rule);
    rows with one have number 0 and are told apart by the hash of the text.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_doc"))
    at = F.col(f"_doc.`{id_col}`")
    bare = staged(rows.filter(at.isNull()).withColumn("_row", F.monotonically_increasing_id()), "line-bare")
    rows = rows.filter(at.isNotNull()).withColumn("_row", F.lit(0).cast("bigint")).unionByName(bare)
    text = F.col(f"_doc.`{text_col}`")
    return rows.select("_doc", at.alias("_id"), text.alias("_text"), "_row", F.xxhash64(text).alias("_hash"))


def classes_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cid, first, norm): the distinct lines, as words with one space between them, and the place of the first occurrence of each.

    ``first`` orders by document id (null ids last), hash of the text, row
    number and line number.
    """
    return _classes(_numbered(docs, id_col, text_col))


def _classes(rows: DataFrame) -> DataFrame:
    lines = rows.select("_id", "_hash", "_row", F.posexplode(F.split("_text", "\n", -1)).alias("line_no", "line"))
    place = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_hash").alias("hash"), F.col("_row").alias("row"), "line_no")
    lines = lines.select(place.alias("place"), _norm(F.col("line")).alias("norm")).filter("norm <> ''")
    lines = lines.select("place", F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(1), "norm").alias("h2"), "norm")
    classes = lines.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.first("norm").alias("norm"))
    return staged(classes.select(F.monotonically_increasing_id().alias("cid"), "first", "norm"), "line-classes")


def later_matches(classes: DataFrame, bits: int = BITS, rounds: int = ROUNDS) -> DataFrame:
    """cid of every class that matches a class which comes first earlier.

    One earlier match settles a line, so lines are settled in rounds: each open
    line is compared with the earliest open line of each of its prefix tokens,
    one pair a token and line, and of a group of similar lines all but the
    first leave in one round.  After ``rounds`` of them, the lines that are
    still open meet all earlier lines of their tokens.  Pairs between two later
    lines, of which a group has the square, are never made.
    """
    histogram = _histogram(classes, bits)
    t = classes.select("cid", _hashed()).select("cid", _ordered(_shingles(), histogram, bits).alias("tokens")).withColumn("n", F.size("tokens"))
    prefix = F.col("n") - _ceil(F.col("n") * NUM, DEN) + 1
    posts = t.select("cid", "n", F.posexplode(F.slice("tokens", F.lit(1), prefix)).alias("pos", "token"))
    # two small numbers in one: most rows of this shuffle are of tokens that no other line has
    posts = posts.select("token", "cid", F.shiftleft(F.col("n").cast("bigint"), 32).bitwiseOR(F.col("pos").cast("bigint")).alias("_np"))
    posts = posts.withColumn("_c", F.count("*").over(Window.partitionBy("token"))).filter("_c > 1")
    posts = posts.select("token", "cid", F.shiftright("_np", 32).cast("int").alias("n"), F.col("_np").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("pos"))
    posts = staged(posts, "line-shared")
    shared = staged(posts.join(classes.select("cid", F.col("first").alias("at")), "cid"), "line-posts")
    discard(posts)

    later = []
    open_ = shared
    for _ in range(rounds):
        lead = open_.groupBy("token").agg(F.min(F.struct("at", "cid", "n", "pos")).alias("l"))
        led = open_.join(lead, "token").select("cid", "n", "pos", F.col("l.cid").alias("y"), F.col("l.n").alias("ny"), F.col("l.pos").alias("py"))
        led = led.filter((F.col("cid") != F.col("y")) & _enough("n", "pos", "ny", "py")).select(F.col("cid").alias("x"), "y").distinct()
        settled = _verified(staged(led, "line-led"), classes)
        later.append(settled)
        rest = staged(open_.join(settled, "cid", "left_anti"), "line-open")
        if open_ is not shared:
            discard(open_)
        open_ = rest
    pairs = staged(_candidates(open_, shared), "line-pairs")
    later.append(_verified(pairs, classes))
    discard(shared, open_)
    out = staged(reduce(DataFrame.union, later).distinct(), "line-later")
    discard(*later)
    return out


def _enough(n: str, pos: str, ny: str, py: str) -> Column:
    """Length and positional filters at the first common token of two lines."""
    a, b = F.col(n), F.col(ny)
    need = _ceil((a + b) * NUM, NUM + DEN)
    return (F.least(a, b) * DEN >= F.greatest(a, b) * NUM) & (F.least(a - F.col(pos), b - F.col(py)) >= need)


def _candidates(open_: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs (x, y) of an open line and an earlier one that pass the prefix, length and positional filters at some common token.

    Of two matching lines the shorter one has the token within a shorter prefix.
    """

    def short(n: str, pos: str) -> Column:
        return F.col(pos) < F.col(n) - _ceil(F.col(n) * 2 * NUM, NUM + DEN) + 1

    y = index.select("token", F.col("cid").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("py"), F.col("at").alias("ay"))
    x = open_.select("token", F.col("cid").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), F.col("at").alias("ax"))
    shorter = F.when(F.col("nx") <= F.col("ny"), short("nx", "px")).otherwise(short("ny", "py"))
    return x.join(y, "token").filter((F.col("ay") < F.col("ax")) & _enough("nx", "px", "ny", "py") & shorter).select("x", "y").distinct()


def _likely(classes: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``classes`` whose cid is among ``ids``, and few others.

    Tests a bit of a hash of the cid, of eight bits an id in bitmaps of 4 KB
    that are broadcast: 2048 of them at most, so that beyond 8 million ids more
    other rows stay.
    """
    n = min(ids.count() * 8 // _BITMAP + 1, _BITMAPS)
    place = F.pmod(F.xxhash64("cid"), F.lit(n * _BITMAP).cast("bigint")) + 1
    bit, bucket = F.bitmap_bit_position(place), F.bitmap_bucket_number(place)
    bits = ids.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    rows = classes.select("*", bit.cast("int").alias("_bit"), bucket.alias("_bucket")).join(F.broadcast(bits), "_bucket")
    byte = F.conv(F.hex(F.expr("substring(_bits, shiftright(_bit, 3) + 1, 1)")), 16, 10).cast("int")
    return rows.withColumn("_byte", byte).filter("shiftright(_byte, _bit & 7) & 1 = 1").select(*classes.columns)


def _verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """cid of the later class of every pair whose whole sets are similar enough; deletes ``pairs``."""
    ids = staged(pairs.select(F.explode(F.array("x", "y")).alias("cid")).distinct(), "line-ids")
    # moved as text, which is smaller than its words; a semi join would be made before the filter
    texts = _likely(classes, ids).join(ids, "cid")
    sets = staged(texts.select("cid", "first", _hashed()).select("cid", "first", _shingles().alias("s")), "line-sets")
    both = pairs.join(sets.toDF("x", "fx", "sx"), "x").join(sets.toDF("y", "fy", "sy"), "y")
    common = F.size(F.array_intersect("sx", "sy"))
    same = common * (NUM + DEN) >= (F.size("sx") + F.size("sy")) * NUM
    later = both.filter(same & (F.col("fx") != F.col("fy"))).select(F.when(F.col("fx") > F.col("fy"), F.col("x")).otherwise(F.col("y")).alias("cid"))
    later = staged(later.distinct(), "line-later")
    discard(pairs, ids, sets)
    return later


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with the later matches removed from its texts, and with ``counts`` n_lines and n_removed behind its columns.

    Lines are cut at line feeds; lines without words stay and match nothing.
    All columns are returned; a null text stays null.  Rows without an id come
    last, each as a document of its own; rows that share an id but not the text
    are documents of their own too, in the order of the texts' hashes.  Only
    rows equal in id and text are one document that is repeated: they hold the
    same places and keep the same lines.  A text all of whose lines match
    earlier ones becomes empty.  Empty texts stay; very long texts and lines
    are read whole.  A table without rows gives none.  Columns of any name pass
    through; one called n_lines or n_removed asks for ``counts`` false.
    """
    rows = _numbered(docs, id_col, text_col)
    classes = _classes(rows)
    later = later_matches(classes)
    kept = classes.join(later, "cid", "left_anti").select("first.*")
    # the lines of one text: no list is longer than that
    kept = kept.groupBy("id", "hash", "row").agg(F.collect_list("line_no").alias("_kept"))
    kept = staged(kept, "line-kept")
    discard(classes, later)
    rows = rows.select("_doc", "_id", "_hash", "_row")  # one copy of the text is moved
    same = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("hash")) & (F.col("_row") == F.col("row"))
    rows = rows.join(kept, same, "left").withColumn("_lines", F.split(F.col(f"_doc.`{text_col}`"), "\n", -1))
    none = F.expr("cast(array() as array<int>)")
    stays = F.filter("_lines", lambda l, i: ~l.rlike(_WORD) | F.array_contains(F.coalesce("_kept", none), i))
    rows = rows.select("_doc", F.size("_lines").alias("_n"), stays.alias("_stays"))
    out = [F.array_join("_stays", "\n").alias(c) if c == text_col else F.col(f"_doc.`{c}`") for c in docs.columns]
    n = F.coalesce(F.when(F.col(f"_doc.`{text_col}`").isNotNull(), F.col("_n")), F.lit(0)).cast("bigint")
    removed = F.when(F.col(f"_doc.`{text_col}`").isNotNull(), F.col("_n") - F.size("_stays")).otherwise(0).cast("bigint")
    return rows.select(*out, *([n.alias("n_lines"), removed.alias("n_removed")] if counts else []))
