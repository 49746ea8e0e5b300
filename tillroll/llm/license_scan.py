"""License scan with ordered signature rules, in DataFrame functions only.

Texts are read as words.  Every rule has a keyword, and a rule's expression is
tried only on texts that hold the keyword: first one pass over the words against
the set of gate words (one word of each keyword), then the keyword itself.
Matches are intervals of words; an interval inside one of a stronger rule is
suppressed, so that of overlapping detections the one that says most is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import license_rules as R
from .common import staged

#: Code points that separate words, after upper-case ASCII letters count as letters.
_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HIT = "array<struct<start:bigint,end:bigint,tier:int,rule:int,label:string>>"


def gate_word(keyword: str) -> str:
    """The word of a keyword that a text must hold: its longest."""
    return max(keyword.split(), key=len)


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rule_array(rules) -> str:
    """The rules as an array literal of structs, folded into the plan once."""
    one = [
        f"named_struct('rule', {i}, 'tier', {tier}, 'label', {_lit(label)}, 'gate', {_lit(gate_word(kw))}, 'kw', {_lit(f' {kw} ')}, 'rx', {_lit(f' ({body})(?= )')})"
        for i, (label, tier, kw, body) in enumerate(rules)
    ]
    return f"array({', '.join(one)})"


def find(docs: DataFrame, keep: list[str], text_col: str = "text", rules=None) -> DataFrame:
    """``keep`` columns, ``n_words`` and ``hits``: every match of every rule, not yet resolved.

    A hit is (start, end, tier, rule, label), words from 0, end exclusive.
    Matches of one rule are leftmost and do not overlap.  In a matching text the
    words where a match starts and ends are marked and read off in one pass, so
    the work is linear in the text however many matches it has.
    """
    rules = R.standard_rules() if rules is None else rules
    gates = ", ".join(sorted({_lit(gate_word(kw)) for _, _, kw, _ in rules}))
    df = docs.select(*keep, F.translate(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), _SEPARATOR, " "), _UPPER, _LOWER).alias("_t"))
    df = df.select(*keep, F.concat(F.lit(" "), F.trim("_t"), F.lit(" ")).alias("_n"), F.split(F.trim("_t"), " ").alias("_w"))
    present = F.expr(f"array_intersect(_w, array({gates}))")
    n_words = F.when(F.col("_n") == "  ", 0).otherwise(F.size("_w")).cast("bigint")
    df = df.select(*keep, "_n", n_words.alias("n_words"), present.alias("_g"))
    marks = r"split(regexp_replace(_n, r.rx, ' \u0001$1\u0002'), ' ')"
    at = r"filter(transform(ws, (w, i) -> if({}(w, '\u000{}'), i, null)), x -> x is not null)"
    hits = f"""
        flatten(transform(
          filter({_rule_array(rules)}, r -> array_contains(_g, r.gate) and contains(_n, r.kw) and rlike(_n, r.rx)),
          r -> flatten(transform(array({marks}), ws ->
            transform(arrays_zip({at.format("startswith", 1)}, {at.format("endswith", 2)}), z ->
              named_struct('start', cast(z.`0` - 1 as bigint), 'end', cast(z.`1` as bigint), 'tier', r.tier, 'rule', r.rule, 'label', r.label))))))"""
    none = F.expr(f"cast(array() as {_HIT})")
    return df.select(*keep, "n_words", F.when(F.size("_g") == 0, none).otherwise(F.expr(hits).cast(_HIT)).alias("hits"))


def resolve(hits: DataFrame, row: str) -> DataFrame:
    """``hits`` (one row a hit) with ``kept``: False where a stronger hit of the same row contains it.

    Stronger is a lower tier; within a tier the longer one, then the earlier
    rule.  In order of start, then longest first, whatever contains a hit comes
    before it, so the furthest end seen so far among tiers as strong as its own
    decides: one running maximum a tier, no pairs.
    """
    before = Window.partitionBy(row).orderBy("start", F.col("end").desc(), "tier", "rule").rowsBetween(Window.unboundedPreceding, -1)
    furthest = [F.max(F.when(F.col("tier") <= t, F.col("end"))).over(before) for t in range(len(R.CONFIDENCE))]
    own = F.coalesce(*[F.when(F.col("tier") == t, e) for t, e in enumerate(furthest)], F.lit(-1))
    return hits.withColumn("kept", own < F.col("end"))


def detections(docs: DataFrame, keep: list[str], text_col: str = "text", rules=None) -> DataFrame:
    """One row per detection left after suppression: ``keep``, label, tier, rule, start and end in words."""
    found = find(docs, keep, text_col, rules).withColumn("_row", F.monotonically_increasing_id())
    each = staged(found, "licenses").select(*keep, "_row", F.inline("hits"))
    return resolve(each, "_row").filter("kept").drop("_row", "kept")


def _labels(c: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(c)), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=None, n_base: int = R.N_BASE) -> DataFrame:
    """One row per row of ``docs``: what licenses its whole text names.

    n_words; n_base: places of the first ``n_base`` rules, which are never
    suppressed, first_word and last_word their smallest and largest start (null
    without any), base_labels their labels; labels: those and the labels of all
    detections left; n_detections: how many are left; score: the confidence of
    the strongest one, 0 without any.

    Null and empty texts have no words and no labels; a text without gate words
    costs one pass.  Very long texts are read whole, in time linear in their
    length.  Equal intervals of rules of one tier: the earlier rule is left.
    Repeated rows and null ids each get their row; an empty table gives none.
    Other columns, whatever their names, are not read.
    """
    found = find(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), ["_id"], "_text", rules)
    found = staged(found.withColumn("_row", F.monotonically_increasing_id()), "licenses")  # fixes _row
    each = found.filter(F.size("hits") > 0).select("_row", F.inline("hits"))
    base, left = F.col("rule") < n_base, F.col("kept")
    conf = F.element_at(F.array(*map(F.lit, R.CONFIDENCE)), F.col("tier") + 1)
    per_row = resolve(each, "_row").groupBy("_row").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        _labels(F.when(base, F.col("label"))).alias("base_labels"),
        _labels(F.when(base | left, F.col("label"))).alias("labels"),
        F.count(F.when(left, 1)).alias("n_detections"),
        F.max(F.when(base | left, conf)).alias("score"),
    )
    zero = F.lit(0).cast("bigint")
    return found.select("_row", "_id", "n_words").join(per_row, "_row", "left").select(
        F.col("_id").alias(id_col),
        "n_words",
        F.coalesce("n_base", zero).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("n_detections", zero).alias("n_detections"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
