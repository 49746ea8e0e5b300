"""Nulls, empty and very long texts, repeated rows, empty tables and clashing names in operators 2, 4, 6, 7 and every stage of the pipeline."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillroll.llm import lattice_sampling, line_dedup, token_counts, toxicity
from tillroll.llm.common import staged

SF = "/root/testdata/sf0.001"
#: names that operators give to columns of their own
CLASH = ["_id", "_key", "_doc", "_text", "_row", "_hash", "_t", "_l", "_y", "_score", "_kept", "_lines", "_n", "fp", "sample", "score", "cid", "token", "n_lines", "n_removed", "component_id", "contaminated"]
LONG_LINE = " ".join(f"w{i}" for i in range(30_000))
MANY_LINES = "\n".join(f"line {i} of many that all {i * 3} differ {i * 7} from {i * 11} others {i * 13}" for i in range(8_000))
#: (doc_id, text): ids without labels
ROWS = [
    (None, None),
    (None, "a text that has no id at all but words of its own"),
    (10**9, None),
    (10**9 + 1, ""),
    (10**9 + 2, LONG_LINE),
    (10**9 + 3, MANY_LINES),
    (10**9 + 4, "repeated rows hold the same id and the same words"),
    (10**9 + 4, "repeated rows hold the same id and the same words"),
    (10**9 + 5, "x" * 60_000),
    (10**9 + 6, " \t\n \n"),
    (10**9 + 7, "é 漢字 🙂\x00\x01 odd ones"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in ROWS], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return staged(rows.select("*", *(F.lit(c).alias(c) for c in CLASH)), "edge-documents")


def _texts(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_toxicity_of_odd_rows(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    model_rows = spark.read.parquet(f"{SF}/documents.parquet")
    both = model_rows.select("doc_id", "text", "lang").unionByName(docs.select("doc_id", "text", "lang"))
    got = toxicity.classify(both, labels).filter(f"doc_id is null or doc_id >= {10**9}").collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    at = {}
    for r in got:
        at.setdefault(r.doc_id, []).append(r.score)
    assert at[10**9] == at[10**9 + 1] == at[10**9 + 6]
    assert len(set(at[10**9 + 4])) == 1 and len(at[10**9 + 4]) == 2
    # names that clash, and the empty table
    assert toxicity.classify(docs, labels).count() == len(ROWS)
    assert toxicity.keep_clean(docs.limit(0), labels).columns == docs.columns
    assert toxicity.keep_clean(docs.limit(0), labels).count() == 0


def test_segmentations_of_odd_rows(spark, docs):
    pieces, byte_ids, _ = lattice_sampling.load_vocabulary()
    names = {i: p for p, (i, _) in pieces.items()}
    got = lattice_sampling.encode(docs).collect()
    texts = dict((i, t) for i, t in ROWS if i is not None)
    for r in got:
        if r.doc_id is not None:
            assert lattice_sampling.decode(r.pieces, names, byte_ids) == (texts[r.doc_id] or "")
    assert [(r["sample"], r.n_pieces, r.log_prob) for r in got if r.doc_id == 10**9] == [(1, 0, 0.0)]
    twice = [tuple(r.pieces) for r in got if r.doc_id == 10**9 + 4]
    assert len(twice) == 4 and len(set(twice)) == 2
    assert lattice_sampling.encode(docs.limit(0)).count() == 0
    assert lattice_sampling.decode_texts(lattice_sampling.encode(docs.limit(0))).count() == 0


def test_numbers_of_a_word_do_not_depend_on_those_built_with_it():
    vocabulary = lattice_sampling.load_vocabulary()
    texts = [t or "" for _, t in ROWS if t is None or len(t) < 40_000]
    together = lattice_sampling.sample(texts, range(len(texts)), lattice_sampling.Lattices(*vocabulary), 3)
    for i, t in enumerate(texts):
        alone = lattice_sampling.sample([t], [i], lattice_sampling.Lattices(*vocabulary), 3)[0]
        assert [(x["pieces"].tolist(), x["log_prob"], x["gumbel"]) for x in alone] == [(x["pieces"].tolist(), x["log_prob"], x["gumbel"]) for x in together[i]]


def test_line_dedup_of_odd_rows(spark, docs):
    out = line_dedup.deduplicate(docs, counts=False)
    assert out.columns == docs.columns
    assert _texts(out) == sorted(ROWS, key=repr)  # no line of one row matches that of another
    counted = line_dedup.deduplicate(docs.drop("n_lines", "n_removed")).collect()
    n = {r.doc_id: (r.n_lines, r.n_removed) for r in counted if r.doc_id is not None}
    assert n[10**9] == (0, 0) and n[10**9 + 1] == (1, 0) and n[10**9 + 3] == (8_000, 0) and n[10**9 + 6] == (3, 0)
    late = spark.createDataFrame([(10**9 + 8, LONG_LINE + " tail"), (10**9 + 9, "new\n" + LONG_LINE)], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in line_dedup.deduplicate(docs.select("doc_id", "text").union(late)).collect()}
    assert got[10**9 + 8] == "" and got[10**9 + 9] == "new" and got[10**9 + 2] == LONG_LINE


def test_token_counts_of_odd_rows(spark, docs):
    plain, fallback = token_counts.load_pieces()
    auto = token_counts.LongestMatch(plain, fallback)
    got = sorted(((r.doc_id, r.n_words, r.n_tokens, r.n_bytes) for r in token_counts.token_counts(docs).collect()), key=repr)
    want = []
    for i, t in ROWS:
        raw = (t or "").encode()
        want.append((i, len(raw.split()), sum(auto.count("▁" + w.decode()) for w in raw.split()), len(raw)))
    assert got == sorted(want, key=repr)


def test_every_stage_takes_odd_rows(spark, docs):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").filter("size(split(text, ' ')) > 12").limit(1).collect())
    leak = docs.filter(f"doc_id = {10**9 + 7}").withColumn("doc_id", F.lit(10**9 + 20)).withColumn("text", F.lit(f"before {item} after"))
    docs = staged(docs.unionByName(leak), "edge-leak")
    rows = sorted([*ROWS, (10**9 + 20, f"before {item} after")], key=repr)
    out = {name: staged(stages[name](spark, docs, SF), f"edge-{name}") for name in list(stages)[:-1]}
    assert all(o.columns == docs.columns for o in out.values())
    assert _texts(out["toxicity"]) == rows  # no label, nothing to reject
    assert _texts(out["line_dedup"]) == rows
    assert out["line_dedup"].filter("not n_chars <=> char_length(text)").count() == 0
    one = _texts(out["simhash_near_dedup"])
    assert len(set(one)) == len(one) and set(one) <= set(rows)
    assert [r for r in one if not (r[1] or "").strip()] == [(10**9, None)]  # null, empty and blank texts: the least id stays
    assert {r for r in rows if (r[1] or "").strip()} == set(one) - {(10**9, None)}
    assert _texts(out["benchmark_decontamination"]) == [r for r in rows if r[0] != 10**9 + 20]
    last = stages["sentencepiece_sampling"](spark, docs, SF)
    assert {r.doc_id for r in last.select("doc_id").collect()} == {r[0] for r in rows}


def test_every_stage_takes_an_empty_table(spark, docs):
    import corpus_pipeline

    none = staged(docs.limit(0), "edge-none")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, SF)
        assert out.count() == 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
