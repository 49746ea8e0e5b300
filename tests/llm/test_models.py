"""Toxicity, segmentation sampling, chat repair and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import chat_repair, decontaminate, lattice_sampling, simhash, toxicity
from tillroll.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"

# ---------------------------------------------------------------- toxicity


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    right = sum(r.predicted == r.toxic for r in held)
    assert len(held) > 50 and right >= 0.93 * len(held)
    found = [r.predicted for r in held if r.toxic]
    assert sum(found) >= 0.7 * len(found)


def test_toxicity_edges(spark):
    rows = [(i, f"fine words {i} here" if i % 3 else f"you utter nitwit {i} here", ["en", "de", None][i % 3]) for i in range(240)]
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "nitwit " + "calm " * 40000, "en"), (None, "utter nitwit", "en"), (7, rows[7][1], "en")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id bigint, text string, lang string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(200, None), (None, 1), (201, 7)], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    assert len(got) == len(rows) - 1
    late = [r for i, r in got.items() if i is not None and 200 <= i < 240]
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in late)
    assert got[1002].predicted == 1 and got[None].predicted == 1 and not got[None].held_out
    assert got[1000].score == got[1001].score
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 4, 5}
    none = toxicity.classify(docs, labels.limit(0)).collect()
    assert len(none) == len(rows) and len({r.score for r in none}) == 1 and not any(r.predicted for r in none)
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def test_long_texts_are_read_whole():
    """The score of a text in pieces equals that in one."""
    rng = np.random.default_rng(0)
    m = toxicity.fit([rng.integers(0, 1 << 17, 30) for _ in range(40)], np.array([0, 1] * 20, np.float32), ["en"] * 40)
    t = rng.integers(0, 1 << 17, 3 * toxicity._CHUNK + 5)
    whole = np.maximum(toxicity._convolve(m, toxicity._embed(m, t)).max(0) + m.bias, 0)
    assert np.allclose(toxicity.pooled(m, t), whole, atol=1e-4)
    texts = [rng.integers(0, 1 << 17, n) for n in (3, 1, 50, 0, 2)]
    assert np.allclose(toxicity.logits(m, texts), [toxicity.logits(m, [x])[0] for x in texts], atol=1e-4)


# ------------------------------------------------------------ segmentation

PIECES = {c: (i, float(i + 1)) for i, c in enumerate(["▁", "a", "b", "ab", "▁a", "ba", "▁ab", "bb"])}
BYTES = list(range(100, 356))


def all_segmentations(text):
    def segs(u):
        if not u:
            yield ()
        for p in PIECES:
            if u.startswith(p):
                for r in segs(u[len(p) :]):
                    yield (p, *r)

    out = {}
    for comb in itertools.product(*[list(segs(u)) for u in lattice_sampling.units(text)]):
        ids = tuple(PIECES[p][0] for s in comb for p in s)
        out[ids] = math.prod((PIECES[p][1] + 2.7) ** -1.0 for s in comb for p in s)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


def test_samples_have_the_law_of_sampling_without_replacement():
    text, n = "abba ab", 20000
    p = all_segmentations(text)
    lat = lattice_sampling.Lattices(PIECES, BYTES, 400)
    keys = lattice_sampling.mix(np.arange(n).astype(np.uint64)).tolist()
    res = lattice_sampling.sample([text] * n, keys, lat, 2)
    assert all(len({tuple(x["pieces"]) for x in r}) == 2 for r in res)
    for x in (x for r in res[:300] for x in r):
        assert math.isclose(x["log_prob"], math.log(p[tuple(x["pieces"])]), rel_tol=1e-9)
    assert all(r[0]["gumbel"] > r[1]["gumbel"] for r in res)
    second = collections.Counter()
    for (a, pa), (b, pb) in itertools.permutations(p.items(), 2):
        second[b] += pa * pb / (1 - pa)
    for k, want in enumerate((p, second)):
        seen = collections.Counter(tuple(r[k]["pieces"].tolist()) for r in res)
        assert max(abs(seen[s] / n - want[s]) for s in p) < 0.015
    # weights by inclusion make sums over the samples unbiased
    assert abs(np.mean([sum(math.exp(x["log_prob"] - x["log_inclusion"]) for x in r) for r in res]) - 1) < 0.03


def test_all_segmentations_come_out_once_when_asked_for():
    lat = lattice_sampling.Lattices(PIECES, BYTES, 400)
    for text in ("ab", "abab", "bbb a", "x", "a\nb"):
        p = all_segmentations(text) if "x" not in text and "\n" not in text else None
        res = lattice_sampling.sample([text], [5], lat, 200)[0]
        got = {tuple(x["pieces"].tolist()) for x in res}
        assert len(got) == len(res)
        if p is not None:
            assert got == set(p) and all(x["log_inclusion"] == 0 for x in res)


def test_decoding_restores_the_text():
    pieces, byte_ids, size = lattice_sampling.load_vocabulary()
    names = {i: p for p, (i, _) in pieces.items()}
    lat = lattice_sampling.Lattices(pieces, byte_ids, size)
    texts = ["Hello  world\n\nfoo é ◊ 𝄞 x", " lead and trail ", "\t tab\r\n", "word" * 3000, "a", "\n", "x" * 500 + " " * 50]
    for t, res in zip(texts, lattice_sampling.sample(texts, list(range(9)), lat, 3)):
        assert res and all(lattice_sampling.decode(x["pieces"].tolist(), names, byte_ids) == t for x in res), t[:30]


def test_samples_follow_the_row_key_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    extra = spark.createDataFrame([(None, "no id", "en", "s", 5), (900001, None, "en", "s", 0), (900002, "", "en", "s", 0)], docs.schema)
    df = docs.union(extra).withColumn("sample", F.lit("clash"))
    a = {(r.doc_id, r.sample): (r.pieces_sha256, r.gumbel) for r in lattice_sampling.encode(df.coalesce(1)).collect()}
    b = {(r.doc_id, r.sample): (r.pieces_sha256, r.gumbel) for r in lattice_sampling.encode(df.repartition(5), with_pieces=False).collect()}
    c = {(r.doc_id, r.sample): (r.pieces_sha256, r.gumbel) for r in lattice_sampling.encode(df, seed=1).collect()}
    assert a == b and a.keys() == c.keys() and a != c
    assert a[(900001, 1)] == a[(900002, 1)] and (900001, 2) not in a and (None, 2) in a
    assert lattice_sampling.encode(df.limit(0)).count() == 0


# ------------------------------------------------------------------- chat


def brute_cost(roles):
    """Least cost over all ways to take the turns, by exhaustive search."""
    best = {chat_repair.START: 0}
    for r in roles:
        nxt = {}
        for s, c in best.items():
            for run_len in range(4):
                for run in itertools.product((1, 2, 3), repeat=run_len):
                    t, ok = s, True
                    for x in run:
                        ok, t = ok and x in chat_repair.LEGAL[t], x
                    if not ok:
                        continue
                    for to in (1, 2, 3):
                        change = 0 if r == chat_repair.ROLES[to - 1] else chat_repair.UNKNOWN if r is None else chat_repair.RELABEL
                        costs = [chat_repair.INSERT * run_len + change] if to in chat_repair.LEGAL[t] else []
                        if to == s and not run:
                            costs.append(chat_repair.MERGE + change)
                        for k in costs:
                            nxt[to] = min(nxt.get(to, 10**9), c + k)
        best = nxt
    return min(c + int(chat_repair.END[s]) for s, c in best.items())


def total_cost(roles, solved, tail):
    cost, state = chat_repair.INSERT * len(tail), chat_repair.START
    for r, (to, action, run) in zip(roles, solved):
        for x in run:
            assert x in chat_repair.LEGAL[state]
            state = x
            cost += chat_repair.INSERT
        assert (to == state) if action == "merge" else (to in chat_repair.LEGAL[state])
        cost += chat_repair.MERGE if action == "merge" else 0
        cost += 0 if r == chat_repair.ROLES[to - 1] else chat_repair.UNKNOWN if r is None else chat_repair.RELABEL
        state = to
    for x in tail:
        assert x in chat_repair.LEGAL[state]
        state = x
    assert state == chat_repair.FINAL
    return cost


def test_repair_has_the_least_cost():
    for n in range(1, 6):
        for roles in itertools.product((*chat_repair.ROLES, None), repeat=n):
            solved, tail = chat_repair.solve(list(roles), chat_repair.START, None)
            assert total_cost(roles, solved, tail) == brute_cost(roles), roles


@pytest.mark.parametrize(("block", "group"), [(4096, 1024), (4, 1024), (4, 3)])
def test_conversations_are_repaired_in_blocks_as_in_one(spark, block, group):
    rng = np.random.default_rng(8)
    rows = []
    for conv in range(30):
        for turn in range(int(rng.integers(1, 9))):
            rows.append((conv, turn, str(rng.choice(["system", "user", "assistant", " USER ", "gpt", "tool"])), f"t{conv}.{turn}"))
    rows += [(77, t, "user" if t % 5 else "assistant", f"hot {t}") for t in range(300)]  # one conversation with most rows
    rows += [(78, None, None, None), (78, 0, "user", ""), (79, 1, "user", "same"), (79, 1, "user", "same"), (None, 0, "user", "no id"), (None, 1, "assistant", "<|im_end|>x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, position int").repartition(3)
    got = collections.defaultdict(list)
    for r in chat_repair.repair(df, block=block, group=group).collect():
        got[r.conv_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for conv, rs in got.items():
        rs.sort(key=lambda r: r.position)
        roles = [chat_repair.normal_role(r.role) for r in rs]
        assert [r.turn for r in rs] == sorted((r.turn for r in rs), key=lambda t: (t is None, t or 0))
        state = {r: i for i, r in enumerate(chat_repair.ROLES, 1)}
        solved, tail = [], ()
        for k, r in enumerate(rs):
            own = [state[x] for x in r.inserted]
            solved.append((state[r.new_role], r.action, tuple(own)))
        # what was inserted behind the last turn is told apart by the legal order
        last = rs[-1]
        for cut in range(len(last.inserted) + 1):
            try:
                run = [state[x] for x in last.inserted]
                cost = total_cost(roles, [*solved[:-1], (solved[-1][0], last.action, tuple(run[:cut]))], tuple(run[cut:]))
                break
            except AssertionError:
                continue
        else:
            raise AssertionError(conv)
        want, tail = chat_repair.solve(roles, chat_repair.START, None)
        assert cost == total_cost(roles, want, tail)
        text = "".join(r.piece for r in rs)
        assert text.startswith(chat_repair.OPEN) and text.endswith(chat_repair.CLOSE + "\n")
        heads = [x.split("\n")[0] for x in text.split(chat_repair.OPEN)[1:]]
        at = chat_repair.START
        for h in heads:
            assert state[h] in chat_repair.LEGAL[at]
            at = state[h]
        assert at == chat_repair.FINAL and text.count(chat_repair.CLOSE) == len(heads)
    assert chat_repair.repair(df.limit(0)).count() == 0


# --------------------------------------------------------------- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "sentencepiece_sampling"]
    seen = {}
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, sf)
        assert out.columns == docs.columns
        seen[name] = (at, out)
        at = corpus_pipeline.staged(out, f"test-{name}")
    before = {r.doc_id: r.text for r in corpus_pipeline.staged(seen["line_dedup"][0], "t").collect()}
    after = corpus_pipeline.staged(seen["line_dedup"][1], "t").collect()
    assert {r.doc_id for r in after} == set(before) and all(r.n_chars == len(r.text) for r in after)
    assert any(len(r.text) < len(before[r.doc_id]) for r in after)
    sim = corpus_pipeline.staged(seen["simhash_near_dedup"][1], "t")
    near = simhash.near_duplicates(sim)
    assert near.filter("doc_id != component_id").count() == 0
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert decontaminate.contamination(at, bench, ["doc_id"]).filter("contaminated").count() == 0
    kept = {r.doc_id for r in at.collect()}
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in out} == kept
    pieces, byte_ids, _ = lattice_sampling.load_vocabulary()
    names = {i: p for p, (i, _) in pieces.items()}
    texts = {r.doc_id: r.text for r in at.collect()}
    for r in out:
        assert lattice_sampling.decode(r.pieces or [], names, byte_ids) == texts[r.doc_id]


def test_decoding_on_spark_equals_decoding_one_by_one(spark):
    pieces, byte_ids, size = lattice_sampling.load_vocabulary()
    names = {i: p for p, (i, _) in pieces.items()}
    texts = ["", " two  spaces ", "line\nfeeds\n", "é 漢字 🙂 \x01\t", "▁mark", "a" * 3000, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = lattice_sampling.encode(df, samples=3).select("doc_id", "pieces")
    odd = spark.createDataFrame([(90, [byte_ids[0xFF], byte_ids[0x20]]), (91, [byte_ids[0x20], byte_ids[0xC3]]), (92, None)], found.schema)
    got = lattice_sampling.decode_texts(found.union(odd).withColumn("tag", F.lit("t"))).collect()
    want = [(r.doc_id, None if r.pieces is None else lattice_sampling.decode(r.pieces, names, byte_ids)) for r in found.union(odd).collect()]
    assert sorted(((r.doc_id, r.decoded) for r in got), key=str) == sorted(want, key=str) and {r.tag for r in got} == {"t"}
    assert all(r.decoded == (texts[r.doc_id] or "").replace("▁", " ") for r in got if r.doc_id < 90)


def test_op4_decodes_every_sample(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = QUERIES["op4_gumbel_topk"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in got} == set(texts)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.round_trip for r in got)


def test_word_lattices_take_bounded_memory():
    import random

    letters = random.Random(5)
    lat = lattice_sampling.Lattices(PIECES, BYTES, 400)
    held = 0
    for at in range(55):
        words = ["".join(letters.choices("abcdehlorw", k=12)) for _ in range(4000)]
        lattice_sampling.sample([" ".join(words)], [at], lat, 2)
        held = max(held, sum(getattr(lat, c).nbytes for c in ("first", "count", "e_id", "e_next", "e_p", "e_cum")))
    assert held < 50e6
