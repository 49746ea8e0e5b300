"""Line, SimHash and embedding deduplication and connected components against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
import xxhash

from tillroll.llm import embedding_dedup, line_dedup, simhash
from tillroll.llm.components import components

SF = "/root/testdata/sf0.001"


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(300)]
    u = Union()
    for a, b in edges:
        u.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: u.find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([(None, 1), (2, 2)], "a bigint, b bigint")).count() == 0


# ------------------------------------------------------------------ lines


def shingles(line):
    ws = line.lower().split()
    return {tuple(ws)} if len(ws) < 5 else {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}


def brute_lines(rows):
    """Expected texts of (doc_id, text) rows."""
    places = sorted({((i is None, i or 0), k, line) for i, t in rows if t is not None for k, line in enumerate(t.split("\n")) if line.split()}, key=lambda p: p[:2])
    sets = [(p[:2], shingles(p[2])) for p in places]
    gone, first = set(), {}
    for i, (at, s) in enumerate(sets):
        if any(at2 < at and 9 * len(s & s2) >= 4 * (len(s) + len(s2)) for at2, s2 in sets[:i]):
            gone.add((at, places[i][2]))
    del first
    out = []
    for i, t in rows:
        key = (i is None, i or 0)
        out.append((i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if ((key, k), x) not in gone)))
    return out


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choices(vocab, k=rng.choice([1, 3, 5, 6, 12, 30, 45, 60]))) for _ in range(25)]

    def variant(line):
        ws = line.split()
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            ws[rng.randrange(len(ws))] = rng.choice(vocab)
        if rng.random() < 0.2:
            ws.append(rng.choice(vocab))
        return " ".join(ws) if rng.random() < 0.8 else "  ".join(ws).upper() + "\t"

    rows = [(i, "\n".join(variant(rng.choice(base)) if rng.random() < 0.9 else "" for _ in range(rng.randrange(1, 9)))) for i in range(70)]
    rows += [(100, None), (101, ""), (102, "\n \n"), (103, base[0] + "\n" + base[0]), (None, base[1] + "\nonly here and nowhere else at all"), (104, "a\r\nb")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, n_removed string, cid int")
    got = line_dedup.deduplicate(df.select("doc_id", "text", "cid")).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r.doc_id, r.text) for r in got), key=key) == sorted(brute_lines(rows), key=key)
    for r in got:
        src = dict(rows)[r.doc_id]
        assert r.n_lines == (0 if src is None else len(src.split("\n"))) and r.cid == 1
        assert r.n_removed == (0 if src is None else len(src.split("\n")) - len(_kept_lines(src, r.text)))


def _kept_lines(src, text):
    return [] if text == "" and src.split("\n")[0] != "" and not any(not x.split() for x in src.split("\n")) else text.split("\n")


def test_settling_in_rounds_changes_no_result(spark):
    """The same classes are found however many rounds settle lines before pairs are made, and fewer pairs are made."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        ws = list(base) if i % 3 else base[:30] + [f"x{j}" for j in range(20)]
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            ws[rng.randrange(len(ws))] = f"e{rng.randrange(9)}"
        rows.append((i, " ".join(ws)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    classes = line_dedup.classes_of(df, "doc_id", "text")
    found = [{r.cid for r in line_dedup.later_matches(classes, bits=12, rounds=n).collect()} for n in (0, 1, 3)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 20
    kept = {i for i, t in brute_lines(rows) if t}
    assert {r.first.id for r in classes.filter(~classes.cid.isin(list(found[0]))).collect()} == kept


def test_a_group_of_similar_lines_makes_few_pairs(spark, monkeypatch):
    """Lines of one group are settled by its first line: pairs grow with the lines, not with their square."""
    made = []
    plain = line_dedup._candidates
    monkeypatch.setattr(line_dedup, "_candidates", lambda *a: (made.append(plain(*a).count()), plain(*a))[1])
    base = [f"w{i}" for i in range(80)]
    for n in (100, 400):
        rows = [(i, " ".join([*base[:40], f"own{i}", *base[40:]])) for i in range(n)]
        got = line_dedup.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert sum(r.n_removed for r in got) == n - 1
    assert max(made) == 0


def test_line_dedup_edges(spark):
    schema = "doc_id bigint, text string, lang string"
    assert line_dedup.deduplicate(spark.createDataFrame([], schema)).count() == 0
    hot = "one very common line that all documents share word for word"
    df = spark.createDataFrame([(i, f"{hot}\nown {i} line with its very own words {i * 7} {i * 13} {i * 17}", "en") for i in range(300)], schema)
    got = {r.doc_id: r for r in line_dedup.deduplicate(df).collect()}
    assert got[0].n_removed == 0 and all(got[i].n_removed == 1 and hot not in got[i].text for i in range(1, 300))
    same = spark.createDataFrame([(5, hot, "en"), (5, hot, "en")], schema)  # repeated rows hold the same place
    assert [r.text for r in line_dedup.deduplicate(same).collect()] == [hot, hot]


def test_line_dedup_of_rows_that_share_an_id_or_have_none(spark):
    """Their lines are removed as those of other rows are; copies without an id leave one."""
    hot = "one very common line that all documents share word for word"
    schema = "doc_id bigint, text string, _row string"
    for shared in (None, 7):
        rows = [(shared, f"{hot}\nown {i} line with its very own words {i * 7} {i * 13} {i * 17}", str(i)) for i in range(200)]
        got = line_dedup.deduplicate(spark.createDataFrame(rows, schema)).collect()
        assert sorted(r._row for r in got) == sorted(r[2] for r in rows)
        assert sum(hot in r.text for r in got) == 1 and sum(r.n_removed for r in got) == 199
        assert all(f"own {r._row} line" in r.text for r in got)
    copies = spark.createDataFrame([(None, hot, str(i)) for i in range(50)] + [(3, "x\n" + hot.upper(), "n")], schema)
    got = line_dedup.deduplicate(copies).collect()
    assert sorted(r.text for r in got) == [""] * 50 + ["x\n" + hot.upper()]
    near = spark.createDataFrame([(None, f"{hot} and {'a good deal more ' * 8}{w}", w) for w in ("p", "q", "r")], schema)
    assert sorted(r.n_removed for r in line_dedup.deduplicate(near).collect()) == [0, 1, 1]


# ---------------------------------------------------------------- SimHash


def brute_fingerprint(text):
    raw = (text or "").encode()
    ws = raw.lower().split()
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(ws[i : i + 3]), 42) for i in range(len(ws) - 2)] or [xxhash.xxh64_intdigest(b" ".join(ws), 42)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    u = Union()
    ids = {k: i for k, (i, _) in enumerate(fps)}
    for a in range(len(fps)):
        u.find(a)
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= 3:
                u.join(a, b)
    low = {}
    for k, i in ids.items():
        r = u.find(k)
        low[r] = min([x for x in (low.get(r), i) if x is not None], default=None)
    return sorted(((i, f"{f:016x}", low[u.find(k)]) for k, (i, f) in enumerate(fps)), key=str)


def test_simhash_matches_brute_force(spark):
    rng = random.Random(2)
    long = [f"word{rng.randrange(10**6)}" for _ in range(400)]

    def edit(n):
        ws = list(long)
        for _ in range(n):
            ws[rng.randrange(len(ws))] = "edit"
        return " ".join(ws)

    rows = [(i, edit(i % 7)) for i in range(80)]
    rows += [(200, None), (201, ""), (202, " \t\n\r\x0b\x0c "), (203, "One TWO"), (204, "one two"), (205, "é É"), (205, "é É"), (None, edit(0)), (None, "alone é"), (206, "x\x1cy z w"), (300, "a " * 70000)]
    df = spark.createDataFrame([(i, t, "f") for i, t in rows], "doc_id bigint, text string, fp string")
    for segments, max_bits in ((2, 3), (4, 3)):
        got = simhash.near_duplicates(df, segments=segments, max_bits=max_bits).collect()
        assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == brute_components(rows)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    want = {c for _, _, c in brute_components(rows) if c is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 1
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_keep_one_decides_by_row(spark):
    """Rows that share an id or have none are kept or dropped one by one, one of each component."""
    text = lambda k: " ".join(f"{k}word{i}" for i in range(80))
    rows = [(0, text("a")), (5, text("a")), (5, text("b")), (5, text("c")), (6, text("c")), (None, text("b"))]
    rows += [(None, text("d"))] * 30 + [(None, text("e")), (None, text("e").upper()), (8, text("f")), (8, text("f").upper()), (None, None)]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, fp int")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    want = [(0, text("a")), (5, text("b")), (5, text("c")), (None, text("d")), (None, text("e").upper()), (8, text("f").upper()), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_simhash_splits_large_keys(spark):
    """Fingerprints crowded under a few keys, cut into many block pairs, link as without cutting."""
    rng = random.Random(4)
    fps = list({(0xABCDEF << 40) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) for _ in range(300)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    u = Union()
    for a in fps:
        u.find(a)
        for b in fps:
            if (a ^ b).bit_count() <= 3:
                u.join(a, b)
    for block in (8, 1024):
        edges = simhash.links(df, block=block).collect()
        v = Union()
        for f in fps:
            v.find(f)
        for r in edges:
            a, b = r.a & (1 << 64) - 1, r.b & (1 << 64) - 1
            assert (a ^ b).bit_count() <= 3
            v.join(a, b)
        assert all(u.find(f) == v.find(f) for f in fps)


# ------------------------------------------------------------- embeddings


def brute_vectors(rows):
    ok = {}
    for k, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            ok[k] = x / np.linalg.norm(x)
    u, links = Union(), {k: 0 for k in range(len(rows))}
    for a in range(len(rows)):
        u.find(a)
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= 0.93:
                links[a] += 1
                links[b] += 1
                u.join(a, b)
    low = {}
    for k, r in enumerate(rows):
        low[u.find(k)] = min([x for x in (low.get(u.find(k)), r[0]) if x is not None], default=None)
    return [(r[0], links[k], low[u.find(k)]) for k, r in enumerate(rows)]


@pytest.mark.parametrize("block", [512, 4])
def test_embeddings_match_brute_force(spark, block):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(12):
        center = rng.standard_normal(32)
        for _ in range(9):
            rows.append((len(rows), (center + rng.standard_normal(32) * 0.12).tolist(), c % 3))
    rows += [(500 + i, rows[0][1], 0) for i in range(20)]  # equal vectors
    rows += [(600, [2 * x for x in rows[0][1]], 0), (601, rows[0][1], None), (602, None, 0), (603, [0.0] * 32, 0), (604, [float("nan")] * 32, 0), (605, [None] * 32, 0), (606, [], 0)]
    rows += [(607, rows[0][1][:16], 0), (608, [float("inf")] + [1.0] * 31, 0), (500, rows[0][1], 0), (None, rows[40][1], rows[40][2])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, label int, cid int")
    got = embedding_dedup.near_duplicates(df, block=block).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == sorted(brute_vectors(rows), key=str)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_recall_at_the_threshold():
    """Pairs at cosine 0.93 exactly, the worst case, meet in some table in 90 % of cases or more."""
    rng = np.random.default_rng(0)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    n = rng.standard_normal(a.shape)
    n -= (n * a).sum(1, keepdims=True) * a
    n /= np.linalg.norm(n, axis=1, keepdims=True)
    strangers = []
    for size in (1000, 100_000, 10**8):
        tables, projections = embedding_dedup.parameters(size)
        keys = lambda x: embedding_dedup.hash_keys(x, tables, projections)
        for cosine, least in ((0.93, 0.9), (0.96, 0.97), (0.98, 0.99)):
            b = cosine * a + math.sqrt(1 - cosine**2) * n
            met = (keys(a) == keys(b)).any(1).mean()
            assert met >= least, (size, cosine, met)
        strangers.append(sum((keys(a) == np.roll(keys(a), k, axis=0)).sum() for k in range(1, 40)) / (39 * len(a) * tables) * size)
    assert max(strangers) < 10  # strangers that a vector meets in a table: no more with 100000 times the vectors


def test_embedding_links_of_the_test_table(spark):
    """Vectors of the table with copies of many of them, moved to cosines of 0.93 and more."""
    table = spark.read.parquet(f"{SF}/embeddings.parquet").limit(400).collect()
    rng = np.random.default_rng(8)
    rows = [(r.vec_id, list(map(float, r.embedding)), r.label) for r in table]
    for r in list(rows[:200]):
        x = np.array(r[1]) / np.linalg.norm(r[1])
        for _ in range(4):
            n = rng.standard_normal(len(x))
            n -= (n @ x) * x
            c = rng.uniform(0.97, 0.999)
            rows.append((10_000 + len(rows), (c * x + math.sqrt(1 - c * c) * n / np.linalg.norm(n)).tolist(), r[2]))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    want = {i: n for i, n, _ in brute_vectors(rows)}
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df).collect()}
    assert sum(want.values()) >= 2000  # 1000 links, each counted at both ends
    assert sum(got.values()) >= 0.95 * sum(want.values()) and all(got[i] <= want[i] for i in got)


def test_texts_that_are_not_compared_are_not_moved(spark):
    from pyspark.sql import functions as F

    classes = spark.range(20_000).select((F.col("id") * 8_589_934_593).alias("cid"), F.lit("a line").alias("norm"))
    for ids in (classes.filter("cid % 100 = 0").select("cid"), classes.limit(0).select("cid"), classes.select("cid")):
        want = {r.cid for r in ids.collect()}
        likely = line_dedup._likely(classes, ids)
        assert likely.columns == classes.columns
        got = [r.cid for r in likely.collect()]
        assert want <= set(got) and len(got) == len(set(got)) and len(got) <= len(want) * 2
    # in the join that follows, the rows are filtered before they are moved
    plan = likely.join(ids, "cid")._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda word: next(i for i, l in enumerate(plan) if word in l)
    assert depth("rightHint=(strategy=broadcast)") > depth("Join Inner")
