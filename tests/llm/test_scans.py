"""Secret scan, decontamination, token counts and WARC against plain Python on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, secret_scan, token_counts, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string, score double, _row int"


def docs_of(spark, rows, extra=("clash", 0.5, 7)):
    """Rows (doc_id, text, source) with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *extra) for i, t, s in rows], DOCS)


ASSIGN = re.compile(r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_spans_match_brute_force(spark):
    hexes = "0123456789abcdef" * 3
    texts = [
        None, "", "é token = 'abcdefg' ñ TOKEN: xyz987 Api_Key=\"" + hexes + '"', "secret: token = abcdefgh", "token=token=abcdef;token=ab",
        "AKIAAKIA" + "A" * 16 + " AKIAshort AKIA" + "B" * 16, hexes + " " + hexes, "password=" + hexes + ",password=" + hexes,
        "passwd:\n abc", "apikey: 'x' api_key == aaaaaaaa 𝄞 secret=zzzzzzzzz", "x" * 50000 + " token=abcdef123 " + "y" * 50000, "tokentoken:abcdef token : = abcdefgh",
    ]
    df = docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in secret_scan.scan(df).collect()}
    for i, t in enumerate(texts):
        want = brute_spans(t)
        assert got[i].spans == want, t
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        kinds = [x.split(":")[0] for x in want.split(",") if x]
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(kinds.count(k) for k in secret_scan.KINDS)


def test_ownership_separates_copied_from_owned(spark):
    rows = [(i, "key token=Example1Wide2Known3 .", f"s{i % 5}") for i in range(200)]  # a third of all rows and more
    rows += [(500, "token=q9Zk2LmXw8Rt own", "s0"), (501, "token=q9Zk2LmXw8Rt own", "s0"), (502, "password=changeme99", "s1"), (None, "token=q1w2e3r4t5y6", None)]
    got = {r.doc_id: r for r in secret_scan.scan(docs_of(spark, rows)).collect()}
    assert (got[0].n_copied, got[0].max_owners) == (1, 5)
    assert (got[500].n_live, got[500].max_owners, got[500].max_repositories) == (1, 1, 1)
    assert got[502].n_placeholder == 1 and got[None].n_live == 1
    assert secret_scan.scan(docs_of(spark, [])).count() == 0
    twice = secret_scan.scan(docs_of(spark, [(1, "token=abcdef1234", "a")] * 2)).collect()
    assert [r.n_assign for r in twice] == [1, 1]


def test_very_many_secrets_in_one_text_take_linear_time(spark):
    import time

    took = []
    for n in (10, 16_000, 64_000):
        text = " ".join(f"token=Abc{i:06d}xyz" for i in range(n))
        df = docs_of(spark, [(1, text, "s")])
        t = time.time()
        r = secret_scan.scan(df).first()
        took.append(time.time() - t)
        assert r.n_assign == n and r.spans == brute_spans(text)
    assert took[1] < 10 and took[2] < 6 * took[1], took


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_hits(text, items, window=10):
    ws = WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, t in items:
        iw = WORD.findall((t or "").translate(LOWER))
        n = min(window, len(iw))
        wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(ws) - n + 1):
            if n and tuple(ws[i : i + n]) in wins:
                hit.update(range(i, i + n))
                found.add("" if item is None else str(item))
    return len(ws), len(hit), sorted(found)


@pytest.mark.parametrize("block_words", [200_000, 25])
def test_decontamination_matches_brute_force(spark, block_words):
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long), (2, "Short ITEM, here"), (3, None), (4, "..."), (5, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 tail"), (5, "again é"), (None, "without id")]
    texts = [
        None, "", long.upper(), "x " + " ".join(long.split()[5:15]) + " y", "short-item/here short item", "again É again é", "w1 w2 w3",
        "a " * 30000 + "short item here", " ".join(long.split()[:9]), "zero without id", long + " " + long, "wordé short item hereé",
    ]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, n_hit int")
    df = docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(2, texts[2], "s")])
    got = decontaminate.contamination(df, bench, ["doc_id"], block_words=block_words).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        n, hit, found = brute_hits(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0), texts[r.doc_id]
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        inside = [w for s in r.spans for w in WORD.findall(texts[r.doc_id][s.start : s.end])]
        assert len(inside) == hit
    none = bench.filter("item_id = 99")
    assert decontaminate.contamination(df, none, ["doc_id"]).filter("contaminated").count() == 0
    clean = decontaminate.keep_clean(df, bench, block_words=block_words)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in got if not r.contaminated}


def greedy(text, pieces, byte_fallback):
    n, i = 0, 0
    while i < len(text):
        for k in range(len(text) - i, 0, -1):
            if text[i : i + k] in pieces:
                n, i = n + 1, i + k
                break
        else:
            if not byte_fallback:
                return 1
            n, i = n + len(text[i].encode()), i + 1
    return n


def test_longest_match_is_greedy():
    import random

    rng = random.Random(5)
    for fallback in (True, False):
        for _ in range(300):
            pieces = {"".join(rng.choices("abcé", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
            auto = token_counts.LongestMatch(sorted(pieces), fallback)
            for _ in range(20):
                t = "".join(rng.choices("abcéx", weights=[4, 4, 4, 2, 1], k=rng.randint(1, 14)))
                assert auto.count(t) == greedy(t, pieces, fallback), (pieces, t)


def test_token_counts_on_documents(spark):
    plain, fallback = token_counts.load_pieces()
    pieces = set(plain)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in token_counts.token_counts(docs).collect():
        ws = texts[r.doc_id].encode().split()
        assert r.n_words == len(ws)
        assert r.n_tokens == sum(greedy("▁" + w.decode(), pieces, fallback) for w in ws)
    edge = token_counts.token_counts(docs_of(spark, [(1, None, "a"), (2, "", "a"), (3, "◊" * 200, "a"), (3, "◊" * 200, "a")]))
    assert sorted((r.doc_id, r.n_words, r.n_tokens) for r in edge.collect()) == [(1, 0, 0), (2, 0, 0), (3, 1, 601), (3, 1, 601)]
    assert token_counts.token_counts(docs_of(spark, [])).count() == 0


def test_warc_round_trip(spark):
    big, other = "<p>é " + "x" * 1200, "y" * 999
    rows = [(1, "http://a/1", big), (2, "http://a/2\r\nX: y", big), (3, None, big), (4, "u", other), (5, "u", other), (6, "u", None), (7, "u", ""), (None, "u", big), (8, "u", "z\r\n\r\nWARC/1.1\r\n" * 300)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, refers_to string")
    folder = warc.folder_for(spark)
    index = warc.write(warc.choose(pages), folder, frame_bytes=2000, bundle_bytes=4000)
    got = {r.page_id: r for r in warc.read(index, folder).collect()}
    assert len(got) == len(rows)
    for page, url, html in rows:
        r, raw = got[page], (html or "").encode()
        assert r.payload_bytes == len(raw) and r.payload_digest == hashlib.sha1(raw).hexdigest()
        want = ("revisit", 3) if page in (1, 2, None) else ("response", None)
        assert (r.record_type, r.refers_to) == want
        assert r.payload == (None if want[0] == "revisit" else raw)
    assert "\r" not in got[2].target_uri and got[3].target_uri is None
    ids = [r.record_id for r in index.collect()][:3]
    for rid, raw in warc.lookup(index, folder, ids):
        assert raw.startswith(b"WARC/1.1\r\n") and rid.encode() in raw and raw.endswith(b"\r\n\r\n")
    assert warc.archive(pages.limit(0)).count() == 0
    plain = {(r.page_id, r.record_type, r.refers_to) for r in warc.archive(pages).collect()}
    assert plain == {(p, got[p].record_type, got[p].refers_to) for p in got}


def test_bundles_are_plain_zstandard(spark, tmp_path):
    """A reader that knows nothing of the seek table gets all records, and frames stand alone."""
    import io

    import zstandard

    class Out(io.BytesIO):
        def close(self):
            pass

    out = Out()
    b = warc.Bundle(out, "b", frame_bytes=300)
    rows, whole = [], b""
    for i in range(20):
        rid, data = warc.record(i, f"u{i}", b"p" * i * 10, None, False)
        whole += data
        rows += b.add(i, rid, data)
    rows += b.close()
    raw = out.getvalue()
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read() == whole
    table = warc.seek_table(io.BytesIO(raw), len(raw))
    by_frame = defaultdict(list)
    for page, _, _, frame, offset, size, at, length in rows:
        assert table[frame][:2] == (offset, size)
        by_frame[frame].append((at, length, page))
    assert len(table) == len(by_frame) > 3
    for frame, recs in by_frame.items():
        at, size, n = table[frame]
        data = zstandard.ZstdDecompressor().decompress(raw[at : at + size])
        assert len(data) == n and [o for o, _, _ in warc.parse(data)] == [r[0] for r in recs]


def test_documents_keep_their_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("_text", F.lit(1))
    n = docs.count()
    assert secret_scan.scan(docs).count() == n and token_counts.token_counts(docs).count() == n
