"""License scan against plain Python: every rule on every text, intervals compared pairwise."""

from __future__ import annotations

import random
import re
import time
from re import _constants as C
from re import _parser

from tillroll.llm import license_rules as R
from tillroll.llm import license_scan as S

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RULES = R.standard_rules()
SCHEMA = "doc_id bigint, text string, labels string, hits int, _row int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], SCHEMA)


def brute(text, rules=RULES):
    """(n_words, base places, base labels, labels, detections left, score)"""
    ws = WORD.findall((text or "").translate(LOWER))
    norm = " " + " ".join(ws) + " "
    hits = []
    for rule, (label, tier, _, body) in enumerate(rules):
        for m in re.finditer(f" ({body})(?= )", norm):
            s = norm[: m.start() + 1].count(" ") - 1
            hits.append((s, s + m[1].count(" ") + 1, tier, rule, label))
    stronger = lambda a, b: b[0] <= a[0] and b[1] >= a[1] and (b[2], a[1] - a[0] - (b[1] - b[0]), b[3]) < (a[2], 0, a[3])
    left = [h for h in hits if not any(stronger(h, b) for b in hits)]
    base = [h for h in hits if h[3] < R.N_BASE]
    named = base + left
    return len(ws), sorted(h[0] for h in base), sorted({h[4] for h in base}), sorted({h[4] for h in named}), len(left), max((R.CONFIDENCE[h[2]] for h in named), default=0.0)


def sample(parsed, rng) -> str:
    """A random text that a rule's expression matches."""
    out = ""
    for op, arg in parsed:
        if op is C.LITERAL:
            out += chr(arg)
        elif op is C.IN:
            out += "w" if arg[0][0] is C.NEGATE else chr(rng.choice([a for o, a in arg if o is C.LITERAL]))
        elif op is C.NOT_LITERAL:
            out += "w"
        elif op is C.BRANCH:
            out += sample(rng.choice(arg[1]), rng)
        elif op is C.SUBPATTERN:
            out += sample(arg[3], rng)
        elif op is C.MAX_REPEAT:
            low, high, sub = arg
            out += "".join(sample(sub, rng) for _ in range(rng.randint(low, min(high, low + 3))))
        else:
            raise AssertionError(op)
    return out


def samples(seed=0, each=3):
    rng = random.Random(seed)
    return [sample(_parser.parse(body), rng) for _, _, _, body in RULES for _ in range(each)]


def test_every_text_a_rule_matches_holds_its_keyword():
    rng = random.Random(1)
    assert len(RULES) >= 300 and len(set(RULES)) == len(RULES)
    for label, _, keyword, body in RULES:
        parsed = _parser.parse(body)
        for _ in range(40):
            assert f" {keyword} " in f" {sample(parsed, rng)} ", (label, keyword, body)
        assert S.gate_word(keyword) in keyword.split()


def test_scan_matches_brute_force(spark):
    rng = random.Random(2)
    texts = samples()
    texts += [" ".join(rng.sample(texts, 4)) for _ in range(150)]
    texts += ["The\nMIT-License; cc BY cc_by, CC-BY 4.0", "gnu general public license " * 3, "ÉcoleMIT license", "mit license", "mit licensé", "kmit license K"]
    texts += [None, "", " \n.", "licence", texts[0], texts[0]]
    df = table(spark, list(enumerate(texts)) + [(None, texts[0])])
    rows = S.scan(df).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        text = texts[0] if r.doc_id is None else texts[r.doc_id]
        n, base, base_labels, labels, left, score = brute(text)
        assert (r.n_words, r.n_base, r.n_detections, r.score) == (n, len(base), left, score), text
        assert (r.first_word, r.last_word) == ((base[0], base[-1]) if base else (None, None))
        assert (r.base_labels, r.labels) == (",".join(base_labels), ",".join(labels)), text


def test_suppression_and_detections(spark):
    text = "x GNU Affero General Public License, version 3 y apache license, version 2.0 z SPDX-License-Identifier: GPL-3.0-or-later"
    found = {(r.label, r.start, r.end) for r in S.detections(table(spark, [(1, text)]), ["doc_id"]).collect()}
    assert found == {("agpl-3.0", 1, 8), ("apache-2.0", 9, 14), ("gpl-3.0-or-later", 15, 23)}


def test_many_matches_in_one_text_are_linear(spark):
    def took(n):
        t = time.time()
        r = S.scan(table(spark, [(1, "cc by 4.0 mit license " * n)])).first()
        assert (r.n_base, r.n_detections, r.first_word, r.last_word) == (2 * n, 2 * n, 0, 6 * n - 2)
        return time.time() - t

    took(10)
    assert took(16_000) < 15


def test_empty_table(spark):
    assert S.scan(table(spark, [])).count() == 0
