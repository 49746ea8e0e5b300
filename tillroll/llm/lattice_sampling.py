"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

All segmentations of a text into pieces form a lattice; with a weight per piece
they have a probability each.  Perturbing every log probability with Gumbel
noise and taking the k largest gives k distinct segmentations sampled without
replacement.  The search is best first over partial segmentations: a node is
the set of segmentations that share a prefix, its priority the largest
perturbed value in that set.  The values are drawn top down: when a node is
opened, one child keeps its value and the others get Gumbel values of their own
mass, truncated at it.  So priorities are exact bounds, and only opened nodes
cost anything.

A node's mass comes from backward sums over the lattice.  Pieces never reach
over a word start or a line feed, so the lattice of a text is a chain of word
lattices, which are built once per distinct word and kept.  Drawing the
completion of a node is one walk down the lattice; the walks of all words of
all texts of a batch advance together, one piece a step, in numpy.

Every draw comes from a counter and the row's key: a text's samples do not
depend on partitioning, batches or retries.

Weights are ``(rank + 2.7) ** -theta`` by the piece's rank in the vocabulary.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import os
import re
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, worker_state

TOKENIZERS = "/opt/tokenizers"
MODEL = "piece_bpe_32k.model"
SAMPLES = 2
THETA = 1.0
MARK = "▁"
_OPEN = 16  # siblings drawn at a time; those further along a path wait together
_EDGES = 1_000_000  # of the word lattices a worker keeps
_WORDS_AT_ONCE = 10_000
_UNIT = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
_M = (1 << 64) - 1


def load_vocabulary(folder: str = TOKENIZERS, model: str = MODEL) -> tuple[dict[str, tuple[int, float]], list[int], int]:
    """(piece -> (id, rank), ids of the 256 byte pieces, size) of a SentencePiece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, model))
    n = sp.get_piece_size()
    pieces = {}
    for i in range(n):
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            p = sp.id_to_piece(i)
            if "\n" in p or re.search(f"[^{MARK}]{MARK}", p):
                raise ValueError(f"piece {p!r} reaches over a word start")
            pieces[p] = (i, -sp.get_score(i))
    return pieces, [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], n


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(key: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) by a mixed key and a step."""
    x = (key + np.uint64(((step + 1) * 0x9E3779B97F4A7C15) & _M)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    x >>= np.uint64(40)
    return x.astype(np.float32) * np.float32(2.0**-24)


class Draws:
    """Uniform numbers in (0, 1) from a 64-bit key and a counter."""

    def __init__(self, key: int):
        self.x = key & _M

    def uniform(self) -> float:
        self.x = (self.x + 0x9E3779B97F4A7C15) & _M
        z = self.x
        z = ((z ^ z >> 30) * 0xBF58476D1CE4E5B9) & _M
        z = ((z ^ z >> 27) * 0x94D049BB133111EB) & _M
        return (((z ^ z >> 31) >> 11) + 0.5) / (1 << 53)

    def below(self, log_mass: float, top: float) -> float:
        """Gumbel value of a set of mass ``exp(log_mass)``, truncated at ``top``."""
        return log_mass - math.log(math.exp(log_mass - top) - math.log(self.uniform()))


class Lattices(dict):
    """word -> first node.  A node is a position in a word, its edges the pieces that start there, longest first.

    Per edge: piece id, next node (-1 at the word's end), probability given
    the node, cumulative probability.  Ids from ``size`` on stand for a
    character without a piece, that is for its UTF-8 bytes.

    Words are noted as they are looked up and built together by
    :meth:`settle`: a trie of the pieces is walked from all their positions at
    once, then the backward sums run from all word ends towards the starts,
    over the edges that there are.  No number of a word depends on the others.
    """

    _CHARS = 10_000  # built at a time, or one word: some 1 KB each while it lasts

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], size: int, theta: float = THETA):
        super().__init__()
        self.byte_ids, self.size = byte_ids, size
        lift = 2.0 * theta  # per character, for numbers near one: cancels in every probability
        self.depth = max(map(len, pieces))
        self.unknown = math.exp(lift) * (size + 2.7) ** -theta
        # the trie: children in a table by node and character class
        letters = sorted({c for p in pieces for c in p})
        self.letter = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        number = {c: i for i, c in enumerate(letters, 1)}
        width = len(letters) + 1
        child: dict[int, int] = {}
        ids, weights = [0], [0.0]
        for p, (i, rank) in pieces.items():
            u = 0
            for c in p:
                k = u * width + number[c]
                v = child.get(k)
                if v is None:
                    v = child[k] = len(ids)
                    ids.append(0)
                    weights.append(0.0)
                u = v
            ids[u], weights[u] = i, math.exp(lift * len(p) - theta * math.log(rank + 2.7))
        self.trie_id, self.trie_weight, self.width = np.array(ids, np.int32), np.array(weights), width
        self.child_keys = np.array(sorted(child), np.int64)
        self.child_nodes = np.array([child[k] for k in self.child_keys.tolist()], np.int32)
        # the letters that most nodes branch on get a dense table, the others are searched
        common = np.bincount(self.child_keys % width, minlength=width).argsort()[::-1][:64]
        self.dense_of = np.full(width, -1, np.int32)
        self.dense_of[common] = np.arange(len(common))
        self.dense = np.zeros((len(ids), len(common)), np.int32)
        at = self.dense_of[self.child_keys % width]
        on = at >= 0
        self.dense[self.child_keys[on] // width, at[on]] = self.child_nodes[on]
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.nodes = self.n_edges = 0
        self.pending: list[str] = []
        self.first, self.count = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.e_id, self.e_next = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.e_p, self.e_cum = np.zeros(0), np.zeros(0, np.float32)

    def __missing__(self, word: str) -> int:
        self.pending.append(word)
        self[word] = -len(self.pending)
        return -len(self.pending)

    def settle(self, starts: np.ndarray) -> np.ndarray:
        """Builds the words noted and replaces their marks in ``starts`` by nodes."""
        if not self.pending:
            return starts
        node = np.empty(len(self.pending), np.int64)
        ends = np.cumsum(np.fromiter(map(len, self.pending), np.int64, len(self.pending)))
        i = held = 0
        while i < len(self.pending):
            j = max(i + 1, int(np.searchsorted(ends, held + self._CHARS, side="right")))
            node[i:j] = self._build(self.pending[i:j])
            i, held = j, int(ends[j - 1])
        self.update(zip(self.pending, node.tolist()))
        self.pending = []
        return np.where(starts < 0, node[-np.minimum(starts, -1) - 1], starts)

    def _step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Trie children, 0 for none."""
        at = self.dense_of[letter]
        out = self.dense[node, at]
        rare = np.flatnonzero(at < 0)
        if len(rare):
            key = node[rare].astype(np.int64) * self.width + letter[rare]
            k = np.minimum(np.searchsorted(self.child_keys, key), len(self.child_keys) - 1)
            out[rare] = np.where((self.child_keys[k] == key) & (letter[rare] > 0), self.child_nodes[k], 0)
        return out

    def _build(self, words: list[str]) -> np.ndarray:
        size = np.fromiter(map(len, words), np.int64, len(words))
        # a slot per character and one for the end of each word
        end = np.cumsum(size + 1) - 1
        start = end - size
        text = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le"), np.uint32)
        n = len(text)
        letter = self.letter[text]
        limit = np.repeat(end, size + 1)
        is_end = np.zeros(n, bool)
        is_end[end] = True
        pos = np.flatnonzero(~is_end)
        at = self._step(np.zeros(len(pos), np.int32), letter[pos])
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # per length: positions, ids, weights
        bare = ~is_end
        for k in range(self.depth):
            on = at > 0
            pos, at = pos[on], at[on]
            w = self.trie_weight[at]
            on = np.flatnonzero(w > 0)
            found.append((pos[on], self.trie_id[at[on]], w[on]))
            on = pos + k + 1 < limit[pos]
            pos, at = pos[on], at[on]
            if not len(pos):
                break
            at = self._step(at, letter[pos + k + 1])
        bare[found[0][0]] = False
        bare = np.flatnonzero(bare)
        codes = text[bare].tolist()
        raws = [chr(c).encode("utf-8", "surrogatepass") for c in codes]
        lone = [self.byte_ids[r[0]] if len(r) == 1 else self.size + c for r, c in zip(raws, codes)]
        single = (bare, np.array(lone, np.int32), np.array([self.unknown ** len(r) for r in raws]))
        count = np.zeros(n, np.int32)
        for pos, _, _ in (*found, single):
            count[pos] += 1
        # edges by their node's distance from the word's end, those of a node side by side, longest first
        pos = np.flatnonzero(~is_end)
        far_off = limit[pos] - pos
        most = int(far_off.max(initial=0))
        rows = pos[np.argsort(far_off.astype(np.uint16) if most < 1 << 16 else far_off, kind="stable")]
        own = count[rows]
        last = np.cumsum(own, dtype=np.int64)
        begin = last - own
        first = np.zeros(n, np.int64)
        first[rows] = begin
        total_edges = int(own.sum())
        weight, ids, to = np.empty(total_edges), np.empty(total_edges, np.int32), np.empty(total_edges, np.int64)
        free = first.copy()
        for length, (pos, i, w) in ((1, single), *reversed(list(enumerate(found, 1)))):
            k = free[pos]
            weight[k], ids[k], to[k] = w, i, pos + length
            free[pos] += 1
        # backward sums
        z = np.zeros(n)
        z[end] = 1.0
        cuts = np.concatenate(([0], np.cumsum(np.bincount(far_off, minlength=1)[1:]))).tolist()
        edge_cuts = [0, *last[np.array(cuts[1:], np.int64) - 1].tolist()]
        for d in range(most):
            r, e = slice(cuts[d], cuts[d + 1]), slice(edge_cuts[d], edge_cuts[d + 1])
            part = weight[e] * z[to[e]]
            total = np.add.reduceat(part, begin[r] - edge_cuts[d])
            z[rows[r]] = total
            weight[e] = part / np.repeat(total, own[r])
            far = np.flatnonzero((total < 1e-100) | (total > 1e100))
            for i in far.tolist():  # of a long word: only ratios to what follows are used
                at = rows[cuts[d] + i]
                z[at : limit[at] + 1][: self.depth] /= total[i]
        # sums along the edges of each node, one edge of all nodes at a time: a node's do not depend on the others
        cum = weight.copy()
        k = begin[own > 1] + 1
        stop = last[own > 1]
        while len(k):
            cum[k] += cum[k - 1]
            k += 1
            more = k < stop
            k, stop = k[more], stop[more]
        cum = cum.astype(np.float32)
        cum[last - 1] = 2.0  # whatever the rounding, the last edge is taken
        nxt = np.where(is_end[to], -1, to + self.nodes)
        p = np.where(np.repeat(own == 1, own), 1.0, weight)
        base = self.nodes
        first += self.n_edges
        for name, new, held in (
            ("first", first, self.nodes),
            ("count", count, self.nodes),
            ("e_id", ids, self.n_edges),
            ("e_next", nxt, self.n_edges),
            ("e_p", p, self.n_edges),
            ("e_cum", cum, self.n_edges),
        ):
            a = getattr(self, name)
            if len(a) < held + len(new):
                b = np.zeros(max(held + len(new), len(a) * 3 // 2), a.dtype)
                b[:held] = a[:held]
                setattr(self, name, b)
                a = b
            a[held : held + len(new)] = new
        self.nodes += n
        self.n_edges += len(p)
        return start + base

    def walk(self, start: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Random completions from nodes: (edges in order, edges per start); draws come from ``key`` and the step."""
        m = len(start)
        on, node = np.arange(m), start
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        counts = np.zeros(m, np.int64)
        step = 0
        while len(on):
            u = _uniform(key[on], step)
            e = self.first[node]
            miss = np.flatnonzero(u >= self.e_cum[e])
            while len(miss):
                e[miss] += 1
                miss = miss[u[miss] >= self.e_cum[e[miss]]]
            steps.append((on, e))
            counts[on] += 1
            node = self.e_next[e]
            more = node >= 0
            on, node = on[more], node[more]
            step += 1
        at = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        for k, (o, e) in enumerate(steps):
            out[at[o] + k] = e
        return out, counts

    def ids(self, edges: np.ndarray) -> np.ndarray:
        """Piece ids of edges, characters without a piece as byte pieces."""
        ids = self.e_id[edges]
        if len(ids) and ids.max() >= self.size:
            ids = np.array([x for i in ids.tolist() for x in ([i] if i < self.size else [self.byte_ids[b] for b in chr(i - self.size).encode()])], np.int32)
        return ids


def units(text: str) -> list[str]:
    """Words of a text with their space marks, and line feeds."""
    return _UNIT.findall(MARK + text.replace(" ", MARK)) if text else []


class _Search:
    """Best-first search of one text: a heap of unopened nodes, and the paths found."""

    def __init__(self, lat: Lattices, words: np.ndarray, key: int):
        self.lat, self.words, self.key = lat, words, key
        self.draws = Draws(key)
        self.heap: list[tuple] = []
        self.paths: list[dict] = []
        self.made = 0

    def _push(self, g: float, kind: str, path: int, at: int, shut: tuple) -> None:
        self.made += 1
        heapq.heappush(self.heap, (-g, self.made, kind, path, at, shut))

    def _rest(self, path: int, at: int) -> float:
        """Log mass of leaving a path at a piece; minus infinity if there is no other piece."""
        p = float(self.paths[path]["p"][at])
        return self.paths[path]["before"](at) + math.log1p(-p) if p < 1.0 else -math.inf

    def _open(self, path: int, at: int, top: float, keep: bool) -> None:
        """Siblings of a path from piece ``at`` on.  keep: one of them has the value ``top`` itself."""
        x = self.paths[path]
        end = min(at + _OPEN, len(x["edges"]))
        masses = [(self._rest(path, i), "rest", i) for i in range(at, end)]
        if end < len(x["edges"]):
            behind = x["log_prob"] - x["before"](end)
            if behind < 0:
                masses.append((x["before"](end) + math.log(-math.expm1(behind)), "tail", end))
        masses = [m for m in masses if m[0] > -math.inf]
        chosen = -1
        if keep and masses:
            high = max(m[0] for m in masses)
            ws = [math.exp(m[0] - high) for m in masses]
            u = self.draws.uniform() * math.fsum(ws)
            for chosen, w in enumerate(ws):
                u -= w
                if u < 0:
                    break
        for i, (mass, kind, k) in enumerate(masses):
            self._push(top if i == chosen else self.draws.below(mass, top), kind, path, k, ())

    def add_path(self, edges: np.ndarray, word_of: np.ndarray, value: float, opened_from: int) -> None:
        p = self.lat.e_p[edges]
        logs = np.log(p)
        head = np.concatenate(([0.0], np.cumsum(logs[: 4 * _OPEN]))).tolist()

        def before(i: int) -> float:
            return head[i] if i < len(head) else float(logs[:i].sum())

        self.paths.append({"edges": edges, "word_of": word_of, "p": p, "before": before, "log_prob": float(logs.sum()), "gumbel": value})
        self._open(len(self.paths) - 1, opened_from, value, keep=False)

    def next_branch(self) -> dict | None:
        """Opens nodes until the best one left is a branch off a known path; what is fixed of it."""
        while self.heap:
            g, _, kind, path, at, shut = heapq.heappop(self.heap)
            g = -g
            if kind == "tail":
                self._open(path, at, g, keep=True)
                continue
            x, lat = self.paths[path], self.lat
            own = int(x["edges"][at])
            # the node of this piece: edges of a node lie side by side
            word = int(x["word_of"][at])
            node = int(self.words[word]) if at == 0 or x["word_of"][at - 1] != word else int(lat.e_next[x["edges"][at - 1]])
            s, n = int(lat.first[node]), int(lat.count[node])
            open_ = [e for e in range(s, s + n) if e != own and e not in shut]
            ps = [float(lat.e_p[e]) for e in open_]
            u = self.draws.uniform() * math.fsum(ps)
            pick = open_[-1]
            for e, p in zip(open_, ps):
                u -= p
                if u < 0:
                    pick = e
                    break
            left = math.fsum(p for e, p in zip(open_, ps) if e != pick)
            if left > 0:
                mass = x["before"](at) + math.log(left)
                self._push(self.draws.below(mass, g), "rest", path, at, (*shut, pick))
            return {"path": path, "at": at, "edge": pick, "value": g, "word": word, "next": int(lat.e_next[pick])}
        return None


def sample(texts: list[str], keys: Iterable[int], lat: Lattices, k: int = SAMPLES) -> list[list[dict]]:
    """Up to ``k`` distinct segmentations per text, by falling perturbed value.

    Each has pieces (ids), log_prob, gumbel and log_inclusion: the logarithm
    of the chance that its perturbed value passes the (k+1)-th one.  Fewer
    than ``k`` where the text has no more.
    """
    if lat.n_edges > _EDGES:
        lat.reset()
    get = lat.__getitem__
    starts = [np.fromiter(map(get, u), np.int64, len(u)) for u in map(units, texts)]
    flat = lat.settle(np.concatenate(starts) if starts else np.zeros(0, np.int64))
    starts = np.split(flat, np.cumsum([len(w) for w in starts])[:-1])
    searches = [_Search(lat, w, key) for w, key in zip(starts, keys)]
    live = [s for s in searches if len(s.words)]
    fixed: list[dict | None] = [None] * len(live)
    for r in range(k):
        # nodes to walk from: of every word for the first sample, behind the branch for later ones
        froms, walk_keys, ranges = [], [], []
        for s, b in zip(live, fixed):
            if b is None:
                nodes, word_ids = s.words, np.arange(len(s.words))
            else:
                nodes, word_ids = s.words[b["word"] + 1 :], np.arange(b["word"] + 1, len(s.words))
                if b["next"] >= 0:
                    nodes = np.concatenate(([b["next"]], nodes))
                    word_ids = np.concatenate(([b["word"]], word_ids))
            froms.append(nodes)
            ranges.append(word_ids)
            salt = np.uint64((s.key + (r + 1) * 0xD1342543DE82EF95) & _M)
            walk_keys.append(mix(word_ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt))
        if not live:
            break
        edges, counts = lat.walk(np.concatenate(froms), np.concatenate(walk_keys))
        word_of = np.repeat(np.concatenate(ranges), counts)
        sizes = np.add.reduceat(np.append(counts, 0), np.cumsum([0] + [len(f) for f in froms[:-1]])) if len(counts) else np.zeros(len(live), np.int64)
        sizes = np.where([len(f) > 0 for f in froms], sizes, 0)
        at = 0
        still, nxt = [], []
        for s, b, n in zip(live, fixed, sizes.tolist()):
            e, w = edges[at : at + n], word_of[at : at + n]
            at += n
            if b is None:
                s.add_path(e, w, -math.log(-math.log(s.draws.uniform())), 0)
            else:
                x, i = s.paths[b["path"]], b["at"]
                e = np.concatenate((x["edges"][:i], [b["edge"]], e))
                w = np.concatenate((x["word_of"][:i], [b["word"]], w))
                s.add_path(e, w, b["value"], i + 1)
            branch = s.next_branch() if r + 1 < k else None
            if branch is not None:
                still.append(s)
                nxt.append(branch)
        live, fixed = still, nxt
    out = []
    for s in searches:
        bar = -s.heap[0][0] if s.heap else -math.inf
        found = []
        for x in s.paths:
            found.append({"pieces": lat.ids(x["edges"]), "log_prob": x["log_prob"], "gumbel": x["gumbel"], "log_inclusion": log_inclusion(x["log_prob"], bar)})
        out.append(found)
    return out


def log_inclusion(log_prob: float, bar: float) -> float:
    """log(1 - exp(-exp(log_prob - bar)))"""
    d = log_prob - bar
    if d > 6:
        return 0.0
    return d if d < -30 else math.log(-math.expm1(-math.exp(d)))


def decode(pieces: Iterable[int], id_to_piece: dict[int, str], byte_ids: list[int]) -> str:
    """Text of a segmentation: pieces joined, byte pieces as UTF-8, marks as spaces, without the leading one."""
    as_byte = {i: b for b, i in enumerate(byte_ids)}
    raw = b"".join(bytes([as_byte[i]]) if i in as_byte else id_to_piece[i].replace(MARK, " ").encode() for i in pieces)
    text = raw.decode("utf-8", errors="replace")
    return text[1:] if text[:1] == " " else text


class Texts:
    """Decodes many segmentations at once: the bytes of every piece by id, and those bytes without a leading space."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], size: int):
        of: list[bytes | None] = [None] * size
        for p, (i, _) in pieces.items():
            of[i] = p.replace(MARK, " ").encode()
        for b, i in enumerate(byte_ids):
            of[i] = bytes([b])
        self.size, self.known = size, np.array([x is not None for x in of])
        of += [x[1:] if x and x[:1] == b" " else x for x in of]
        self.bytes_of = pa.array(of, pa.large_binary())

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """One text per count, of the next so many ids; like :func:`decode`."""
        if len(ids) and not ((ids >= 0) & (ids < self.size)).all() or not self.known[ids].all():
            raise ValueError("an id is no piece of the vocabulary")
        ends = np.cumsum(counts)
        first = (ends - counts)[counts > 0]
        ids = ids.astype(np.int64)
        ids[first] += self.size  # the space that every text starts with goes
        raw = self.bytes_of.take(pa.array(ids))
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        at = offsets[np.concatenate(([0], ends))]
        out = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(at.astype(np.int64).tobytes()), raw.buffers()[2]])
        try:
            return out.cast(pa.string())
        except pa.ArrowInvalid:  # byte pieces that are no UTF-8
            return pa.array([x.decode("utf-8", errors="replace") for x in out.to_pylist()], pa.string())


_PIECES_AT_ONCE = 1_000_000


def decode_texts(df: DataFrame, pieces_col: str = "pieces", out_col: str = "decoded", folder: str = TOKENIZERS, model: str = MODEL) -> DataFrame:
    """``df`` without its column of piece ids and with the text that they stand for behind the others; null ids give a null text.

    An id that is no piece or byte of the vocabulary is an error.
    """
    vocabulary = load_vocabulary(folder, model)
    shared = df.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, vocabulary))  # a vocabulary: fixed size
    others = [c for c in df.columns if c != pieces_col]

    def run(batches):
        token, parts = shared.value
        texts = worker_state(("texts", token), lambda: Texts(*parts))
        for b in batches:
            column = b.column(b.num_columns - 1)
            counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(counts)
            at = 0
            while at < len(counts):
                before = int(ends[at - 1]) if at else 0
                end = max(at + 1, int(np.searchsorted(ends, before + _PIECES_AT_ONCE, side="right")))
                out = texts.decode(flat[before : int(ends[end - 1])], counts[at:end])
                part = b.slice(at, end - at)
                missing = part.column(b.num_columns - 1).is_null()
                if column.null_count:
                    out = pc.if_else(missing, pa.scalar(None, pa.string()), out)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], out], names=[*others, out_col])
                at = end

    schema = T.StructType([*[df.schema[c] for c in others], T.StructField(out_col, T.StringType())])
    return map_arrow(df.select(*others, pieces_col), run, schema)


FIELDS = "sample int, n_pieces bigint, log_prob double, gumbel double, log_inclusion double, pieces_sha256 string"


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    samples: int = SAMPLES,
    theta: float = THETA,
    seed: int = 0,
    with_pieces: bool = True,
    with_source: bool = False,
    with_decoded: bool = False,
    folder: str = TOKENIZERS,
    model: str = MODEL,
) -> DataFrame:
    """Sampled segmentations of every whole text: id, sample (from 1), n_pieces, log_prob, gumbel, log_inclusion, pieces_sha256 [, source_sha256] [, decoded] [, pieces].

    source_sha256 is the digest of the text itself, null as empty; decoded is
    the text that the piece ids give, decoded by the worker that drew them.
    The other digest is of the ids as little-endian 32-bit numbers.  A text
    with one segmentation only has one row; empty and null texts have one row
    without pieces and log_prob 0.  Rows are keyed by id and ``seed``, so
    repeated rows give equal samples and null ids share a key.  Equal perturbed
    values are taken in the order in which the search made them.  Very long
    texts and words are one lattice each, read whole.  Texts hold the space
    mark itself as a space.  A table without rows gives none.  Other columns
    are not read, whatever their names.  Draws on a walk have 24 bits: an edge
    of a probability below 2^-24 given its node may never be drawn there.
    """
    vocabulary = load_vocabulary(folder, model)
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, vocabulary))  # a vocabulary: fixed size
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("\x00")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = [F.sha2(text, 256).alias("_source")] if with_source else []
    df = docs.select(F.col(id_col).alias("_id"), key.alias("_key"), text.alias("_text"), *source)
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches):
        token, (pieces, byte_ids, size) = shared.value
        lat, texts_of = worker_state(("lattices", token, theta), lambda: (Lattices(pieces, byte_ids, size, theta), Texts(pieces, byte_ids, size)))
        for b in batches:
            sizes = pc.utf8_length(b.column("_text")).to_pylist()
            keys = b.column("_key").to_numpy().view(np.uint64).tolist()
            at = 0
            while at < len(sizes):
                end, held = at, 0
                while end < len(sizes) and (end == at or held + sizes[end] // 6 <= _WORDS_AT_ONCE):
                    held += sizes[end] // 6
                    end += 1
                found = sample(b.column("_text").slice(at, end - at).to_pylist(), keys[at:end], lat, samples)
                rows: list[list] = [[] for _ in range(7)]
                for i, paths in enumerate(found, at):
                    if not paths:
                        paths = [{"pieces": np.zeros(0, np.int32), "log_prob": 0.0, "gumbel": None, "log_inclusion": 0.0}]
                    for r, x in enumerate(paths, 1):
                        ids = x["pieces"]
                        sha = hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest() if len(ids) else empty
                        for c, v in zip(rows, (i, r, len(ids), x["log_prob"], x["gumbel"], x["log_inclusion"], sha)):
                            c.append(v)
                take = pa.array(rows[0], pa.int64())
                cols = [b.column("_id").take(take), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64())]
                cols += [pa.array(c, pa.float64()) for c in rows[3:6]] + [pa.array(rows[6], pa.string())]
                names = ["_id", "sample", "n_pieces", "log_prob", "gumbel", "log_inclusion", "pieces_sha256"]
                if with_source:
                    cols.append(b.column("_source").take(take))
                    names.append("source_sha256")
                if with_decoded or with_pieces:
                    flat = [x["pieces"] for paths in found for x in (paths or [{"pieces": np.zeros(0, np.int32)}])]
                if with_decoded:
                    cols.append(texts_of.decode(np.concatenate(flat), np.array([len(f) for f in flat], np.int64)))
                    names.append("decoded")
                if with_pieces:
                    ends = np.cumsum([0] + [len(f) for f in flat]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat).astype(np.int32))))
                    names.append("pieces")
                yield pa.RecordBatch.from_arrays(cols, names=names)
                at = end

    id_type = df.schema["_id"].dataType.simpleString()
    schema = f"_id {id_type}, {FIELDS}" + (", source_sha256 string" if with_source else "") + (", decoded string" if with_decoded else "") + (", pieces array<int>" if with_pieces else "")
    out = map_arrow(df, run, schema)
    return out.withColumnRenamed("_id", id_col)
