"""Token counts by a linear longest-match automaton.

Greedy longest-match pieces of a word are counted without building them: a
trie of the vocabulary with failure links, where each node also knows how many
pieces are popped when its link is taken.  A word is read once, character by
character.

Words start with the vocabulary's word marker.  Where no piece fits, a
vocabulary with byte pieces counts the character's UTF-8 bytes; one without
counts the whole word as one unknown token.
"""

from __future__ import annotations

import os
import uuid
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_arrow, utf8_list, worker_state

TOKENIZERS = "/opt/tokenizers"
MODEL = "piece_bpe_32k.model"
MARK = "▁"
_CACHE = 400_000
_LONGEST_CACHED = 64


def load_pieces(folder: str = TOKENIZERS, model: str = MODEL) -> tuple[list[str], bool]:
    """Ordinary pieces of a SentencePiece model, and whether it has byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, model))
    n = sp.get_piece_size()
    plain = [sp.id_to_piece(i) for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return plain, any(sp.is_byte(i) for i in range(n))


class LongestMatch:
    """The automaton: next nodes, failure links and popped counts by node number; node 0 is the root."""

    def __init__(self, pieces: list[str], byte_fallback: bool):
        self.pieces = set(pieces)
        self.longest = max(map(len, pieces), default=0)
        self.bytes = byte_fallback
        self.next: list[dict[str, int]] = [{}]
        whole: list[bool] = [False]
        for p in pieces:
            u = 0
            for c in p:
                v = self.next[u].get(c)
                if v is None:
                    v = len(self.next)
                    self.next[u][c] = v
                    self.next.append({})
                    whole.append(False)
                u = v
            whole[u] = u != 0
        self.link: list[int | None] = [None] * len(self.next)
        self.pops: list[int] = [0] * len(self.next)
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for c, v in self.next[u].items():
                if whole[v]:
                    self.link[v], self.pops[v] = 0, 1
                else:
                    z, n = self.link[u], self.pops[u]
                    while z is not None and c not in self.next[z]:
                        n += self.pops[z]
                        z = self.link[z]
                    if z is not None:
                        self.link[v], self.pops[v] = self.next[z][c], n
                queue.append(v)

    def count(self, text: str) -> int:
        """Number of greedy pieces of a text that already carries its word marker."""
        nxt, link, pops = self.next, self.link, self.pops
        u, n = 0, 0
        for c in text:
            while True:
                v = nxt[u].get(c)
                if v is not None:
                    u = v
                    break
                if u == 0 or link[u] is None:
                    return self._stuck(text)
                n += pops[u]
                u = link[u]
        while u:
            if link[u] is None:
                return self._stuck(text)
            n += pops[u]
            u = link[u]
        return n

    def _stuck(self, text: str) -> int:
        """A word with a character that no piece fits: cut there if bytes can stand for it."""
        if not self.bytes:
            return 1
        n, i = 0, 0
        while i < len(text):
            for k in range(min(self.longest, len(text) - i), 0, -1):
                if text[i : i + k] in self.pieces:
                    n, i = n + 1, i + k
                    break
            else:
                n, i = n + len(text[i].encode()), i + 1
        return n


class _Counts(dict):
    """UTF-8 word -> number of pieces; forgets all when full and never holds very long words."""

    def __init__(self, automaton: LongestMatch):
        self.automaton = automaton

    def __missing__(self, w: bytes) -> int:
        n = self.automaton.count(MARK + w.decode())
        if len(w) <= _LONGEST_CACHED:
            if len(self) >= _CACHE:
                self.clear()
            self[w] = n
        return n


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS, model: str = MODEL) -> DataFrame:
    """(id, n_words, n_tokens, n_bytes) of every whole text.

    Words are separated by ASCII white space.  Null and empty texts have
    none; a null id stays null; repeated rows each get a row, and a table
    without rows gives none.  Very long texts and words are read whole, once.
    Longest match leaves no ties.  Other columns are not read, whatever their
    names.
    """
    pieces = load_pieces(folder, model)
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, pieces))  # a vocabulary: fixed size

    def make():
        key, (plain, fallback) = shared.value
        size = worker_state(("tokens", key), lambda: _Counts(LongestMatch(plain, fallback))).__getitem__

        def fn(b):
            rows = []
            for t in utf8_list(b.column("_text")):
                ws = t.split()
                rows.append((len(ws), sum(map(size, ws)), len(t)))
            return [list(c) for c in zip(*rows)]

        return fn

    df = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    out = append_arrow(df, "n_words bigint, n_tokens bigint, n_bytes bigint", make)
    return out.select(F.col("_id").alias(id_col), "n_words", "n_tokens", "n_bytes")
