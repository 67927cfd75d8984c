"""Token counts by linear longest match.

A word (bytes between white space, with one space before it) is cut greedily into the longest vocabulary entries. The
automaton is a trie of the vocabulary with a failure link for each node: when the next byte has no edge, the pieces that
greedy cutting would take off the front of what was read are popped, and the node for the rest follows. How many are
popped is known beforehand, so counting is linear in the bytes and no piece is ever built.

All single bytes must be entries, so every word can be cut. Null and empty texts have no words. Each distinct word of a
step is run once; many words run side by side, byte by byte, and long ones by themselves.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pointloom.llm.common import STEP_BYTES, map_texts
from pointloom.llm.textbytes import RangeHash, encode, parts, words

LONG_WORD = 256


class Automaton:
    """edge[row[node], byte]: next node or -1; fail and popped: by node; flush: pieces left when a word ends at a node."""

    def __init__(self, entries: list[bytes]):
        children: list[dict[int, int]] = [{}]
        ends = [False]
        for entry in entries:
            at = 0
            for c in entry:
                to = children[at].get(c)
                if to is None:
                    to = len(children)
                    children[at][c] = to
                    children.append({})
                    ends.append(False)
                at = to
            if at:
                ends[at] = True
        if any(c not in children[0] or not ends[children[0][c]] for c in range(256)):
            raise ValueError("the vocabulary must hold every single byte")
        n = len(children)
        fail, popped, flush = [0] * n, [0] * n, [0] * n
        queue = list(children[0].values())
        parent = {child: (at, c) for at, edges in enumerate(children) for c, child in edges.items()}
        for node in queue:  # breadth first: links of shorter prefixes are known
            queue.extend(children[node].values())
            if ends[node]:
                popped[node] = 1
            else:
                above, c = parent[node]
                z, pieces = fail[above], popped[above]
                while c not in children[z]:
                    pieces += popped[z]
                    z = fail[z]
                fail[node], popped[node] = children[z][c], pieces
            flush[node] = popped[node] + flush[fail[node]]
        inner = [i for i in range(n) if children[i]]
        self.row = np.full(n, len(inner), dtype=np.int32)  # the last row is that of nodes without edges
        self.row[inner] = np.arange(len(inner))
        self.edge = np.full((len(inner) + 1, 256), -1, dtype=np.int32)
        for r, i in enumerate(inner):
            self.edge[r, list(children[i])] = list(children[i].values())
        self.fail, self.popped, self.flush = (np.array(x, dtype=np.int32) for x in (fail, popped, flush))

    def one(self, word: bytes) -> int:
        at = pieces = 0
        edge, row, fail, popped = self.edge, self.row, self.fail, self.popped
        for c in word:
            to = edge[row[at], c]
            while to < 0:
                pieces += int(popped[at])
                at = fail[at]
                to = edge[row[at], c]
            at = to
        return pieces + int(self.flush[at])

    def many(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each range of `data`, with a space thought before it."""
        size = end - start
        order = np.argsort(-size, kind="stable")
        at = np.full(len(order), self.edge[0, 32], dtype=np.int32)
        pieces = np.zeros(len(order), dtype=np.int64)
        begin, length = start[order], size[order]
        long = int(np.searchsorted(-length, -LONG_WORD, "left")) if len(length) else 0
        for i in range(long):
            pieces[i] = self.one(b" " + data[begin[i] : begin[i] + length[i]].tobytes())
        for t in range(int(length[long]) if long < len(length) else 0):
            active = int(np.searchsorted(-length, -t, "left"))  # those longer than t
            c = data[begin[long:active] + t]
            now = at[long:active]
            to = self.edge[self.row[now], c]
            stuck = np.flatnonzero(to < 0)
            while len(stuck):
                pieces[long + stuck] += self.popped[now[stuck]]
                now[stuck] = self.fail[now[stuck]]
                to[stuck] = self.edge[self.row[now[stuck]], c[stuck]]
                stuck = stuck[to[stuck] < 0]
            at[long:active] = to
        pieces[long:] += self.flush[at[long:]]
        out = np.empty(len(order), dtype=np.int64)
        out[order] = pieces
        return out


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    """From a file of base64 entries and ranks; kept by each worker."""
    with open(path, "rb") as f:
        return Automaton([base64.b64decode(line.split()[0]) for line in f if line.strip()])


def count_texts(texts: list[bytes], a: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """(words, pieces) of each text."""
    n_words, n_pieces = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for s in parts([len(t) for t in texts], STEP_BYTES):
        held = texts[s]
        data = np.frombuffer(b"".join(held), dtype=np.uint8)
        start, end, owner = words(data, np.cumsum([len(t) for t in held]))
        _, which, back = np.unique(RangeHash(data)(start, end), return_index=True, return_inverse=True)
        pieces = a.many(data, start[which], end[which])[back]
        n_words[s] = np.bincount(owner, minlength=len(held))
        n_pieces[s] = np.bincount(owner, pieces, len(held)).astype(np.int64)
    return n_words, n_pieces


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds or replaces n_words long, n_tokens long."""

    def run(texts) -> list[pa.Array]:
        n_words, n_pieces = count_texts(encode(texts), automaton(vocabulary))
        return [pa.array(n_words), pa.array(n_pieces)]

    return map_texts(docs, text, run, "n_words long, n_tokens long", keep)


def op9_token_counts(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_tokens over a byte-level vocabulary of 50,256 entries."""
    import public_tokenizers

    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), keep=["doc_id"])
