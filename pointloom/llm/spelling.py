"""Groups of spelling variants: words one edit apart, found in a trie of letter-group counts.

Letters are dealt to groups by how often words hold them: the commonest have groups of their own, all rarer ones share the
last. A word's vector counts its letters by group. One edit (a letter put in, taken out or replaced) leaves the vectors
of two words with a surplus of at most one and a deficit of at most one, so words are arranged in a trie of successive
counts, and a depth-first search spends a budget of one surplus and one deficit on its way down. Words at the leaves it
reaches are verified letter by letter.

The trie is cut into cells. Its upper part, branches of more than `CELL` words, is counted with Spark, level by level, and
given to all tasks: at most `UPPER` branches are cut in two at each level, whatever the number of words (`CELL` grows
then). A word is at home in one cell; the same search over the upper part tells which other cells it visits. Of two
cells, words of the lesser visit the greater, so a pair is met once. A cell is one group; its words walk down its own
trie together, a set of searches at a time. What leaves a cell is one row a word: how many near words, and the greatest.

A null text has no words; a null id is hashed as the empty text. Very long texts are taken whole; counts of a group above
255 are taken as 255, which loses no pair. Repeated rows count each. Of near words with equal counts the first in
code-point order is the form. An empty table gives no rows. Other columns of the documents are never read, so none can clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import materialize

GROUPS = 32
#: Words of a cell, and branches of the upper trie that may be cut at each level.
CELL, UPPER = 20_000, 20_000
#: Below this many words a branch of a cell is a leaf.
LEAF = 16
#: Pairs that are verified at a time.
PAIRS = 1 << 20


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 31, least_length: int = 7, least_n: int = 2) -> DataFrame:
    """(word, n): runs of letters, lower-cased in A-Z, of at least `least_length` code points and `least_n` occurrences.

    Where `every` divides the CRC-32 h of `<id>:<run>`, the run loses its code point at h modulo its length.
    """
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least_length)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: Counter = Counter()
            for key, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                body = body.as_py()
                if not body:
                    continue
                seed = zlib.crc32(f"{key}:".encode())
                for run, n in Counter(runs.findall(body.encode("utf-8", "replace").lower().decode())).items():
                    h = zlib.crc32(run.encode(), seed)
                    if h % every == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least_length:
                            continue
                    found[run] += n
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

    held = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.col(f"`{text}`"))
    return held.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


class Words:
    """Words as Latin-1 bytes side by side."""

    def __init__(self, words: list[str]):
        held = [w.encode("latin-1") for w in words]
        self.size = np.array([len(w) for w in held], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(held), dtype=np.uint8)

    def vectors(self, group: np.ndarray) -> np.ndarray:
        n = len(self.size)
        owner = np.repeat(np.arange(n), self.size)
        counts = np.bincount(owner * GROUPS + group[self.data], minlength=n * GROUPS)
        return np.minimum(counts, 255).astype(np.uint8).reshape(n, GROUPS)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of different words are one edit apart: all but one letter of the longer lie in common ends."""
        longest = np.maximum(self.size[a], self.size[b])
        keep = np.abs(self.size[a] - self.size[b]) <= 1
        same = self._common(a, b, 1) if len(a) else longest
        rest = keep & ((same >= longest // 2) | (self._ends(a, b)))
        out = np.zeros(len(a), dtype=bool)
        at = np.flatnonzero(rest)
        if len(at):
            out[at] = same[at] + self._common(a[at], b[at], -1) >= longest[at] - 1
        return out

    def _ends(self, a, b) -> np.ndarray:
        return self.data[self.start[a] + self.size[a] - 1] == self.data[self.start[b] + self.size[b] - 1]

    def _common(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """Length of the common beginning (step 1) or end (step -1)."""
        limit = np.minimum(self.size[a], self.size[b])
        p, q = (self.start[x] if step == 1 else self.start[x] + self.size[x] - 1 for x in (a, b))
        out = limit.copy()
        on = np.arange(len(a))
        t = 0
        while len(on):
            on = on[limit[on] > t]
            equal = self.data[p[on] + step * t] == self.data[q[on] + step * t]
            out[on[~equal]] = t
            on = on[equal]
            t += 1
        return out


#: What is left of a budget (1: a surplus, 2: a deficit, 3: both) beyond an edge, by edge count minus own count plus 2, and budget.
LEFT = np.full((5, 4), 255, dtype=np.uint8)
LEFT[1, 2:] = (0, 1)
LEFT[2] = range(4)
LEFT[3, 1::2] = (0, 2)
LEFT = LEFT.ravel()


def branch(more: np.ndarray, budget: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Searches that may go down an edge with `more` than their own count, and what is left of their budgets."""
    left = LEFT[(np.clip(more, -2, 2) + 2) * 4 + budget]
    at = np.flatnonzero(left < 255)
    return at, left[at]


def visits(vectors: np.ndarray, edges: dict[bytes, list[int]], upper: set[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """(cell, searches that reach it, their budgets): depth first through the upper trie."""
    everyone = np.arange(len(vectors))
    start = np.full(len(vectors), 3, dtype=np.uint8)
    if not upper:
        yield b"", everyone, start
        return
    columns = vectors.T.astype(np.int16)
    stack = [(b"", everyone, start)]
    while stack:
        prefix, who, budget = stack.pop()
        own = columns[len(prefix)][who]
        for count in edges.get(prefix, ()):
            at, left = branch(count - own, budget)
            if len(at):
                child = prefix + bytes([count])
                if child in upper:
                    stack.append((child, who[at], left))
                else:
                    yield child, who[at], left


def search(home: int, vectors: np.ndarray, budget: np.ndarray, depth: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs (search, word): the first `home` rows are words of the trie, all rows search it; each pair once.

    The words agree in their first `depth` counts, and `budget` is what the searches have left beyond them.
    """
    order = np.lexsort(vectors[:home, ::-1].T)
    sorted_ = vectors[order].T.copy()
    columns = vectors.T.astype(np.int16)
    stack = [(0, home, depth, np.arange(len(vectors)), budget)]
    while stack:
        low, high, depth, who, budget = stack.pop()
        if high - low <= LEAF or depth == GROUPS:
            for first in range(low, high, max(1, PAIRS // len(who))):
                words = order[first : min(high, first + max(1, PAIRS // len(who)))]
                a, b = np.repeat(who, len(words)), np.tile(words, len(who))
                once = (a >= home) | (a < b)
                yield a[once], b[once]
            continue
        column = sorted_[depth, low:high]
        cuts = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), high - low]
        own = columns[depth][who]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            at, left = branch(int(column[x]) - own, budget)
            if len(at):
                stack.append((low + x, low + y, depth + 1, who[at], left))


def cell_pairs(words: list[str], home: int, group: np.ndarray, budget: np.ndarray | None = None, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs of a cell: its own words come first, visitors behind them."""
    held = Words(words)
    left, right, waiting, n = [], [], [], 0
    made = search(home, held.vectors(group), np.full(len(words), 3, dtype=np.uint8) if budget is None else budget, depth)

    def verify() -> None:
        a, b = (np.concatenate(x) for x in zip(*waiting, strict=True))
        ok = held.near(a, b)
        left.append(a[ok])
        right.append(b[ok])

    for pair in made:
        waiting.append(pair)
        n += len(pair[0])
        if n >= PAIRS:
            verify()
            waiting, n = [], 0
    if waiting:
        verify()
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def summary(words: list[str], n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """For each word of the pairs: how many near words, and the one of largest n, then first in order."""
    x, y = np.r_[a, b], np.r_[b, a]
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[y], -n[y], x))
    x, y = x[order], y[order]
    first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else x
    count = np.diff(np.r_[first, len(x)])
    pick = lambda i: pa.array([words[k] for k in i], pa.string())
    return pa.RecordBatch.from_arrays(
        [pick(x[first]), pa.array(count.astype(np.int64)), pa.array(n[y[first]]), pick(y[first])], names=["word", "n_near", "best_n", "best"]
    )


def letter_groups(words: DataFrame) -> np.ndarray:
    """Group of each Latin-1 letter, commonest letters first; at most 256 rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, dtype=np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer("".join(b.column(0).to_pylist()).encode("latin-1"), dtype=np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(total)], names=["letter", "n"])

    counted = words.select("word").mapInArrow(run, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(256, dtype=np.int64)
    for r in counted:
        total[r.letter] = r.n
    group = np.empty(256, dtype=np.int64)
    group[np.argsort(-total, kind="stable")] = np.minimum(np.arange(256), GROUPS - 1)
    return group


def upper_trie(coded: DataFrame) -> tuple[dict[bytes, list[int]], set[bytes]]:
    """Edges of the branches with more words than a cell may have, and these branches: bounded by UPPER at each level."""
    spark = coded.sparkSession
    total = coded.count()
    most = max(CELL, total // UPPER)
    edges: dict[bytes, list[int]] = {}
    upper, level = set(), [b""] if total > most else []
    for depth in range(GROUPS):
        if not level:
            break
        upper.update(level)
        here = coded.select(F.substring("vector", 1, depth).alias("p"), F.substring("vector", 1, depth + 1).alias("child"))
        if depth:
            wide = spark.createDataFrame([(bytearray(p),) for p in level], "p binary")
            here = here.join(F.broadcast(wide), "p", "left_semi")  # at most UPPER rows
        counts = here.groupBy("child").count().collect()  # a few for each branch of the level
        level = []
        for r in counts:
            child = bytes(r["child"])
            edges.setdefault(child[:-1], []).append(child[-1])
            if r["count"] > most and depth + 1 < GROUPS:
                level.append(child)
    return edges, upper


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of each word of (word, n) that has near words."""
    group = letter_groups(words)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = Words(b.column(0).to_pylist()).vectors(group)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.FixedSizeBinaryArray.from_buffers(pa.binary(GROUPS), len(v), [None, pa.py_buffer(v.tobytes())]).cast(pa.binary())], names=["word", "n", "vector"])

    coded = materialize(words.select("word", "n").mapInArrow(code, "word string, n long, vector binary"), "vectors")
    edges, upper = upper_trie(coded)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.frombuffer(b"".join(b.column(2).to_pylist()), dtype=np.uint8).reshape(b.num_rows, GROUPS)
            own: list[bytes] = [b""] * b.num_rows
            found = list(visits(v, edges, upper))
            for cell, who, budget in found:
                for i in who[budget == 3]:  # nothing spent: its own counts
                    own[i] = cell
            for cell, who, budget in found:
                met = np.array([own[i] <= cell for i in who])
                if met.any():
                    rows = pa.array(who[met])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([cell] * len(rows), pa.binary()), pa.array(budget[met].astype(np.int8)), b.column(0).take(rows), b.column(1).take(rows)],
                        names=["cell", "budget", "word", "n"],
                    )

    def find(cell: pa.Table) -> pa.Table:
        budget = cell.column("budget").to_numpy().astype(np.uint8)
        order = np.argsort(budget < 3, kind="stable")  # those at home have spent nothing
        words_ = cell.column("word").take(pa.array(order)).to_pylist()
        n = cell.column("n").to_numpy()[order]
        a, b = cell_pairs(words_, int((budget == 3).sum()), group, budget[order], len(cell.column("cell")[0].as_py()))
        return pa.Table.from_batches([summary(words_, n, a, b)])

    dealt = coded.mapInArrow(route, "cell binary, budget byte, word string, n long")
    met = dealt.groupBy("cell").applyInArrow(find, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b")).select(
        "word", "n_near", (-F.col("_b.less")).alias("best_n"), F.col("_b.word").alias("best")
    )


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain, whose length is halved by every round."""
    known = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if known.join(ahead, "root", "left_semi").isEmpty():
            return known
        known = materialize(known.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")


def variants(words: DataFrame, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of each row of (word, n); a form has at least `times` its word's n."""
    near = near_words(words)
    is_form = F.col("best_n") >= times * F.col("n")
    made = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    made = materialize(made, "forms")
    ends = roots(made.where(F.col("form").isNotNull()).select("word", "form"))
    return made.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The same rows in DuckDB SQL: near words share what is left when one letter is taken out.
OP12_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
d AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents),
u AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS hx FROM d WHERE length(run) >= 7 GROUP BY id, run),
c AS (
  SELECT run, n, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(0, len(hx) // 2), lambda i: CAST('0x' || substr(hx, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))),
    lambda c, y: xor(c >> 8, t[CAST(xor(c, y) & 255 AS INTEGER) + 1])), 4294967295) AS h FROM u, crc_table),
r AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
    ELSE run END AS word, n FROM c),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM r WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
o AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS left_ FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT a.word AS a, b.word AS b FROM o a JOIN w b ON a.left_ = b.word
  UNION SELECT b.word, a.word FROM o a JOIN w b ON a.left_ = b.word
  UNION SELECT a.word, b.word FROM o a JOIN o b ON a.left_ = b.left_ AND a.i = b.i AND a.word <> b.word),
q AS (
  SELECT a, count(*) AS n_near, max(w.n) AS best_n, arg_min(b, struct_pack(less := -w.n, word := b)) AS best
  FROM p JOIN w ON p.b = w.word GROUP BY a),
f AS (
  SELECT w.word, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form,
    CASE WHEN best_n >= 10 * w.n THEN CAST(best_n AS BIGINT) END AS form_n
  FROM w LEFT JOIN q ON w.word = q.a),
e AS (
  SELECT word AS start, word AS at FROM f
  UNION ALL SELECT e.start, f.form FROM e JOIN f ON e.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, e.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN e ON f.word = e.start JOIN f z ON z.word = e.at AND z.form IS NULL
"""


def op12_spelling(docs: DataFrame) -> DataFrame:
    """The contract's words and forms."""
    return variants(materialize(word_counts(docs), "words"))
