"""Best-fit packing of documents into sequences of a fixed number of tokens.

Each document becomes its token ids and one closing id. Longer ones are cut into full pieces; the first piece takes the
rest. What goes together depends on lengths only, so the packing is planned on the histogram of lengths, which has at
most `capacity` rows whatever the input: pieces above a third of a sequence are matched largest first with the largest
partner that fits, at most two a sequence; smaller ones go, largest first, to the fullest sequence that still has room.
The plan is a list of ranges (length, from rank, sequence, offset). A piece finds its range by its rank among pieces of
its length: running counts inside the task that made it, plus the counts of the tasks before it. No piece is compared with
another and no text is shuffled.

Null and empty texts are the closing id alone. Repeated rows are packed as often as they occur. An empty table gives none.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointloom.llm.common import materialize

CAPACITY = 2048
END_ID = 0
#: Entries of the memory of encoded words that a worker keeps; it is emptied when full.
MEMORY = 400_000

# A space between white spaces, or after one at the end: there a cut before the space would change pieces.
_UNSURE = re.compile(r"\s (?:\s|\Z)")
_SPECIAL = "<|endoftext|>"
# Words of characters that both tokenizers class alike, with no white space but line breaks inside.
_PLAIN = re.compile("[!-~¡-ɏ]+(?:\n+[!-~¡-ɏ]+)*")


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers, equal to those of the tokenizer in `vocabulary`.

    A text is cut before single spaces, where the tokenizer always begins a new piece, and words are remembered. New words
    of Latin letters go, many at once, to the same vocabulary's byte-pair ranks, which give the same ids faster; any other
    word, and any text in which a cut is unsure or that holds a special token, goes to the tokenizer itself.
    """

    def __init__(self, vocabulary: str, ranks: str | None = None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(vocabulary)
        self.fast = None
        self.known: dict[str, bytes] = {}  # by word, each with the space before it
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("bytes", pat_str=_pattern(), mergeable_ranks=table, special_tokens={})
            self.leads = np.zeros(max(table.values()) + 1, dtype=bool)  # ids that begin with a space
            self.leads[[i for t, i in table.items() if t[:1] == b" "]] = True

    def whole(self, text: str) -> bytes:
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Remembers words that are not known yet."""
        if len(self.known) > MEMORY:
            self.known.clear()
        plain = [w for w in words if _PLAIN.fullmatch(w)] if self.fast else []
        if plain:
            ids = np.array(self.fast.encode_ordinary(" " + " ".join(plain)), dtype="<u4")
            begin = np.flatnonzero(self.leads[ids]).tolist()
            raw = ids.tobytes()
            for w, a, b in zip(plain, begin, [*begin[1:], len(ids)], strict=True):
                self.known[w] = raw[4 * a : 4 * b]
        for w in words:
            if w not in self.known:
                self.known[w] = self.whole(" " + w)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _SPECIAL in text or _UNSURE.search(text):
            return self.whole(text)
        first, *words = text.split(" ")
        found = list(map(self.known.get, words))
        if None in found:
            new = [i for i, ids in enumerate(found) if ids is None]
            self.learn(list({words[i] for i in new}))
            for i in new:
                found[i] = self.known[words[i]]
        if self.fast and _PLAIN.fullmatch(first):
            return np.array(self.fast.encode_ordinary(first), dtype="<u4").tobytes() + b"".join(found)
        return self.whole(first) + b"".join(found)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def cut(ids: int, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of each piece of a document of so many ids."""
    if ids <= capacity:
        return np.array([0]), np.array([ids])
    first = ids % capacity or capacity
    start = np.r_[0, np.arange(first, ids, capacity)]
    return start, np.diff(np.r_[start, ids])


def pieces(docs: DataFrame, vocabulary: str, ranks: str | None, capacity: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and (task, nth): the nth piece of its length in that task."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body"))
    schema = source.select("doc_id").schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("task", "integer"), ("nth", "long")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(vocabulary, ranks)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        task = TaskContext.get().partitionId()
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            of, number, starts, lengths, sums, nth = [], [], [], [], [], []
            for i, body in enumerate(batch.column(1)):
                ids = encode(body.as_py()) + end
                start, length = cut(len(ids) // 4, capacity)
                for k, (a, n) in enumerate(zip(start.tolist(), length.tolist(), strict=True)):
                    of.append(i)
                    number.append(k)
                    starts.append(a)
                    lengths.append(n)
                    sums.append(zlib.crc32(ids[4 * a : 4 * (a + n)]))
                    nth.append(int(seen[n]))
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of, pa.int64())), pa.array(number, pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()), pa.array([task] * len(of), pa.int32()),
                    pa.array(nth, pa.int64()),
                ],
                names=schema.names,
            )

    return source.mapInArrow(run, schema)


class Plan:
    """Ranges of ranks by length: where the pieces of a length go. Built from counts by length alone."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for n, c in counts.items():
            self.left[n] = c
        self.given = np.zeros(capacity + 1, dtype=np.int64)
        self.sequences = 0
        #: Sequences by tokens used: list of (first sequence, how many).
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.rows: list[tuple[int, int, int, int]] = []  # length, from rank, first sequence, offset
        self._match()
        self._fill()

    def _put(self, length: int, sequence: int, count: int, offset: int) -> None:
        self.rows.append((length, int(self.given[length]), sequence, offset))
        self.given[length] += count
        self.left[length] -= count

    def _new(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def _match(self) -> None:
        """Pieces above a third: each largest one with the largest partner that still fits."""
        least = self.capacity // 3 + 1
        for x in range(self.capacity, least - 1, -1):
            y = min(x, self.capacity - x)
            while self.left[x] and y >= least:
                n = int(self.left[x] // 2 if y == x else min(self.left[x], self.left[y]))
                if n:
                    s = self._new(n)
                    self._put(x, s, n, 0)
                    self._put(y, s, n, x)
                    self.open[x + y].append((s, n))
                y -= 1
            if n := int(self.left[x]):
                s = self._new(n)
                self._put(x, s, n, 0)
                self.open[x].append((s, n))

    def _fill(self) -> None:
        """Smaller pieces, largest first: to the fullest sequence with room, as long as it has room."""
        for x in range(self.capacity // 3, 0, -1):
            used = self.capacity - x
            while self.left[x]:
                while used > 0 and not self.open[used]:
                    used -= 1
                if used:
                    s, n = self.open[used].pop()
                else:
                    each = self.capacity // x
                    n = -(-int(self.left[x]) // each)
                    s = self._new(n)
                each = (self.capacity - used) // x
                full = min(n, int(self.left[x]) // each)
                for k in range(each if full else 0):
                    self._put(x, s, full, used + k * x)
                if full:
                    self.open[used + each * x].append((s, full))
                if full < n:
                    some = int(self.left[x])
                    for k in range(some):  # fewer than `each`
                        self._put(x, s + full, 1, used + k * x)
                    if some:
                        self.open[used + some * x].append((s + full, 1))
                    if n - full - bool(some):
                        self.open[used].append((s + full + bool(some), n - full - bool(some)))

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(length << 44 | from rank, sequence - from rank, offset), ascending."""
        rows = np.array(sorted(self.rows), dtype=np.int64).reshape(-1, 4)
        return rows[:, 0] << 44 | rows[:, 1], rows[:, 2] - rows[:, 1], rows[:, 3]


def pack(
    docs: DataFrame, vocabulary: str, ranks: str | None = None, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece."""
    spark = docs.sparkSession
    made = materialize(pieces(docs, vocabulary, ranks, capacity, doc_id, text), "pieces")
    by_task = materialize(made.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    before = by_task.select(
        "length", "task",
        (F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )
    plan = spark.sparkContext.broadcast(Plan(counts, capacity).arrays())  # ranges by length and gap: bounded by capacity

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = made.join(before, ["length", "task"]).select(*names, (F.col("before") + F.col("nth")).alias("rank"))
    schema = ranked.select(*names).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sequence, offset = plan.value
        for b in batches:
            rank = b.column("rank").to_numpy()
            i = np.searchsorted(at, b.column("length").to_numpy() << 44 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequence[i] + rank, pa.int64()), pa.array(offset[i], pa.int64())], names=schema.names
            )

    return ranked.mapInArrow(place, schema)


def op3_packing(docs: DataFrame) -> DataFrame:
    """The contract's vocabulary and capacity."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
