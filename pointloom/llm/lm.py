"""Language-model scores by deleted interpolation of one-, two- and three-word estimates.

The model's probability of a token is a mixture of maximum-likelihood estimates: that of its three-word context
count(u v w) / count(u v) with weight a, and the lower-order mixture with 1 - a; that in turn of count(v w) / count(v), of
count(w) / N and of one equal share for each known token and one for all others. Weights depend on how often the context
was seen, by powers of two. They are learned by expectation-maximisation: a tenth of the learning documents, by a hash of
the id, is deleted from the counts, and the weights that make it likeliest are found from its counts under what is left.
Scores then use the counts of all learning documents.

Counting is exact over all documents. Texts are written once in chunks (see `chunks`). A chunk sends the sorted hashes of its
distinct n-grams with their counts, cut by the leading bits into buckets, so a common n-gram is sent once a chunk; a bucket
adds up and answers with counts in the same order; answers go back to the chunks. Neither texts nor n-grams are sent.
Buckets hold about `ENTRIES` entries, however large the corpus. Words are told apart by 64 bits and longer
n-grams by 56: of 10^9 words some two are mistaken for each other with a probability of 3 %, and one looked up among 10^9 is
mistaken with 5 * 10^-11, a longer n-gram with 1.4 * 10^-8. An entry is a whole chunk's, so the share of a single n-gram in a
bucket is at most one entry a chunk.

A null or empty text is its end alone. Texts are never cut: a very long one makes a chunk of its own. Repeated rows each count
and each get a row; rows of one id are held out together; a null id is hashed as the empty text. Without learning documents
every token is unknown. Without deleted ones (tiny tables) the weights stay at one half. An empty table gives no rows.
Columns of the documents that have the names of the added ones are replaced; no other name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointloom.llm.chunks import write_chunks
from pointloom.llm.common import STEP_BYTES, materialize, set_aside
from pointloom.llm.textbytes import LOWER, U64, RangeHash, mix, parts, words

CHUNK = 1 << 23
#: Bits of the hashes by length of the n-gram.
BITS = (64, 56, 56)
ENTRIES = 1 << 21
#: Values of the hashes for the end of a text and for what is before it.
END, BEGIN = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
#: Context counts from 2^(b-1) on are of class b; class 0 is an unseen context.
CLASSES = 24
ROUNDS, ENOUGH = 20, 1e-5
KEPT, DELETED, HELD_OUT = range(3)
ADDED = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def pack(values: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers by planes of their bytes, compressed."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return pa.compress(pa.py_buffer(planes), codec="zstd", asbytes=True)


def unpack(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, 8 * n, codec="zstd"), dtype=np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def tokens(body: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, number of tokens of each text); every text ends with END."""
    stops = np.cumsum(sizes)
    made, count, at = [np.zeros(0, dtype=U64)], [np.zeros(0, dtype=np.int64)], 0
    for s in parts(sizes.tolist(), STEP_BYTES):
        some, begin = sizes[s], at
        at = int(stops[s.stop - 1])
        data = LOWER[np.frombuffer(body[begin:at], dtype=np.uint8)]
        n = np.zeros(len(some), dtype=np.int64)
        if len(data):
            start, end, owner = words(data, np.cumsum(some))
            n += np.bincount(owner, minlength=len(some))
        out = np.full(int(n.sum()) + len(some), END)
        if n.any():
            out[np.arange(len(owner)) + owner] = RangeHash(data)(start, end)
        made.append(out)
        count.append(n + 1)
    return np.concatenate(made), np.concatenate(count)


class Tokens:
    """Tokens of a chunk, and their n-grams: grams[k] are the hashes of the k + 1 tokens that end at each place."""

    def __init__(self, body: bytes, sizes: np.ndarray):
        one, self.count = tokens(body, np.maximum(np.frombuffer(sizes, dtype=np.int32), 0).astype(np.int64))
        self.first = np.cumsum(self.count) - self.count
        before = np.r_[BEGIN, one[:-1]]
        before[self.first] = BEGIN
        second = np.r_[BEGIN, before[:-1]]
        second[self.first] = BEGIN
        two = mix(before * U64(0xD1342543DE82EF95) + one)
        three = mix(mix(second * U64(0xAF251AF3B0F025B5) + before) * U64(0xB564EF22EC7AECE5) + one)
        self.grams = [g >> U64(64 - bits) for g, bits in zip((one, two, three), BITS, strict=True)]

    def of(self, documents: np.ndarray) -> np.ndarray:
        """Which places belong to the chosen texts."""
        return np.repeat(documents, self.count)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, dtype=np.int64)
    return values[first], np.diff(np.r_[first, len(values)])


def places(values: np.ndarray) -> np.ndarray:
    """The place of each value among the sorted distinct ones, without a search for each."""
    order = np.argsort(values)
    sorted_ = values[order]
    out = np.empty(len(values), dtype=np.int64)
    out[order] = np.cumsum(np.r_[False, sorted_[1:] != sorted_[:-1]])[: len(values)]
    return out


def cuts(values: np.ndarray, bits: int, width: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes of `width` bits, and their end; the leading `bits` name the bucket."""
    if not bits:
        return np.array([0, len(values)])
    return np.r_[np.searchsorted(values, np.arange(1 << bits, dtype=U64) << U64(width - bits)), len(values)]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Tokens, pa.StructArray, list]]:
    """(chunk, tokens, the texts' other columns, answers) of each row."""
    for b in batches:
        column = lambda c: b.column(b.schema.get_field_index(c))  # noqa: E731, B023
        for i in range(b.num_rows):
            answers = column("answers")[i].as_py() if b.schema.get_field_index("answers") >= 0 else None
            yield column("chunk")[i].as_py(), Tokens(column("body")[i].as_py(), column("sizes")[i].as_py()), column("row")[i].values, answers


def gram_counts(chunks: DataFrame, bits: int) -> DataFrame:
    """What each chunk is answered, and (chunk -1) sums: bucket, chunk, n, counts, deleted, seen, total, seen_kept, total_kept.

    `counts` are those in all learning texts, `deleted` those in the deleted part of them; the sums are of single tokens.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, t, row, _ in _rows(batches):
            kind = row.field("kind").to_numpy(zero_copy_only=False)
            for k, gram in enumerate(t.grams):
                all_ = distinct(gram)[0]
                count = np.zeros((2, len(all_)), dtype=np.int64)
                for j in (KEPT, DELETED):
                    some, n = distinct(gram[t.of(kind == j)])
                    count[j, np.searchsorted(all_, some)] = n
                at = cuts(all_, bits, BITS[k])
                used = np.flatnonzero(np.diff(at))
                spans = [(int(at[u]), int(at[u + 1])) for u in used]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((k << 40) + used, pa.int64()), pa.array([chunk] * len(used), pa.int64()), pa.array([z - a for a, z in spans], pa.int32()),
                        pa.array([pack(np.diff(all_[a:z], prepend=U64(0))) for a, z in spans], pa.binary()),
                        *(pa.array([pack(count[j, a:z]) for a, z in spans], pa.binary()) for j in (KEPT, DELETED)),
                    ],
                    names=["bucket", "chunk", "n", "grams", "kept", "deleted"],
                )

    def answer(t: pa.Table) -> pa.Table:
        n = t.column("n").to_numpy().astype(np.int64)
        bucket = t.column("bucket")[0].as_py()
        read = lambda c: [unpack(x.as_py(), k) for x, k in zip(t.column(c), n.tolist(), strict=True)]
        grams = np.concatenate([np.cumsum(d, dtype=U64) for d in read("grams")])
        known, place = np.unique(grams, return_inverse=True)
        kept, deleted = (np.bincount(place, np.concatenate(read(c)), len(known)).astype(np.int64) for c in ("kept", "deleted"))
        both = (kept + deleted)[place]
        gone = deleted[place]
        stop = np.cumsum(n)
        spans = list(zip((stop - n).tolist(), stop.tolist(), strict=True))
        out = {
            "bucket": [bucket] * len(n), "chunk": t.column("chunk").to_pylist(), "n": n.tolist(),
            "counts": [pack(both[a:z]) for a, z in spans], "deleted": [pack(gone[a:z]) for a, z in spans],
            **{c: [None] * len(n) for c in ("seen", "total", "seen_kept", "total_kept")},
        }
        if bucket >> 40 == 0:
            sums = {
                "bucket": bucket, "chunk": -1, "n": 0, "counts": b"", "deleted": b"", "seen": int((kept + deleted > 0).sum()),
                "total": int((kept + deleted).sum()), "seen_kept": int((kept > 0).sum()), "total_kept": int(kept.sum()),
            }
            for c, v in sums.items():
                out[c].append(v)
        return pa.table(out, schema=pa.schema([
            ("bucket", pa.int64()), ("chunk", pa.int64()), ("n", pa.int32()), ("counts", pa.binary()), ("deleted", pa.binary()),
            *((c, pa.int64()) for c in ("seen", "total", "seen_kept", "total_kept")),
        ]))

    sent = chunks.select("chunk", "sizes", "body", "row").mapInArrow(send, "bucket long, chunk long, n int, grams binary, kept binary, deleted binary")
    return sent.groupBy("bucket").applyInArrow(
        answer, "bucket long, chunk long, n int, counts binary, deleted binary, seen long, total long, seen_kept long, total_kept long"
    )


def answered(chunks: DataFrame, counts: DataFrame, *names: str) -> DataFrame:
    """Chunks with their own answers, which alone are shuffled: one list a chunk."""
    own = counts.where("chunk >= 0").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", *names)).alias("answers"))
    return chunks.join(own, "chunk").select("chunk", "sizes", "body", "row", "answers")


def _read(answers: list[dict], *names: str) -> list[list[np.ndarray]]:
    """For each name and n-gram length the counts in the order of the chunk's sorted distinct n-grams."""
    out: list[list[list[np.ndarray]]] = [[[np.zeros(0, dtype=U64)] for _ in range(3)] for _ in names]
    for a in sorted(answers, key=lambda a: a["bucket"]):
        for made, name in zip(out, names, strict=True):
            made[a["bucket"] >> 40].append(unpack(a[name], a["n"]))
    return [[np.concatenate(x).astype(np.int64) for x in made] for made in out]


def contexts(first: np.ndarray, at: list[np.ndarray], texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the one- and two-token context of each place; before a text begins (`first`), that of all learning texts."""
    one, two = np.r_[texts, at[0][:-1]], np.r_[texts, at[1][:-1]]
    one[first] = texts
    two[first] = texts
    return one, two


def context_class(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(count.astype(np.float64))[1], CLASSES - 1)  # 0, then 1 + floor(log2)


def estimates(first: np.ndarray, at: list[np.ndarray], texts: int, total: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Maximum-likelihood estimates by n-gram length, and the classes of the one- and two-token contexts."""
    one, two = contexts(first, at, texts)
    below = [np.full(len(one), total), one, two]
    return [a / np.maximum(b, 1) for a, b in zip(at, below, strict=True)], [context_class(one), context_class(two)]


def deleted_events(chunks: DataFrame, counts: DataFrame, texts: int, total: int) -> DataFrame:
    """(c2, c1, m3, m2, m1) of each token of the deleted texts: classes of its contexts, estimates from the kept ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t, row, answers in _rows(batches):
            some = t.of(row.field("kind").to_numpy(zero_copy_only=False) == DELETED)
            if not some.any():
                continue
            both, gone = _read(answers, "counts", "deleted")
            at = []
            for gram, a, b in zip(t.grams, both, gone, strict=True):
                at.append((a - b)[np.searchsorted(distinct(gram)[0], gram[some])])  # whole texts, so contexts stay in place
            first = np.searchsorted(np.flatnonzero(some), t.first[some[t.first]])
            m, c = estimates(first, at, texts, total)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x.astype(np.int8)) for x in reversed(c)), *(pa.array(x) for x in reversed(m))],
                names=["c2", "c1", "m3", "m2", "m1"],
            )

    return answered(chunks, counts, "counts", "deleted").mapInArrow(run, "c2 byte, c1 byte, m3 double, m2 double, m1 double")


def learn_weights(events: DataFrame, vocabulary: int) -> list[np.ndarray]:
    """Weights of each estimate by class of its context (single tokens: one class), by expectation-maximisation.

    Each round is one aggregation over all events; CLASSES squared rows at most come to the driver.
    """
    weight = [np.full(n, 0.5) for n in (1, CLASSES, CLASSES)]
    before = None
    pick = lambda w, c: F.element_at(F.array(*[F.lit(float(x)) for x in w]), F.col(c).cast("int") + 1)
    for _ in range(ROUNDS):
        w1, w2, w3 = F.lit(float(weight[0][0])), pick(weight[1], "c1"), pick(weight[2], "c2")
        p = events.select("c1", "c2", "m1", "m2", "m3", w1.alias("w1"), w2.alias("w2"), w3.alias("w3"))
        p = p.withColumn("p1", F.col("w1") * F.col("m1") + (1 - F.col("w1")) / (vocabulary + 1.0))
        p = p.withColumn("p2", F.col("w2") * F.col("m2") + (1 - F.col("w2")) * F.col("p1"))
        p = p.withColumn("p3", F.col("w3") * F.col("m3") + (1 - F.col("w3")) * F.col("p2"))
        low3 = (1 - F.col("w3")) * F.col("p2") / F.col("p3")  # how likely a lower estimate made the token
        low2 = low3 * (1 - F.col("w2")) * F.col("p1") / F.col("p2")
        sums = p.groupBy("c1", "c2").agg(
            F.count("*").alias("n"), F.sum(F.log("p3")).alias("fit"), F.sum(low3).alias("low3"), F.sum(low2).alias("low2"),
            F.sum(low2 * F.col("w1") * F.col("m1") / F.col("p1")).alias("one"),
        ).collect()
        if not sums:
            return weight
        grid = np.zeros((4, CLASSES, CLASSES))
        for r in sums:
            grid[:, r.c1, r.c2] = r.n, r.low3, r.low2, r.one
        n, low3_, low2_, one = grid
        share = lambda part, whole: (part + 0.5) / (whole + 1)  # noqa: E731  never 0 or 1
        weight = [
            np.array([share(one.sum(), low2_.sum())]), share((low3_ - low2_).sum(1), low3_.sum(1)), share((n - low3_).sum(0), n.sum(0)),
        ]
        for w, empty in ((weight[1], n.sum(1) == 0), (weight[2], n.sum(0) == 0)):
            for c in range(2, CLASSES):  # a class without events is like the one below it
                if empty[c]:
                    w[c] = w[c - 1]
        fit = sum(r.fit for r in sums) / n.sum()
        if before is not None and abs(fit - before) < ENOUGH:
            break
        before = fit
    weight[1][0] = weight[2][0] = 0.0  # nothing is known of an unseen context
    return [np.round(w, 6) for w in weight]  # sums of doubles may differ in their last digits between runs


def kinds(doc_id: Column, held_out: Column) -> Column:
    deleted = F.pmod(F.crc32(F.concat(F.lit("deleted:"), F.coalesce(doc_id.cast("string"), F.lit("")))), F.lit(10)) == 0
    return F.when(held_out, HELD_OUT).when(deleted, DELETED).otherwise(KEPT).cast("int")


def lm_scores(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default: all but the text) with held_out, n_tokens, n_known, train_tokens, base_score and score.

    Learns from the documents that are not `held_out` and scores all.
    """
    spark = docs.sparkSession
    new = spark.createDataFrame([], ADDED).schema
    names = {f.name for f in new} | ({text.lower()} if keep is None else set())
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    source = docs.select(
        set_aside(kept, "kept"), kinds(F.col(f"`{doc_id}`"), F.coalesce(held_out, F.lit(False))).alias("kind"), F.col(f"`{text}`").alias("text"),
    )
    chunks, size = write_chunks(source, "text", CHUNK)
    bits = max(0, int(np.ceil(np.log2(max(1, size // 6) / ENTRIES))))
    counts = materialize(gram_counts(chunks, bits), "gram-counts")
    sums = counts.where("chunk = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("seen", "total", "seen_kept", "total_kept")]).first()
    texts = chunks.select(F.explode("row.kind").alias("kind")).groupBy("kind").count().collect()  # three rows
    texts = {r["kind"]: r["count"] for r in texts}
    n_kept, n_all = texts.get(KEPT, 0), texts.get(KEPT, 0) + texts.get(DELETED, 0)
    events = materialize(deleted_events(chunks, counts, n_kept, sums["total_kept"]), "deleted")
    weight = learn_weights(events, sums["seen_kept"])
    total, seen = sums["total"], sums["seen"]
    fields = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    for f in new:
        fields = fields.add(f)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t, row, answers in _rows(batches):
            at = []
            for gram, a in zip(t.grams, _read(answers, "counts")[0], strict=True):
                at.append(a[places(gram)])
            m, c = estimates(t.first, at, n_all, total)
            w1 = float(weight[0][0]) if total else 0.0
            p = w1 * m[0] + (1 - w1) / (seen + 1)
            for k in (1, 2):
                w = weight[k][c[k - 1]]
                p = w * m[k] + (1 - w) * p
            base = np.log10((at[0] + 1) / (total + seen + 1))
            add = lambda x: pa.array(np.add.reduceat(x, t.first))  # noqa: E731, B023
            held = row.field("kept")
            yield pa.RecordBatch.from_arrays(
                [
                    *(held.field(c) for c in kept), pa.array(row.field("kind").to_numpy(zero_copy_only=False) == HELD_OUT), pa.array(t.count),
                    add((at[0] > 0).astype(np.int64)), pa.array(np.full(len(t.count), total)), add(base), add(np.log10(p)),
                ],
                names=fields.names,
            )

    return answered(chunks, counts, "counts").mapInArrow(score, fields)


def op11_lm_scores(docs: DataFrame) -> DataFrame:
    """Learns from the documents whose CRC-32 of the id leaves no 2 modulo 7."""
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2
    return lm_scores(docs, held_out, keep=["doc_id"])
