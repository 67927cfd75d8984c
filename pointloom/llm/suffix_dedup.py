"""Suffix-array dedup: removes every byte covered by a string of `length` bytes that also starts earlier.

Earlier means a smaller document id, or the same document and an earlier start; strings never cross documents and are
judged on the input. Rows of one id are ordered by their place in the written chunks. A null id comes before all others.
Null and empty texts have nothing to remove (a null text stays null); an empty table gives no rows.

Where which strings meet. In every string of `length` bytes, the gram (short substring) of least hash is its anchor; equal
strings have anchors of equal hash. The starts that share one anchor are neighbours, and the bytes of their strings are
the anchor's context. So strings can only be equal inside contexts of one anchor hash, and:

1. Texts are gathered into chunks (module chunks), written once, bucketed by chunk, and never shuffled.
2. Each chunk sends, by anchor hash, the hash of each context (its first copy in the chunk only). A hash that comes once
   needs no more. Contexts of one anchor count as equal by 63 bits of their hash: among four million different ones of one
   anchor, two agree with a probability of one in a million. Whole copies of an earlier context are duplicates in all their starts: this is the pre-aggregation that
   keeps copies, however many, out of what follows.
3. First copies of contexts that share an anchor with other contexts are sent with their text. A bin of them becomes a
   Burrows-Wheeler transform, on which backward extension of intervals by increasing prefix length, stopped at `length`,
   leaves exactly the groups of equal strings (module bwt). All but the earliest start of a group are duplicates.
4. Each chunk gets its verdicts back (joined by chunk, whose side is already bucketed) and cuts the texts.

Bins hold anchors by hash. Contexts of one anchor beyond BIN bytes are dealt out once more by the hash of each string's
first bytes, so that a passage in a third of all documents doesn't meet in one transform.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.bwt import equal_prefix_groups
from pointloom.llm.chunks import write_chunks
from pointloom.llm.common import STEP_BYTES, materialize, set_aside
from pointloom.llm.textbytes import BASE, INVERSE, U64, mix, parts, powers, windows8

LENGTH = 100
#: Bytes of text in a segment of a very long text, in a bucket of anchors, and in one transform.
SEGMENT = 1 << 19
BUCKET = 1 << 24
BIN = 1 << 20

_NONE = U64(0xFFFFFFFFFFFFFFFF)


def gram_size(length: int) -> int:
    return 32 if length >= 96 else 16 if length >= 48 else 8


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """best over x[i : i + width] for each i."""
    size = 1
    while size * 2 <= width:
        x = best(x[:-size], x[size:])
        size *= 2
    return best(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def _thin(position: np.ndarray, value: np.ndarray, width: int) -> np.ndarray:
    """Keeps of equal neighbours within `width` only as many as leave one in each window; which to keep, as a mask."""
    keep = np.ones(len(position), dtype=bool)
    tied = (value[1:] == value[:-1]) & (position[1:] - position[:-1] < width)
    edge = np.flatnonzero(np.diff(np.r_[False, tied, False].astype(np.int8)))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        run = position[a : b + 1]
        i = 0
        while i < len(run) - 1:
            j = max(i + 1, int(np.searchsorted(run, run[i] + width, "right")) - 1)
            keep[a + i + 1 : a + j] = False
            i = j
    return keep


class Anchors:
    """Anchors of segments laid end to end: segment, value (hash), first and last start, tied, context (hash)."""

    def __init__(self, data: bytes, ends: np.ndarray, length: int):
        gram = gram_size(length)
        width = length - gram + 1
        n = len(data)
        begin = np.r_[0, ends[:-1]]
        h = mix(windows8(data, gram))
        step, size = 3, 8
        while size < gram:
            h = mix(h[:-size] * U64(step) + h[size:])
            size, step = size * 2, step + 2
        h = np.minimum(h[:n], _NONE - U64(1))
        room = np.repeat(ends, ends - begin) - np.arange(n)  # bytes to the end of the segment
        h[room < gram] = _NONE
        least = _slide(np.r_[h, np.full(width - 1, _NONE)], width, np.minimum)
        least[room < length] = 0
        most = _slide(np.r_[np.zeros(width - 1, U64), least], width, np.maximum)
        at = np.flatnonzero((most == h) & (h != _NONE))
        segment = np.searchsorted(ends, at, "right")
        place = at + segment * width  # keeps neighbours in different segments apart
        value = h[at]
        tie = np.zeros(len(at), dtype=bool)
        near = (value[1:] == value[:-1]) & (place[1:] - place[:-1] < width) & (segment[1:] == segment[:-1])
        tie[1:] |= near
        tie[:-1] |= near
        keep = _thin(place, value, width)
        at, segment, place, value, tie = at[keep], segment[keep], place[keep], value[keep], tie[keep]
        first = np.maximum(begin[segment], at - width + 1)
        last = np.minimum(at, ends[segment] - length)
        for s in range(1, len(at)):
            close = place[s:] - place[:-s] < width
            close &= segment[s:] == segment[:-s]
            if not close.any():
                break
            i = np.flatnonzero(close & (value[s:] < value[:-s]))
            last[i] = np.minimum(last[i], at[i + s] - width)
            i = np.flatnonzero(close & (value[:-s] <= value[s:]))
            first[i + s] = np.maximum(first[i + s], at[i] + 1)
        some = last >= first
        self.segment, self.value, self.first, self.last, self.tied = (
            segment[some], value[some], first[some], last[some], tie[some],
        )
        raw = np.frombuffer(data, dtype=np.uint8).astype(U64) + U64(1)
        sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(raw * _POWERS.upto(n), out=sums[1:])
        stop = self.last + length
        self.context = mix(
            (sums[stop] - sums[self.first]) * _BACK.upto(n + 1)[self.first] + (self.last - self.first).astype(U64)
        )


class _Powers:
    def __init__(self, base: int):
        self.base, self.held = base, np.zeros(0, U64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.held) < n:
            self.held = powers(self.base, max(n, STEP_BYTES + 1))
        return self.held[:n]


_POWERS, _BACK = _Powers(BASE), _Powers(INVERSE)


class Chunk:
    """Anchors of all texts of one chunk, in the order of ids; starts count from the chunk's first byte."""

    def __init__(self, body: bytes, sizes: np.ndarray, ids: np.ndarray, length: int):
        self.body, self.length = body, length
        stops = np.cumsum(np.maximum(sizes, 0))
        begins = stops - np.maximum(sizes, 0)
        segments: list[tuple[int, int, int]] = []  # document, from, to
        for i in np.argsort(ids, kind="stable").tolist():
            a, b = int(begins[i]), int(stops[i])
            while b - a >= length:
                to = min(b, a + SEGMENT + length - 1)
                segments.append((i, a, to))
                a += SEGMENT
        made = []
        for s in parts([b - a for _, a, b in segments], STEP_BYTES):
            held = segments[s]
            size = np.array([b - a for _, a, b in held])
            found = Anchors(b"".join(body[a:b] for _, a, b in held), np.cumsum(size), length)
            shift = np.array([a for _, a, _ in held]) - (np.cumsum(size) - size)
            made.append((
                np.array([i for i, _, _ in held])[found.segment], found.value, found.context, found.tied,
                found.first + shift[found.segment], found.last + shift[found.segment],
            ))
        kinds = (np.int64, U64, U64, bool, np.int64, np.int64)
        self.document, self.value, context, tied, self.first, self.last = (
            np.concatenate([m[k] for m in made]) if made else np.zeros(0, kind) for k, kind in enumerate(kinds)
        )
        # 63 bits of the context's hash and whether the context may repeat inside itself
        self.mark = context & ~U64(1) | tied.astype(U64)
        self.ids = ids
        both = np.lexsort((np.arange(len(self.value)), self.mark, self.value))
        new = np.r_[True, (self.value[both][1:] != self.value[both][:-1]) | (self.mark[both][1:] != self.mark[both][:-1])]
        self.is_first = np.zeros(len(self.value), dtype=bool)
        self.is_first[both[new[: len(both)]]] = True

    def sent(self, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, anchors sent there), in order."""
        which = np.flatnonzero(self.is_first)
        bucket = (self.value[which] % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for a, b in zip(cut, [*cut[1:], len(order)], strict=False):
            yield int(bucket[order[a]]), which[order[a:b]]


def _ids(column: pa.Array) -> np.ndarray:
    """Ids as numbers; null is the least."""
    return column.cast(pa.int64()).fill_null(-(2**63)).to_numpy(zero_copy_only=False)


def _chunk_of(batch: pa.RecordBatch, i: int, doc_id: str, length: int) -> Chunk:
    rows = batch.column(batch.schema.get_field_index("row"))[i].values
    sizes = np.frombuffer(batch.column(batch.schema.get_field_index("sizes"))[i].as_py(), dtype=np.int32)
    body = batch.column(batch.schema.get_field_index("body"))[i].as_py()
    return Chunk(body, sizes, _ids(rows.field(doc_id)), length)


def _packed(*arrays: np.ndarray) -> bytes:
    return b"".join(a.tobytes() for a in arrays)


def anchor_codes(chunks: DataFrame, doc_id: str, length: int, buckets: int) -> DataFrame:
    """(chunk, bucket, codes): for each anchor a chunk sends there 0: nothing, 1: all starts repeat, 2: needs its text."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = _chunk_of(batch, i, doc_id, length)
                number, bucket, blob, count = batch.column(0)[i].as_py(), [], [], []
                for b, at in c.sent(buckets):
                    value, mark = c.value[at] // U64(buckets), c.mark[at]
                    ids = c.ids[c.document[at]]
                    bucket.append(b)
                    count.append(len(at))
                    # 5 bytes of the hash, 8 of the context, ids as differences
                    blob.append(_packed(value.astype("<u4"), (value >> U64(32)).astype(np.uint8), mark.astype("<u8"), np.diff(ids, prepend=0)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(bucket), pa.int64()), pa.array(bucket, pa.int64()), pa.array(count, pa.int32()), pa.array(blob, pa.binary())],
                    names=["chunk", "bucket", "n", "blob"],
                )

    def judge(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("chunk").to_numpy())
        chunk = t.column("chunk").to_numpy()[order]
        count = t.column("n").to_numpy()[order].astype(np.int64)
        blobs = t.column("blob").to_pylist()
        value, mark, ids = [], [], []
        for j, n in zip(order.tolist(), count.tolist(), strict=True):
            blob, cut = blobs[j], np.cumsum([0, 4 * n, n, 8 * n, 8 * n]).tolist()
            part = [np.frombuffer(blob[a:b], kind) for a, b, kind in zip(cut[:-1], cut[1:], ("<u4", "u1", "<u8", "<i8"), strict=True)]
            value.append(part[0].astype(U64) | part[1].astype(U64) << U64(32))
            mark.append(part[2].astype(U64))
            ids.append(np.cumsum(part[3]))
        value, mark, ids = np.concatenate(value), np.concatenate(mark), np.concatenate(ids)
        by = np.lexsort((np.arange(len(ids)), ids, mark, value))
        v, m = value[by], mark[by]
        new_value = np.r_[True, v[1:] != v[:-1]]
        new = new_value | np.r_[True, m[1:] != m[:-1]]
        contexts = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_value))[np.cumsum(new_value) - 1]
        code = np.where(~new, 1, np.where((contexts > 1) | (m & U64(1)).astype(bool), 2, 0)).astype(np.uint8)
        out = np.empty(len(by), dtype=np.uint8)
        out[by] = code
        cut = np.r_[0, np.cumsum(count)].tolist()
        return pa.table({
            "chunk": pa.array(chunk, pa.int64()), "bucket": pa.array([t.column("bucket")[0].as_py()] * len(chunk), pa.int64()),
            "codes": pa.array([out[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
        })

    sent = chunks.select("chunk", "sizes", "body", "row").mapInArrow(send, "chunk long, bucket long, n int, blob binary")
    return sent.groupBy("bucket").applyInArrow(judge, "chunk long, bucket long, codes binary")


def _back(chunks: DataFrame, verdicts: DataFrame, *names: str) -> DataFrame:
    """Chunks with all verdicts on them; only the verdicts are shuffled."""
    gathered = verdicts.groupBy("chunk").agg(F.collect_list(F.struct(*names)).alias("verdicts"))
    return chunks.join(gathered, "chunk", "left")


def contexts_and_plans(chunks: DataFrame, codes: DataFrame, doc_id: str, length: int, buckets: int) -> DataFrame:
    """Rows of two kinds. bin >= 0: contexts of a chunk that need comparing. bin -1: what the chunk already knows.

    Of contexts: n, ids, values, text sizes and texts. Of the plan: starts that repeat, and the first start and number
    of starts of each context sent, by bin.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = _chunk_of(batch, i, doc_id, length)
                got = {v["bucket"]: v["codes"] for v in batch.column(batch.schema.get_field_index("verdicts"))[i].as_py() or []}
                number = batch.column(0)[i].as_py()
                code = np.ones(len(c.value), dtype=np.uint8)  # later copies inside the chunk
                bins, blobs, count, begins, spans = [], [], [], [], []
                for b, at in c.sent(buckets):
                    code[at] = np.frombuffer(got[b], dtype=np.uint8)
                    at = at[code[at] == 2]
                    if len(at):
                        first, stop = c.first[at], c.last[at] + length
                        bins.append(b)
                        count.append(len(at))
                        blobs.append(
                            _packed(c.ids[c.document[at]], c.value[at], (stop - first).astype(np.int32))
                            + b"".join(c.body[a:z] for a, z in zip(first.tolist(), stop.tolist(), strict=True))
                        )
                        begins.append(first)
                        spans.append(c.last[at] - first + 1)
                whole = code == 1
                plan = _packed(
                    np.array([int(whole.sum()), len(bins)], dtype=np.int64), c.first[whole], c.last[whole], np.array(bins, dtype=np.int64),
                    np.array(count, dtype=np.int64), np.concatenate([*begins, np.zeros(0, np.int64)]), np.concatenate([*spans, np.zeros(0, np.int64)]),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * (len(bins) + 1), pa.int64()), pa.array([*bins, -1], pa.int64()),
                        pa.array([*count, 0], pa.int32()), pa.array([*blobs, plan], pa.binary()),
                    ],
                    names=["chunk", "bin", "n", "blob"],
                )

    joined = _back(chunks, codes, "bucket", "codes").select("chunk", "sizes", "body", "row", "verdicts")
    return joined.mapInArrow(run, "chunk long, bin long, n int, blob binary")


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For contexts in ascending order: which of their starts repeat a string that starts earlier."""
    size = np.array([len(t) for t in texts])
    begin = np.cumsum(size + 1) - (size + 1)
    symbols = np.frombuffer(b"\xff".join(texts) + b"\xff", dtype=np.uint8) + np.uint8(1)  # UTF-8 has no byte 255
    suffix, group = equal_prefix_groups(symbols, length)
    valid = np.zeros(len(symbols), dtype=np.int8)
    np.add.at(valid, begin, 1)
    np.add.at(valid, begin + size - length + 1, -1)
    keep = np.cumsum(valid, dtype=np.int32)[suffix] > 0
    suffix, group = suffix[keep], group[keep]
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    least = np.minimum.reduceat(suffix, start)
    repeat = np.zeros(len(symbols), dtype=bool)
    repeat[suffix] = True
    repeat[least] = False
    return [repeat[a : a + n - length + 1] for a, n in zip(begin.tolist(), size.tolist(), strict=True)]


def _dealt(value: np.ndarray, texts: list[bytes], length: int) -> list[np.ndarray]:
    """Repeated starts of the contexts of one bin; contexts of one anchor stay together, up to BIN bytes."""
    out: list[np.ndarray | None] = [None] * len(texts)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    order = np.argsort(value, kind="stable")
    cut = np.flatnonzero(np.r_[True, value[order][1:] != value[order][:-1]])
    groups = np.split(order, cut[1:])
    sums = np.add.reduceat(size[order], cut).tolist()
    for s in parts(sums, BIN):
        held = groups[s]
        if len(held) == 1 and sums[s][0] > BIN:
            for i, r in zip(held[0].tolist(), _by_first_bytes([texts[i] for i in held[0].tolist()], length), strict=True):
                out[i] = r
            continue
        members = np.sort(np.concatenate(held))  # order of earlier to later
        for i, r in zip(members.tolist(), repeated_starts([texts[i] for i in members.tolist()], length), strict=True):
            out[i] = r
    return out


def _by_first_bytes(texts: list[bytes], length: int) -> list[np.ndarray]:
    """One anchor's contexts beyond BIN bytes: each start goes, with its own string, to a part by the string's first bytes."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(size) - size
    body = b"".join(texts)
    n_starts = size - length + 1
    owner = np.repeat(np.arange(len(texts)), n_starts)
    at = np.repeat(begin - (np.cumsum(n_starts) - n_starts), n_starts) + np.arange(int(n_starts.sum()))
    count = max(1, -(-len(at) * (length + 1) // BIN))
    part = (mix(windows8(body, 8)[at]) % U64(count)).astype(np.int64)
    repeat = np.zeros(len(at), dtype=bool)
    order = np.argsort(part, kind="stable")
    for s in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        found = repeated_starts([body[a : a + length] for a in at[s].tolist()], length)
        repeat[s] = np.concatenate(found)
    return np.split(repeat, np.cumsum(n_starts)[:-1])


def context_verdicts(contexts: DataFrame, length: int) -> DataFrame:
    """(chunk, bin, repeats): for the contexts that a chunk sent to a bin, one bit a start."""

    def judge(t: pa.Table) -> pa.Table:
        chunk, n = t.column("chunk").to_numpy(), t.column("n").to_numpy().astype(np.int64)
        owner, ids, value, texts = [], [], [], []
        for j, blob in enumerate(t.column("blob").to_pylist()):
            k = int(n[j])
            ids.append(np.frombuffer(blob[: 8 * k], np.int64))
            value.append(np.frombuffer(blob[8 * k : 16 * k], U64))
            stop = np.cumsum(np.frombuffer(blob[16 * k : 20 * k], np.int32)) + 20 * k
            texts += [blob[a:b] for a, b in zip([20 * k, *stop[:-1].tolist()], stop.tolist(), strict=True)]
            owner.append(np.full(k, j))
        owner, ids, value = np.concatenate(owner), np.concatenate(ids), np.concatenate(value)
        order = np.lexsort((np.arange(len(ids)), chunk[owner], ids))
        found = _dealt(value[order], [texts[i] for i in order.tolist()], length)
        by_context: list[np.ndarray] = [found[0]] * len(texts)
        for i, r in zip(order.tolist(), found, strict=True):
            by_context[i] = r
        cut = np.r_[0, np.cumsum(n)].tolist()
        return pa.table({
            "chunk": pa.array(chunk, pa.int64()), "bin": t.column("bin"),
            "repeats": pa.array([np.packbits(np.concatenate(by_context[a:b])).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
        })

    return contexts.where("bin >= 0").groupBy("bin").applyInArrow(judge, "chunk long, bin long, repeats binary")


def _covered(n: int, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    depth = np.zeros(n + 1, dtype=np.int32)
    np.add.at(depth, first, 1)
    np.add.at(depth, stop, -1)
    return np.cumsum(depth[:-1]) > 0


def repeated_bytes(n: int, plan: bytes, verdicts: list[dict], length: int) -> np.ndarray:
    """Which bytes of a chunk go."""
    head = np.frombuffer(plan, dtype=np.int64)
    whole, bins = int(head[0]), int(head[1])
    first, last, rest = head[2 : 2 + whole], head[2 + whole : 2 + 2 * whole], head[2 + 2 * whole :]
    count = rest[bins : 2 * bins]
    total = int(count.sum())
    begin, spans = rest[2 * bins : 2 * bins + total], rest[2 * bins + total :]
    starts, stops = [first], [last + length]
    got = {v["bin"]: v["repeats"] for v in verdicts}
    done = 0
    for b, k in zip(rest[:bins].tolist(), count.tolist(), strict=True):
        begins, span = begin[done : done + k], spans[done : done + k]
        all_starts = np.repeat(begins - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))
        bits = np.unpackbits(np.frombuffer(got[b], np.uint8), count=len(all_starts)).astype(bool)
        starts.append(all_starts[bits])
        stops.append(all_starts[bits] + length)
        done += k
    return _covered(n, np.concatenate(starts), np.concatenate(stops))


def dedup(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", kept: str | None = None) -> DataFrame:
    """All columns of `docs` but its text; n_bytes, n_removed, n_spans, kept_sha256; and, if named, `kept`: what is left.

    In `kept`, a character of which only some bytes are left goes altogether; the digest is of the remaining bytes.
    New columns replace those of the same name.
    """
    if length < 16:
        raise ValueError("length must be 16 at least")
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *([kept] if kept else [])]
    lower = {n.lower() for n in names} | {text.lower()}
    others = [c for c in docs.columns if c.lower() not in lower]
    source = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`"))
    chunks, total = write_chunks(source, text)
    buckets = max(8, -(-total // BUCKET))
    codes = materialize(anchor_codes(chunks, doc_id, length, buckets), "codes")
    sent = materialize(contexts_and_plans(chunks, codes, doc_id, length, buckets), "contexts")
    verdicts = materialize(context_verdicts(sent, length), "repeats")
    plans = sent.where("bin = -1").select("chunk", F.col("blob").alias("plan"))
    schema = docs.select(*[F.col(f"`{c}`") for c in others]).schema
    for n in names:
        schema = schema.add(n, "long" if n in names[:3] else "string")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: E731, B023
            for i in range(batch.num_rows):
                body, sizes = column("body")[i].as_py(), np.frombuffer(column("sizes")[i].as_py(), dtype=np.int32)
                gone = repeated_bytes(len(body), column("plan")[i].as_py(), column("verdicts")[i].as_py() or [], length)
                data = np.frombuffer(body, dtype=np.uint8)
                stop = np.cumsum(np.maximum(sizes, 0))
                removed, spans, digest, left = [], [], [], []
                for size, b in zip(sizes.tolist(), stop.tolist(), strict=True):
                    a = b - max(size, 0)
                    mask = gone[a:b]
                    removed.append(int(mask.sum()))
                    spans.append(int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if removed[-1] else 0)
                    rest = data[a:b][~mask].tobytes() if removed[-1] else body[a:b]
                    digest.append(hashlib.sha256(rest).hexdigest())
                    if kept:
                        left.append(None if size < 0 else rest.decode("utf-8", "ignore"))
                rows = column("row")[i].values
                made = [pa.array(np.maximum(sizes, 0).astype(np.int64)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())]
                if kept:
                    made.append(pa.array(left, pa.string()))
                yield pa.RecordBatch.from_arrays([*[rows.field(c) for c in others], *made], names=schema.names)

    joined = _back(chunks.join(plans, "chunk"), verdicts, "bin", "repeats")
    return joined.select("chunk", "sizes", "body", "row", "plan", "verdicts").mapInArrow(cut, schema)


def op1_suffix_array(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return dedup(docs.select("doc_id", "text"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """Rows of `docs` with their repeated passages cut out, with the columns of `docs`; n_chars follows the text."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    out = dedup(docs.select(set_aside(others, "rest"), "doc_id", "text"), kept="text")
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*[made[c] if c in made else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
