"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked when few bits differ.

Fingerprint: ASCII lower case, words between white space, shingles of `width` words joined by one space (fewer words: the
whole sequence; none: fingerprint zero), XXH64 with seed 42; a bit is 1 if set in over half the hashes. Null texts count
as empty. Equal texts have equal fingerprints; a fingerprint is one node however many documents have it.

Links: fingerprints that differ in at most `distance` bits agree on at least `blocks - distance` of `blocks` blocks, so
each such choice of blocks is one table keyed by their bits, and any close pair meets in one of them. Buckets are sorted
runs of at most BUCKET fingerprints; a larger bucket is dealt out as pairs of hashed parts. Inside a run all distances are
computed in numpy, and only a spanning forest of the links leaves it, never all pairs. Components of that forest are the
groups; no link between different fingerprints is lost.

Texts are taken whole, whatever their length; rows of one id each count; an empty table gives no rows. `groups` reads id and
text alone; `distinct_documents` keeps all columns, whatever their names. That function, the stage of the corpus pipeline, links
fingerprints as above, checks the links on the shingles, and finds the near copies whose fingerprints scatter (see there).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.llm.chunks import write_chunks
from pointloom.llm.common import STEP_BYTES, components, map_texts, materialize, set_aside
from pointloom.llm.links import forest
from pointloom.llm.textbytes import LOWER, SPACE, encode, mix, parts, words

SEED = 42
#: Most fingerprints that are compared with one another in memory at once.
BUCKET = 4096


def shingle_ranges(owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, last word) of each shingle; a text of fewer words has one of all its words."""
    n = len(owner)
    at = np.arange(n)
    new = np.r_[True, owner[1:] != owner[:-1]] if n else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    size = np.diff(np.r_[begin, n])
    end = np.repeat(begin + size - 1, size)
    full = at + width - 1 <= end
    short = new & (np.repeat(size, size) < width)
    first = at[full | short]
    return first, np.minimum(first + width - 1, end[first])


def joined_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of `data`, each followed by one space, and their places there."""
    size = end - start
    to = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), 32, dtype=np.uint8)
    out[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = data[~SPACE[data]]
    return out.tobytes(), to, to + size


def shingle_hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each shingle, number of its text), texts ascending."""
    data = LOWER[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    start, end, owner = words(data, np.cumsum([len(t) for t in texts]))
    text, begin, stop = joined_words(data, start, end)
    first, last = shingle_ranges(owner, width)
    digest = xxhash.xxh64_intdigest
    hashes = [digest(text[a:b], SEED) for a, b in zip(begin[first].tolist(), stop[last].tolist(), strict=True)]
    return np.array(hashes, dtype=np.uint64), owner[first]


def fingerprints(texts: list[bytes], width: int) -> np.ndarray:
    """Unsigned 64-bit fingerprint of each text."""
    out = np.zeros(len(texts), dtype=np.uint64)
    done = 0
    for s in parts([len(t) for t in texts], STEP_BYTES):
        held = texts[s]
        hashes, owner = shingle_hashes(held, width)
        cuts = np.searchsorted(owner, np.arange(len(held) + 1))
        for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if b > a:
                bits = np.unpackbits(hashes[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones = bits.sum(axis=0, dtype=np.int64) * 2 > b - a
                out[done + i] = np.packbits(ones, bitorder="little").view(np.uint64)[0]
        done += len(held)
    return out


def with_fingerprint(docs: DataFrame, width: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds or replaces fp long: the 64 bits of the fingerprint."""
    return map_texts(
        docs, text, lambda t: [pa.array(fingerprints(encode(t), width).view(np.int64), pa.int64())], "fp long", keep
    )


def block_masks(blocks: int, distance: int) -> list[int]:
    """Masks of all choices of `blocks - distance` of `blocks` blocks of 64 bits, as signed numbers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:], strict=True)]
    masks = [sum(c) for c in combinations(block, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def blocks_for(n: int, distance: int) -> int:
    """Fewest blocks, at least two beyond `distance`, whose keys have about as many values as there are fingerprints."""
    blocks = distance + 2
    while blocks < 16 and 1 << (64 * (blocks - distance) // blocks) < n:
        blocks += 1
    return blocks


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints of any number of 64-bit words (the last axis)."""
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int32)


def run_forest(fp: np.ndarray, side: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links in one run; with two sides, only links between them."""
    across = bool(side.any()) and not side.all()
    rows, cols = (np.flatnonzero(~side), np.flatnonzero(side)) if across else (np.arange(len(fp)),) * 2
    step = max(1, (1 << 20) // max(1, len(cols) * fp.shape[1]))

    def links() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(rows), step):
            a, b = np.nonzero(apart(fp[rows[i : i + step], None], fp[None, cols]) <= distance)
            yield rows[i : i + step][a], cols[b]

    return forest(len(fp), links)


def run_edges(key: np.ndarray, fp: np.ndarray, side: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (index, index) of all runs of equal `key` (sorted). Short runs are compared all at once, by their rows' distance."""
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    size = np.diff(np.r_[begin, len(key)])
    out: list[tuple[np.ndarray, np.ndarray]] = [(begin[:0], begin[:0])]
    short = np.repeat(size <= 32, size)
    for gap in range(1, min(32, len(key))):
        at = np.flatnonzero((key[gap:] == key[:-gap]) & short[gap:])
        if not len(at):
            break
        at = at[apart(fp[at], fp[at + gap]) <= distance]
        out.append((at, at + gap))
    for b, n in zip(begin[size > 32].tolist(), size[size > 32].tolist(), strict=True):
        i, j = run_forest(fp[b : b + n], side[b : b + n], distance)
        out.append((b + i, b + j))
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def links_by_block(keyed: DataFrame, bits: list[str], distance: int) -> DataFrame:
    """(a, b): edges that span the same components as all links of nodes that share a block.

    `keyed` has a row (node, table c, block v, fingerprint words `bits`) for each block of each node.
    """
    large = materialize(
        keyed.groupBy("c", "v").count().where(F.col("count") > BUCKET)
        .select("c", "v", F.ceil(F.col("count") / BUCKET).cast("int").alias("n")), "large"
    )
    dealt = keyed.join(large, ["c", "v"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    )
    names = ["key", "side", "node", *bits]
    dealt = dealt.select(
        F.xxhash64("c", "v", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
        (F.col("own") > F.col("other")).alias("side"), "node", *bits,
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {c: [] for c in names}

        def found(cols: dict[str, np.ndarray]) -> pa.RecordBatch:
            fp = np.stack([cols[c] for c in bits], axis=1).view(np.uint64)
            a, b = run_edges(cols["key"], fp, cols["side"], distance)
            return pa.RecordBatch.from_arrays([pa.array(cols["node"][a]), pa.array(cols["node"][b])], names=["a", "b"])

        for batch in batches:
            new = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(names)}
            if not len(new["key"]):
                continue
            for c in names:
                held[c].append(new[c])
            if new["key"][0] == new["key"][-1] == held["key"][0][0]:
                continue  # still inside one run
            cols = {c: np.concatenate(held[c]) for c in names}
            end = int(np.searchsorted(cols["key"], cols["key"][-1]))
            yield found({c: x[:end] for c, x in cols.items()})
            held = {c: [x[end:]] for c, x in cols.items()}
        if held["key"]:
            yield found({c: np.concatenate(x) for c, x in held.items()})

    return dealt.repartition("key").sortWithinPartitions("key").select(*names).mapInArrow(compare, "a long, b long")


def close_links(nodes: DataFrame, distance: int, blocks: int) -> DataFrame:
    """(a, b): fingerprints of `nodes` (fp) that span the same components as all links of at most `distance` bits."""
    masked = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in block_masks(blocks, distance)])
    keyed = nodes.select(F.col("fp").alias("node"), F.posexplode(masked).alias("c", "v")).withColumn("fp", F.col("node"))
    return links_by_block(keyed, ["fp"], distance)


def groups(docs: DataFrame, width: int, distance: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, component_id for each row of `docs`: the smallest id reachable by links."""
    rows = materialize(
        with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_body")), width, "_body", ["doc_id"]),
        "fingerprints",
    )
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    links = close_links(nodes, distance, blocks_for(nodes.count(), distance))
    roots = components(links)
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = materialize(rooted, "rooted")
    least = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    of = materialize(rooted.join(least, "root").select("fp", "component_id"), "groups")
    return rows.join(of, "fp").select("doc_id", "fp", "component_id")


def op8_simhash(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return groups(docs, width, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: Differing bits up to which fingerprints of the pipeline's documents are linked.
CLOSE = 4
#: Near copies have at least NEAR[0] / NEAR[1] of their distinct shingles in common (Jaccard).
NEAR = (4, 5)
#: Each of TABLES keys of a text joins the least of LEASTS hash functions over its shingles. A pair of similarity s shares
#: none with probability (1 - s^LEASTS)^TABLES: 0.00006 at 0.8, less above, at any number of texts.
TABLES, LEASTS = 32, 6
#: Parts that the members of one key are dealt out in when something is said of all of them.
SALTS = 64
#: Edges of one hub that are checked in one part; a hub of more is sent to several parts, SALTS at most.
EDGES = 32
#: Most texts of either side whose shingles are compared in memory at once.
PART = 1024


def shingle_sets(texts: list[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For parts of the texts: (distinct shingle hashes, ascending in each text; where each text begins, and the end)."""
    for s in parts([len(t) for t in texts], STEP_BYTES):
        held = texts[s]
        hashes, owner = shingle_hashes(held, width)
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        yield hashes[new], np.searchsorted(owner[new], np.arange(len(held) + 1))


def set_keys(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of each text's shingle set, its TABLES keys); texts without words have number 0."""
    seeds = np.random.default_rng(7).integers(0, 2**63, (TABLES, LEASTS), dtype=np.uint64)
    nodes, keys = np.zeros(len(texts), np.uint64), np.zeros((len(texts), TABLES), np.uint64)
    done = 0
    for hashes, cuts in shingle_sets(texts, width):
        some = np.flatnonzero(np.diff(cuts))
        if len(some):
            begin, at = cuts[some], done + some
            nodes[at] = mix(np.add.reduceat(mix(hashes), begin) + np.diff(cuts)[some].astype(np.uint64))
            for t in range(TABLES):
                key = np.full(len(some), t, dtype=np.uint64)
                for seed in seeds[t]:
                    key = mix(key) ^ np.minimum.reduceat(mix(hashes ^ seed), begin)
                keys[at, t] = mix(key)
        done += len(cuts) - 1
    return nodes, keys


def near_links(label: np.ndarray, pivot: np.ndarray, flat: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what all near pairs of a pivot and another set connect, beyond equal labels. Sets: flat[cuts[i] : cuts[i + 1]]."""
    _, flat = np.unique(flat, return_inverse=True)
    size, label = np.diff(cuts), label.copy()
    mark = np.zeros(int(flat.max(initial=0)) + 1, dtype=np.int32)
    found: list[tuple[int, int]] = []
    for i in np.flatnonzero(pivot).tolist():
        if (label == label[i]).all():
            break
        mark[flat[cuts[i] : cuts[i + 1]]] = 1
        both = np.add.reduceat(mark[flat], cuts[:-1])
        mark[flat[cuts[i] : cuts[i + 1]]] = 0
        near = np.flatnonzero((NEAR[1] * both >= NEAR[0] * (size + size[i] - both)) & (label != label[i]))
        others, first = np.unique(label[near], return_index=True)
        found += [(i, j) for j in near[first].tolist()]
        label[np.isin(label, others)] = label[i]
    return np.array([i for i, _ in found], dtype=np.int64), np.array([j for _, j in found], dtype=np.int64)


def _salt(node: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("salt"), node), F.lit(SALTS)).cast("int")


def dealt_edges(edges: DataFrame) -> DataFrame:
    """`edges` (a, b) with the part (salt) of their hub b that they meet: one part for EDGES edges, so that most hubs are sent once."""
    hubs = edges.groupBy("b").agg(F.least(F.ceil(F.count("*") / EDGES), F.lit(SALTS)).alias("parts"))
    return edges.join(hubs, "b").select("a", "b", F.pmod(_salt("a"), F.col("parts")).cast("int").alias("salt"))


#: Gives rows (node, destination `to`) with the node's set of shingles: node, shingles, to.
Sent = Callable[[DataFrame], DataFrame]


def checked(edges: DataFrame, sent: Sent) -> DataFrame:
    """The edges (a, b) whose shingle sets are near. Sets go from their texts straight to the part where they are compared."""
    edges = materialize(dealt_edges(edges), "dealt")
    part = F.struct("b", "salt").alias("to")
    side = lambda c: sent(edges.select(F.col(c).alias("node"), part).distinct()).select(
        *([F.col("node").alias("a")] if c == "a" else []), "to.*", F.col("shingles").alias(f"_{c}")
    )
    both = side("a").join(side("b"), ["b", "salt"]).select(
        "a", "b", F.size(F.array_intersect("_a", "_b")).alias("n"), (F.size("_a") + F.size("_b")).alias("sum")
    )
    return both.where(NEAR[1] * F.col("n") >= NEAR[0] * (F.col("sum") - F.col("n"))).select("a", "b")


def print_links(nodes: DataFrame) -> DataFrame:
    """(a, b): `nodes` whose fingerprints (fp) are equal or linked, by way of the least node of each fingerprint."""
    prints = materialize(nodes.groupBy("fp").agg(F.min("node").alias("hub")), "prints")
    hub = lambda p, c: prints.select(F.col("fp").alias(p), F.col("hub").alias(c))
    links = close_links(prints.select("fp"), CLOSE, blocks_for(prints.count(), CLOSE)).toDF("p", "q")
    close = links.join(hub("p", "a"), "p").join(hub("q", "b"), "q").select("a", "b")
    equal = nodes.join(prints, "fp").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    return close.union(equal)


def bucket_members(keyed: DataFrame) -> DataFrame:
    """(v, hub, node): members of the buckets v of more than one node, with the least of them; of buckets with the same members, one.

    Keys are sent once, as (v, node): most are alone and end there, and only what is left is written.
    """
    w = Window.partitionBy("v")
    shared = keyed.select(
        "v", "node", F.count("*").over(w).alias("n"), F.bit_xor(F.xxhash64("node")).over(w).alias("x"),
        F.min("node").over(w).alias("hub"), F.max("node").over(w).alias("top"),
    ).where("hub < top")
    shared = materialize(shared, "shared")
    buckets = shared.groupBy("n", "x", "hub", "top").agg(F.min("v").alias("v")).select("v")
    return shared.join(buckets, "v", "left_semi").select("v", "hub", "node")


def rest_links(members: DataFrame, roots: DataFrame, sent: Sent) -> DataFrame:
    """(a, b): what the near pairs inside buckets connect beyond `roots`.

    Only buckets whose members have different roots count, and in them only pairs of a member outside the least member's
    component with any member. Both sides are dealt out in parts of PART, so a large component is sent once for each part
    of the few outside it, not once for each of its own parts.
    """
    rooted = members.select("v", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialize(rooted.select("v", _salt("node").alias("salt"), "node", "root"), "members")
    # summed up by part first, and what is known of a key goes back to its parts: no task holds all members of a key
    parted = materialize(rooted.groupBy("v", "salt").agg(
        F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.struct("node", "root")).alias("first")
    ), "parts")
    mixed = parted.groupBy("v").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("first")["root"].alias("home")
    ).where("low < high and n > 2").select("v", "n", "home")  # pairs are compared already
    mixed = parted.select("v", "salt").join(mixed, "v")
    rest = materialize(rooted.join(mixed, ["v", "salt"]).withColumn("pivot", F.col("root") != F.col("home")), "rest")
    outside = rest.where("pivot").groupBy("v", "salt").agg(F.count("*").alias("n")).groupBy("v").agg(F.ceil(F.sum("n") / PART).cast("int").alias("few"))
    sizes = rest.select("v", "salt").distinct().join(outside, "v")
    rest = rest.join(sizes, ["v", "salt"]).withColumn("many", F.ceil(F.col("n") / PART).cast("int"))
    own = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    dealt = rest.where("pivot").withColumn("p", own("few")).withColumn("q", every("many")).select("v", "p", "q", "node", "root", "pivot").union(
        rest.withColumn("q", own("many")).withColumn("p", every("few")).select("v", "p", "q", "node", "root", F.lit(False))
    )

    def compare(t: pa.Table) -> pa.Table:
        node, sets_of = t.column("node").to_numpy(), t.column("shingles").combine_chunks()
        if isinstance(sets_of, pa.ChunkedArray):
            sets_of = pa.concat_arrays(sets_of.chunks)
        cuts = np.r_[0, np.cumsum(sets_of.value_lengths().to_numpy())]
        i, j = near_links(t.column("root").to_numpy(), t.column("pivot").to_numpy(), sets_of.flatten().to_numpy(), cuts)
        return pa.table({"a": pa.array(node[i], pa.int64()), "b": pa.array(node[j], pa.int64())})

    to = F.struct("v", "p", "q", "root", "pivot").alias("to")
    return sent(dealt.select("node", to)).select("to.*", "node", "shingles").groupBy("v", "p", "q").applyInArrow(compare, "a long, b long")


def distinct_documents(docs: DataFrame, width: int = 5) -> DataFrame:
    """One row of each group of near copies, with the columns of `docs`: that of the least doc_id (null last).

    Near: at least NEAR of the distinct word shingles in common. Candidates are the SimHash links of at most CLOSE bits and,
    as fingerprints of pairs near the bound differ in many more bits, pairs that share one of TABLES keys; all links are
    checked on the shingles. First fingerprints and the members of a key's bucket are linked to their least member; then, in
    buckets that are not one component by that, the pairs that could still join two. Sets of
    shingles are told apart by 64 bits of their sum; equal sets, texts without words and null among them, are one group.
    """
    columns = docs.columns
    others = [c for c in columns if c not in ("doc_id", "text")]

    def run(texts) -> list[pa.Array]:
        texts = encode(texts)
        nodes, keys = set_keys(texts, width)
        ends = np.arange(len(nodes) + 1, dtype=np.int32) * TABLES
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64).ravel()))
        return [pa.array(nodes.view(np.int64)), lists, pa.array(fingerprints(texts, width).view(np.int64))]

    marked = map_texts(docs.select(set_aside(others, "_rest"), "doc_id", "text"), "text", run, "_node long, _keys array<long>, _fp long")
    chunks, _ = write_chunks(marked.select("_rest", "doc_id", "text", "_node", "_keys", "_fp"), "text")
    rows = chunks.select("chunk", F.posexplode("row").alias("at", "r")).select(
        F.col("r._node").alias("node"), F.col("r._keys").alias("keys"), F.col("r._fp").alias("fp"),
        F.struct(F.col("r.doc_id").isNull().alias("none"), F.col("r.doc_id").alias("doc_id"), "chunk", "at").alias("place"),
    )
    nodes = materialize(rows.groupBy("node").agg(F.min("place").alias("best"), F.first("keys").alias("keys"), F.min("fp").alias("fp")), "nodes")
    similar = materialize(print_links(nodes.where("node <> 0").select("node", "fp")), "similar")
    keyed = nodes.where("node <> 0").select("node", F.explode("keys").alias("v"))
    members = materialize(bucket_members(keyed), "members")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = lambda c: b.column(b.schema.get_field_index(c))  # noqa: E731, B023
            for i in range(b.num_rows):
                sizes = np.frombuffer(column("sizes")[i].as_py(), dtype=np.int32)
                stop = np.cumsum(np.maximum(sizes, 0)).tolist()
                body, asked, done = column("body")[i].as_py(), column("asked")[i].values, 0
                texts = [body[stop[k] - sizes[k] : stop[k]] for k in asked.field("at").to_pylist()]
                for hashes, cuts in shingle_sets(texts, width):
                    held = asked.slice(done, len(cuts) - 1)
                    lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(hashes.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([held.field("node"), lists, held.field("to")], names=["node", "shingles", "to"])
                    done += len(cuts) - 1

    def sent(wanted: DataFrame) -> DataFrame:
        asked = nodes.join(wanted.groupBy("node").agg(F.collect_list("to").alias("to")), "node").groupBy(F.col("best.chunk").alias("chunk")).agg(
            F.collect_list(F.struct(F.col("best.at").alias("at"), "node", "to")).alias("asked")  # at most the rows of a chunk
        )
        texts = chunks.join(materialize(asked, "asked"), "chunk").select("sizes", "body", "asked")
        rows = texts.mapInArrow(shingled, f"node long, shingles array<long>, to array<{wanted.schema['to'].dataType.simpleString()}>")
        return rows.select("node", "shingles", F.explode("to").alias("to"))

    stars = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    stars = materialize(similar.union(stars).distinct(), "stars")
    links = materialize(checked(stars, sent), "links")
    more = materialize(rest_links(members, components(links), sent), "links")
    roots = components(links.union(more))
    kept = nodes.select("node", "best").join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(
        F.min("best").alias("best")
    ).groupBy(F.col("best.chunk").alias("chunk")).agg(F.collect_list("best.at").alias("kept"))  # at most the rows of a chunk

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = lambda c: b.column(b.schema.get_field_index(c))  # noqa: E731, B023
            for i in range(b.num_rows):
                at = sorted(column("kept")[i].as_py())
                sizes = np.frombuffer(column("sizes")[i].as_py(), dtype=np.int32)
                stop = np.cumsum(np.maximum(sizes, 0)).tolist()
                body, rows = column("body")[i].as_py(), column("row")[i].values.take(pa.array(at))
                texts = [None if sizes[k] < 0 else body[stop[k] - sizes[k] : stop[k]].decode() for k in at]
                made = {"doc_id": rows.field("doc_id"), "text": pa.array(texts, pa.string())}
                rest = rows.field("_rest")
                yield pa.RecordBatch.from_arrays([made[c] if c in made else rest.field(c) for c in columns], names=columns)

    joined = chunks.join(materialize(kept, "kept"), "chunk").select("chunk", "sizes", "body", "row", "kept")
    return joined.mapInArrow(take, docs.schema)
