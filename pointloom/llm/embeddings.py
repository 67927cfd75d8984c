"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one representative a group.

Vectors are compared only within a label. Equal vectors of a label are one node with a weight, so copies are never
compared with one another. Cells are the nearest of `k` unit centroids, fitted on a bounded sample (SAMPLE_VALUES
components); every node is put into its own cell, once. Packs hold the nodes of neighbouring cells of a label, BLOCK nodes
or PACK_BYTES at most or little more; a cell beyond that is dealt out to several packs by hash. Nothing is lost at the
borders: for linked x and y of cells A and B, the distances of both to the plane between the two centroids add up to at
most |x - y| <= sqrt(2 - 2 t), so both lie within that, and one of the two within half of it: it is a guest of the other's
cell. Packs of a label meet in pairs, unless no node of either is a guest of a cell of the other, and guests are multiplied
with members in blocks. A pack is written once and read again for each meeting, so the disk needed grows with the nodes,
not with the meetings or guests. Counts and a spanning forest of links leave a task, never the pairs.

Products are taken in single precision first; where one is not clearly below the threshold, double precision decides.

Vectors that are null or zero, or hold null or non-finite components, and vectors of null label link with nothing: they
are their own component, kept. Vectors of different length don't link. Repeated rows are other vectors that are equal. A
row of null id has the least id of its component, or null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from pointloom.llm.common import components, materialize
from pointloom.llm.links import forest

THRESHOLD = 0.93
#: Nodes of the largest label that one cell should hold; most cells; components in the sample; nodes in one pack.
CELL = 512
MOST_CELLS = 4096
SAMPLE_VALUES = 2_000_000
BLOCK = 2048
#: Bytes of vectors in one pack, of packs in one partition, products at once, edges that a task holds.
PACK_BYTES = 8 << 20
PART_BYTES = 32 << 20
STEP = 1 << 21
EDGES = 1 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def matrix(values: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an Arrow list column of vectors of one length."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def unit(x: np.ndarray, kind: type = np.float64) -> np.ndarray:
    """Rows of length one."""
    x = x.astype(np.promote_types(x.dtype, kind))
    x = (x / np.abs(x).max(axis=1, keepdims=True)).astype(kind)  # neither overflow nor underflow in squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def slack(d: int) -> float:
    """More than single precision can be wrong by in a product of unit vectors of d components."""
    return (d + 16) * 2.0**-21


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """k unit centroids of unit rows; an empty cell takes the row that is farthest from its centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = x @ c.T
        own = near.argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.sqrt((total * total).sum(axis=1))
        far = iter(np.argsort(near[np.arange(len(x)), own]))
        for j in np.flatnonzero(size < 1e-12):
            total[j] = x[next(far)]
            size[j] = 1.0
        c = total / size[:, None]
    return c


def chained(c: np.ndarray) -> np.ndarray:
    """The centroids in an order in which each is followed by the nearest of those left, so that packs hold neighbours."""
    order, left = [0], np.ones(len(c), bool)
    left[0] = False
    while left.any():
        order.append(int(np.where(left, c @ c[order[-1]], -np.inf).argmax()))
        left[order[-1]] = False
    return c[order]


def cells_of(x: np.ndarray, c: np.ndarray, threshold: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """(own cell, cells to visit as a guest) of unit rows."""
    near = x @ c.T
    own = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * (c[own] @ c.T), 0))
    reach = np.sqrt(max(2 - 2 * threshold, 0)) / 2 + 1e-9
    guest = near[np.arange(len(x)), own][:, None] - near <= reach * apart + slack(x.shape[1])
    guest[np.arange(len(x)), own] = False
    row, cell = np.nonzero(guest)
    return own, np.split(cell, np.searchsorted(row, np.arange(1, len(x))))


def steps(x: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    """Places of the rows of x, in parts whose products with c are few enough; none if c are of another length."""
    return np.array_split(np.arange(len(x)), max(1, min(len(x), len(x) * len(c) >> 20))) if x.shape[1] == c.shape[1] else []


def own_cells(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Own cell of each row; vectors of another length than the centroids are all in cell 0."""
    own = np.zeros(len(x), np.int32)
    for at in steps(x, c):
        own[at] = (unit(x[at]) @ c.T).argmax(axis=1)
    return own


def pack_nodes(d: int, block: int) -> int:
    """Nodes of d components that a pack should hold."""
    return max(1, min(block, PACK_BYTES // (8 * d)))


def cuts(t: pa.Table, block: int) -> pa.Table:
    """Where the packs of a label begin, by cell and share of the cell, from the number of nodes of each of its cells."""
    t = t.sort_by("own")
    own, count, d = t.column("own").to_numpy(), t.column("count").to_numpy(), t.column("d")[0].as_py()
    end = np.cumsum(count)
    packs = -(-int(end[-1]) // pack_nodes(d, block))
    at = np.arange(1, packs) * end[-1] / packs
    cell = np.searchsorted(end, at, side="right")
    begin = own[cell] + (at - (end - count)[cell]) / count[cell]
    return t.slice(0, 1).select(["label", "d"]).append_column("cuts", pa.array([begin.tolist()], pa.list_(pa.float64())))


class Pack:
    """Nodes with weight, own cell and vector."""

    def __init__(self, node: np.ndarray, weight: np.ndarray, own: np.ndarray, x: np.ndarray):
        self.node, self.weight, self.own, self.x, self.unit = node, weight, own, x, unit(x, np.float32)

    def guests(self, other: Pack, c: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows that are guests of a cell of the other pack, and rows that are not but may be linked with a guest from it."""
        d = self.x.shape[1]
        if d != c.shape[1]:
            return np.arange(len(self.x)), np.zeros(0, np.int64)
        mine, where = np.unique(self.own, return_inverse=True)
        to = np.unique(other.own)
        apart = np.sqrt(np.maximum(2 - 2 * (c[mine] @ c[to].T), 0))[where]
        gap = np.einsum("ij,ij->i", self.unit, c[self.own].astype(np.float32))[:, None] - self.unit @ c[to].T.astype(np.float32)
        reach = np.sqrt(max(2 - 2 * threshold, 0))
        half = (gap <= (reach / 2 + 1e-9) * apart + slack(d)).any(axis=1)
        whole = (gap <= (reach + 1e-9) * apart + slack(d)).any(axis=1)
        return np.flatnonzero(half), np.flatnonzero(whole & ~half)


def linked(a: Pack, b: Pack, rows: np.ndarray, columns: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of linked nodes, some rows of `a` at a time against columns of `b`. A node of one pack doesn't link with itself."""
    if not len(rows) or not len(columns):
        return
    y = b.unit if len(columns) == len(b.unit) else b.unit[columns]
    step = max(1, STEP // len(columns))
    for i in range(0, len(rows), step):
        take = rows[i : i + step]
        r, c = np.nonzero(a.unit[take] @ y.T >= threshold - slack(a.x.shape[1]))
        if a is b:
            r, c = r[(other := take[r] != columns[c])], c[other]
        if len(r):
            r, c = np.unique(r), np.unique(c)
            hit = unit(a.x[take[r]]) @ unit(b.x[columns[c]]).T >= threshold
            if a is b:
                hit &= take[r][:, None] != columns[c][None, :]
            i_hit, j_hit = np.nonzero(hit)
            if len(i_hit):
                yield take[r[i_hit]], columns[c[j_hit]]


class Links:
    """What the links found in a task amount to: weighted links of each node, and edges that connect what they connect."""

    def __init__(self) -> None:
        self.counts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.edges: list[np.ndarray] = []
        self.most = EDGES

    def count(self, p: Pack) -> np.ndarray:
        return self.counts.setdefault(int(p.node[0]), (p.node, np.zeros(len(p.node), np.int64)))[1]

    def meet(self, a: Pack, b: Pack, rows: np.ndarray, columns: np.ndarray, threshold: float) -> None:
        for i, j in linked(a, b, rows, columns, threshold):
            np.add.at(self.count(a), i, b.weight[j])
            if a is not b:
                np.add.at(self.count(b), j, a.weight[i])
            self.edges.append(np.stack([a.node[i], b.node[j]]))
            self.thin(len(i) > len(a.node) + len(b.node))

    def thin(self, last: bool = False) -> None:
        """Edges that connect nothing new go: the last ones, or, when there are many, all."""
        if last:
            self.edges[-1] = self.forest(self.edges[-1])
        if sum(e.shape[1] for e in self.edges) > self.most:
            self.edges = [self.forest(np.concatenate(self.edges, axis=1))]
            self.most = EDGES + 2 * self.edges[0].shape[1]

    @staticmethod
    def forest(edges: np.ndarray) -> np.ndarray:
        ids, at = np.unique(edges, return_inverse=True)
        a, b = at.reshape(edges.shape)
        a, b = forest(len(ids), lambda: iter([(a, b)]))
        return np.stack([ids[a], ids[b]])

    def rows(self) -> pa.Table:
        """(a, b, n) with b null for n weighted links of a, or an edge a - b."""
        some = [(node[n > 0], n[n > 0]) for node, n in self.counts.values()]
        edges = self.forest(np.concatenate(self.edges, axis=1)) if self.edges else np.zeros((2, 0), np.int64)
        a = np.concatenate([*[node for node, _ in some], edges[0]])
        n = np.concatenate([*[n for _, n in some], np.zeros(edges.shape[1], np.int64)])
        b = np.r_[np.zeros(len(a) - edges.shape[1], np.int64), edges[1]]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64(), mask=n > 0), "n": pa.array(n, pa.int64())})


def block_links(t: pa.Table, threshold: float) -> pa.Table:
    """Links of a label whose nodes are few."""
    x = matrix(t.column("x"))
    p, found = Pack(t.column("node").to_numpy(), t.column("w").to_numpy(), np.zeros(len(x), np.int32), x), Links()
    found.meet(p, p, np.arange(len(x)), np.arange(len(x)), threshold)
    return found.rows()


def packed(t: pa.Table, c: np.ndarray, threshold: float) -> pa.Table:
    """One row of a pack's nodes, with its cells, and those with the cells that one of its nodes visits."""
    x, own = matrix(t.column("x")), t.column("own").to_numpy().astype(np.int32)
    cells = np.unique(own)
    touched = np.unique(np.concatenate([cells, *[np.unique(np.concatenate(cells_of(unit(x[at]), c, threshold)[1])) for at in steps(x, c)]]))
    columns = {"node": t.column("node").to_numpy(), "w": t.column("w").to_numpy(), "own": own, "x": x}
    out = t.slice(0, 1).select(["label", "d", "pack"])
    for name, v in columns.items():
        out = out.append_column(name, pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()))
    for name, v in (("cells", cells), ("touched", touched)):
        out = out.append_column(name, pa.array([v.tolist()], pa.list_(pa.int32())))
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written once and read back; what was shuffled for it is not kept."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return materialize(df, name)
    finally:
        conf.set(_CLEANUP, before)


def hashed(x: Column | str) -> Column:
    return F.xxhash64(x)


def near_groups(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of `vectors` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    of = vectors.schema["embedding"].dataType.elementType.typeName()
    kind = "float" if of == "float" else "double"
    stored = np.dtype(np.float32 if kind == "float" else np.float64)
    x = F.transform("embedding", lambda v: v.cast(kind) + F.lit(0.0).cast(kind))  # -0.0 is 0.0
    rows = vectors.select("vec_id", "label", x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("x", lambda v: v != 0), F.lit(False))
    good, rest = rows.where(usable), rows.where(~usable)
    nodes = written(
        good.groupBy("label", "x").agg(F.min("vec_id").alias("least"), F.count("*").alias("w"))
        .withColumns({"h": hashed("x"), "d": F.size("x"), "node": F.monotonically_increasing_id()}), "nodes"
    )
    out_rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sizes = nodes.groupBy("d", "label").count().groupBy("d").agg(F.max("count").alias("most"), F.sum("count").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not sizes:
        return out_rest
    d, most, n = sizes[0]["d"], sizes[0]["most"], sizes[0]["n"]
    sample_rows = max(1, min(n, SAMPLE_VALUES // d))
    k = max(1, min(MOST_CELLS, -(-most // CELL), sample_rows // 4 or 1))
    if k > 1:
        sample = nodes.where(F.col("d") == d).select("node", "x").orderBy(F.xxhash64("node"), "node").limit(sample_rows).toPandas()
        centroids = chained(spherical_kmeans(unit(np.stack(sample["x"].to_numpy())), k))
    else:
        centroids = np.ones((1, d)) / d**0.5
    shared = spark.sparkContext.broadcast(centroids)  # at most SAMPLE_VALUES numbers

    def placed(df: DataFrame, keep: list[str]) -> DataFrame:
        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims, own = batch.column("d").to_numpy(), np.zeros(batch.num_rows, np.int32)
                at = np.flatnonzero(dims == shared.value.shape[1])
                if len(at):
                    own[at] = own_cells(matrix(batch.column("x").take(pa.array(at))), shared.value)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(own, pa.int32())], names=[*keep, "own"])

        return df.mapInArrow(assign, df.select(*keep).schema.add("own", "integer"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, a = Links(), None
        for batch in batches:
            for row in range(batch.num_rows):
                node, w, own, x, *other = [
                    np.frombuffer(memoryview(batch.column(f"{s}_{c}")[row].as_buffer()), t)
                    for s in "ab" for c, t in (("node", np.int64), ("w", np.int64), ("own", np.int32), ("x", stored))
                ]
                if a is None or a.node[0] != node[0]:  # a pack meets one after the other
                    a = Pack(node.copy(), w.copy(), own.copy(), x.reshape(len(node), -1).copy())
                if other[0][0] == node[0]:
                    every = np.arange(len(node))
                    found.meet(a, a, every, every, threshold)
                    continue
                b = Pack(other[0].copy(), *other[1:3], other[3].reshape(len(other[0]), -1))
                (near_a, far_a), (near_b, far_b) = a.guests(b, shared.value, threshold), b.guests(a, shared.value, threshold)
                found.meet(a, b, near_a, np.sort(np.r_[near_b, far_b]), threshold)
                found.meet(a, b, far_a, near_b, threshold)
        yield from found.rows().to_batches()

    block = BLOCK
    many = F.count("*") > F.greatest(F.lit(1), F.least(F.lit(block), F.expr(f"{PACK_BYTES} div (8 * d)")))
    large = written(nodes.groupBy("label", "d").agg(many.alias("many"), F.count("*").alias("n")).where("many").select("label", "d", "n"), "large")
    bytes_of = large.agg(F.sum(F.col("n") * F.col("d") * stored.itemsize)).first()[0]
    links = "a long, b long, n long"
    few = nodes.select("node", "label", "d", "w", "x")
    if bytes_of:
        of_large = placed(few.join(large.select("label", "d"), ["label", "d"], "left_semi"), ["label", "d"])
        begins = written(
            of_large.groupBy("label", "d", "own").count().groupBy("label", "d")
            .applyInArrow(lambda t: cuts(t, block), large.select("label", "d").schema.add("cuts", ArrayType(DoubleType()))), "cuts"
        )
        share = (F.shiftrightunsigned(F.xxhash64("node"), 11).cast("double") / float(1 << 53)) * 0.999999
        dealt = placed(few, ["node", "label", "d", "w", "x"]).withColumn("_at", F.col("own") + share).join(begins, ["label", "d"]).select(
            "node", "label", "d", "w", "x", "own", F.size(F.filter("cuts", lambda v: v <= F.col("_at"))).alias("pack")
        )
        # each partition of packs meets each: a few tasks for each core
        parts = max(int((8 * spark.sparkContext.defaultParallelism) ** 0.5) + 1, -(-bytes_of // PART_BYTES))
        schema = dealt.select("label", "d", "pack").schema
        for c in ("node", "w", "own", "x"):
            schema = schema.add(c, "binary")
        for c in ("cells", "touched"):
            schema = schema.add(c, ArrayType(IntegerType()))
        packs = written(
            dealt.repartition(parts, "label", "d", "pack").groupBy("label", "d", "pack")
            .applyInArrow(lambda t: packed(t, shared.value, threshold), schema), "packs"
        ).coalesce(parts)
        a, b = (packs.select(*[F.col(c).alias(f"{s}_{c}") for c in packs.columns]) for s in "ab")
        # each pair once, so that either half of the tasks has as many
        once = F.expr("a_pack = b_pack or (a_pack < b_pack) = ((a_pack + b_pack) % 2 = 1)")
        meet = F.arrays_overlap("a_touched", "b_cells") | F.arrays_overlap("b_touched", "a_cells")
        pairs = a.hint("shuffle_replicate_nl").join(b, F.expr("a_label = b_label and a_d = b_d") & once & meet)
        found = pairs.select(*[f"{s}_{c}" for s in "ab" for c in ("node", "w", "own", "x")]).mapInArrow(joined, links)
        few = few.join(large.select("label", "d"), ["label", "d"], "left_anti")
        few_links = few.groupBy("label", "d").applyInArrow(lambda t: block_links(t, threshold), links)
        found = written(found, "links").unionByName(written(few_links, "links"))
    else:
        found = written(few.groupBy("label", "d").applyInArrow(lambda t: block_links(t, threshold), links), "links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b is not null"))
    # vectors of a label are told apart by a hash, where no two share one, else by themselves
    apart = ["label", "h"] if nodes.groupBy("label", "h").count().where("count > 1").isEmpty() else ["label", "h", "x"]
    rooted = written(
        nodes.select("node", *apart, "least", "w").join(counts, "node", "left").join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node")), "rooted"
    )
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    known = written(
        rooted.join(least, "root").select(*apart, (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id"), "known"
    )
    out = good.withColumn("h", hashed("x")).select("vec_id", *apart).join(known, apart).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
    return out.unionByName(out_rest)


def op2_embeddings(vectors: DataFrame) -> DataFrame:
    """The contract's columns at its threshold."""
    return near_groups(vectors.select("vec_id", "embedding", "label"))
