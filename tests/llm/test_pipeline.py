"""The pipeline's stages one after the other, each held against its own input."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
import test_packing
import test_suffix_dedup
from pointloom.llm import mixing, toxicity
from pointloom.llm.common import materialize
from pyspark.sql import functions as F


def first_of_near(docs, width=5):
    """The least id of each group of texts with at least 0.8 of their five-word shingles in common, by all pairs that share one."""
    rows = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    sets, holders, label = [], defaultdict(list), list(range(len(rows)))
    for i, (_, text) in enumerate(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text))
        sets.append({tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))})
        common = Counter()
        for s in sets[i]:
            common.update(holders[s])
            holders[s].append(i)
        for j, n in common.items():
            if 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return {rows[k][0] for k in set(label)}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_near_copies_by_all_pairs(spark, size):
    folder = f"/root/testdata/{size}"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, folder)
    assert {r.doc_id for r in kept.collect()} == first_of_near(docs)


CLASHING = (
    "score predicted n_bytes n_removed n_spans kept_sha256 _node _keys _rest rest row size h whole below shift target taken source_size chunk "
    "sizes body at node keys label terms _ _t _times"
).split()


@pytest.mark.parametrize("name", ["toxicity", "near_copies", "repeated_passages", "mixture"])
def test_stages_keep_columns_of_any_name(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 3 = 0")  # a small fixture
    wide = docs.withColumns({c: F.concat(F.lit(f"mine {c} "), F.col("doc_id").cast("string")) for c in CLASHING})
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, wide, sf_dir)
    assert out.schema == wide.schema
    rows = out.collect()
    assert rows and all(r[c] == f"mine {c} {r.doc_id}" for r in rows for c in CLASHING)
    plain = stage(spark, docs, sf_dir)
    assert sorted((r.doc_id, r.text) for r in rows) == sorted((r.doc_id, r.text) for r in plain.collect())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "repeated_passages", "mixture", "packing"]
    stages = dict(corpus_pipeline.STAGES)

    civil = materialize(stages["toxicity"](spark, docs, sf_dir))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = {r.doc_id: r.predicted for r in toxicity.op10_toxicity(docs, labels).collect()}
    assert civil.columns == columns and {r.doc_id for r in civil.collect()} == {d for d, p in scored.items() if not p}

    single = materialize(stages["near_copies"](spark, civil, sf_dir))
    assert {r.doc_id for r in single.collect()} == first_of_near(civil)

    cut = materialize(stages["repeated_passages"](spark, single, sf_dir))
    want = test_suffix_dedup.brute([(r.doc_id, r.text) for r in single.collect()], 100)
    was = {r.doc_id: r.text for r in single.collect()}
    for r in cut.collect():
        n_bytes, removed, spans, _ = want[r.doc_id]
        assert r.n_chars == len(r.text) and n_bytes - removed - 3 * 2 * spans <= len(r.text.encode()) <= n_bytes - removed
        assert removed or r.text == was[r.doc_id]

    mixed = materialize(stages["mixture"](spark, cut, sf_dir))
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.op7_mixing(cut).collect()}
    times: dict[int, int] = {}
    for r in mixed.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert mixed.columns == columns and all(times.get(d, 0) * size == t for d, (size, t) in taken.items())

    packed = stages["packing"](spark, mixed, sf_dir).collect()
    used, bound = test_packing.check([(r.doc_id, r.text) for r in mixed.collect()], packed, 2048)
    assert used <= bound + 1


def test_run_and_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
