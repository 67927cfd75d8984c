"""Tables of a base and a log: replay, compaction, retention, and the bytes a batch writes."""

import os
import random

import pytest

from pointloom.schemas import struct
from pointloom.sinks.tables import LogTable

SCHEMA = struct("k STRING, part BIGINT, n BIGINT")


@pytest.fixture
def table(spark, tmp_path):
    return LogTable(spark, str(tmp_path / "t"), SCHEMA, ["k", "part"], every=3)


def rows(df):
    return {(r.k, r.part): r.n for r in df.collect()}


def put(spark, table, batch, version):
    table.write(spark.createDataFrame([(*k, n) for k, n in batch.items()], SCHEMA).coalesce(1), version)


def test_newest_row_of_each_key_at_every_version(spark, table):
    rng = random.Random(1)
    assert rows(table.read()) == {}
    want, after = {}, {}
    for version in range(8):
        batch = {(rng.choice(["a", "b", None]), rng.choice([1, 2, None])): rng.choice([None, version]) for _ in range(3)}
        put(spark, table, batch, version)
        want = want | batch
        after[version] = dict(want)
        assert rows(table.read()) == want
        put(spark, table, batch, version)  # the batch runs again
        assert rows(table.read()) == want and rows(table.read(before=version)) == after.get(version - 1, {})
    assert table.versions("base") == [2, 5] and table.versions() == [3, 4, 5, 6, 7]


def test_another_result_of_a_repeated_batch_takes_its_place(spark, table):
    for version in range(3):
        put(spark, table, {("a", version): version}, version)
    assert table.versions("base") == [2]
    put(spark, table, {("a", 9): 9}, 2)
    assert rows(table.read()) == {("a", 0): 0, ("a", 1): 1, ("a", 9): 9}


def test_a_half_written_version_is_not_read(spark, table):
    put(spark, table, {("a", 1): 1}, 0)
    put(spark, table, {("a", 1): 2}, 1)
    os.remove(f"{table._folder('log', 1)}/_SUCCESS")
    assert rows(table.read()) == {("a", 1): 1}


def test_a_batch_writes_its_changes_only(spark, tmp_path):
    table = LogTable(spark, str(tmp_path / "big"), SCHEMA, ["k", "part"])
    table.write(spark.range(200_000).selectExpr("cast(id AS string) AS k", "id AS part", "id AS n").coalesce(1), 0)
    put(spark, table, {("7", 7): -1}, 1)
    size = [sum(os.path.getsize(os.path.join(table._folder("log", v), f)) for f in os.listdir(table._folder("log", v))) for v in (0, 1)]
    assert size[1] < size[0] / 100
    assert table.read().count() == 200_000 and rows(table.read().where("k = '7'")) == {("7", 7): -1}
