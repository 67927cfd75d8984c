"""As-of lookup against brute force, with one series holding most rows."""

import random

from pointloom.operators.asof import asof_join


def test_asof_brute_force(spark):
    rnd = random.Random(11)
    def series():
        return "hot" if rnd.random() < 0.6 else f"s{rnd.randrange(5)}"

    history = [("1", series(), "p", rnd.randrange(-50, 1000), i, float(i)) for i in range(400)]
    keys = [(k, "1", series(), "p", rnd.randrange(-80, 1100)) for k in range(300)]
    keys += [(300 + i, *keys[i][1:]) for i in range(40)]  # the same probe twice
    h = spark.createDataFrame(history, "company_id STRING, device_id STRING, property_name STRING, timestamp BIGINT, data_id BIGINT, v DOUBLE")
    k = spark.createDataFrame(keys, "k INT, company_id STRING, device_id STRING, property_name STRING, ts_ms BIGINT")
    for bucket in (7, 100, 100_000):
        got = {r.k: r.v for r in asof_join(k, h, ["v"], bucket_ms=bucket).collect()}
        assert len(got) == len(keys)
        for key in keys:
            rows = [r for r in history if r[1] == key[2] and r[3] <= key[4]]
            want = max(rows, key=lambda r: (r[3], r[4]))[5] if rows else None
            assert got[key[0]] == want
