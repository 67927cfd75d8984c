"""Short ways to write readings and rules in tests."""

import json

from pointloom.schemas import READING, RULE

T0 = 1704067200000  # 2024-01-01T00:00:00Z
MIN = 60_000


def readings(spark, rows, company="396"):
    """rows: (device, point, value, ms after T0[, seq])"""
    data = [
        (r[4] if len(r) > 4 else i, company, r[0], "161", "gw", r[1], None if r[2] is None else float(r[2]), T0 + r[3])
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(data, READING)


def rule(point, expr, deps=(), expr_type=0, params=(), device="D0", enabled=1, company="396"):
    """deps: (var, device, point)"""
    d = [{"var": v, "company_id": int(company), "device_code": dev, "point_code": p} for v, dev, p in deps]
    return (
        company, device, point, 2, 0, expr_type, expr, json.dumps(d),
        json.dumps([{"name": n, "value": v} for n, v in params]), enabled,
    )


def rules(spark, *rows):
    return spark.createDataFrame(list(rows), RULE)


def results(derived, point=None):
    """{(minutes after T0, device, point): value}"""
    out = {}
    for r in derived.collect():
        if point is None or r.property_name == point:
            key = ((r.tick_ms - T0) // MIN, r.device_id, r.property_name)
            assert key not in out, f"twice: {key}"
            out[key] = r.value
    return out
