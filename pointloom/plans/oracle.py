"""SQL with the same results as the catalogue's queries, for an independent engine over the same tables."""

from __future__ import annotations

from pointloom.plans import sample
from pointloom.plans.sample import DUCK_MS

TYPES = sample.EVENT_TYPES


def with_(**ctes: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in ctes.items()) + " "


def cols(names: list[str]) -> str:
    return ", ".join(names)


# ---- inputs ---------------------------------------------------------------------------------------------------
def rnd(expr: str) -> str:
    """Six digits. The nudge keeps means that lie on half a last digit on one side whatever the order of summing."""
    return f"round({expr} + 1e-9, 6)"


def telemetry(dense: bool = True) -> str:
    return f"SELECT {cols(sample.telemetry_columns(DUCK_MS, dense))} FROM events"


MESSAGES = f"SELECT {cols(sample.message_columns(DUCK_MS, chr(92)))}, user_id, event_id, event_type, value AS num, cast(floor(({DUCK_MS}) / 1000.0) AS bigint) AS s FROM events"
PLANTS = "SELECT n_regionkey, par FROM (SELECT DISTINCT n_regionkey FROM nation), (VALUES (0), (1)) p(par)"
DEVICES = (
    "SELECT c.*, n.n_regionkey FROM customer c JOIN nation n ON c_nationkey = n_nationkey "
    "WHERE c_custkey IN (SELECT user_id FROM events)"
)
OBJECTS = (
    f"SELECT {cols(sample.PLANT_COLUMNS)} FROM ({PLANTS}) UNION ALL SELECT {cols(sample.DEVICE_COLUMNS)} FROM ({DEVICES})"
)
MODELS = (
    f"SELECT {cols(sample.MODEL_COLUMNS)} FROM (SELECT DISTINCT c_mktsegment FROM customer), "
    "(VALUES (0), (1)) p(par), (VALUES (0), (5000)) q(dup)"
)


def _points(kinds: list[tuple], plant: bool) -> list[str]:
    base = "plants" if plant else "devices"
    return [
        "SELECT " + cols([f"{v} AS {n}" for n, v in zip(sample.POINT_FIELDS, sample.point_values(k, plant))]) + f" FROM {base}"
        for k in kinds
    ]


POINTS = " UNION ALL ".join(_points(sample.DEVICE_POINTS, False) + _points(sample.PLANT_POINTS, True))
CONFIG = {"plants": PLANTS, "devices": DEVICES, "objects": OBJECTS, "models": MODELS, "points": POINTS}
POINT_CHANGES = " UNION ALL ".join(
    f"SELECT 'point' AS \"table\", '{op}' AS op, data_id * 10 + {k} AS seq, data_id, company_id, object_id, data_code, "
    f"data_type, cast({'data_source' if not after else source} AS int) AS data_source, "
    f"{'formula' if not after else formula} AS formula FROM points WHERE {condition}"
    for k, condition, op, before, after, source, formula in sample.CHANGES
)
HISTORY = f"SELECT {cols(sample.history_columns(DUCK_MS, 'ts'))} FROM events"
PROBES = f"SELECT {cols(sample.PROBE_COLUMNS)} FROM orders"

# ---- messages -------------------------------------------------------------------------------------------------
_ENVELOPE = "event_id % 19 NOT IN (3, 4, 5) AND event_id % 17 NOT IN (5, 6)"
_TOPICS = {
    "gateway_code": "concat('gw', user_id % 4)", "company_id": "cast(396 + user_id % 2 AS varchar)", "project_id": "'161'",
}


def _topic(name: str) -> str:
    return f"CASE WHEN event_id % 11 IN (4, 5) THEN 'unknown' ELSE {_TOPICS[name]} END"


def _envelope_points() -> str:
    head = f"event_id AS msg_id, {_topic('company_id')} AS company_id, concat('D', user_id) AS device_id, {_topic('project_id')} AS project_id, {_topic('gateway_code')} AS gateway_code"
    v = "CASE event_id % 13 WHEN 2 THEN 0.0 WHEN 3 THEN 1.0 ELSE num END"
    tail = "'source' AS data_type, s * 1000 AS ts_ms"
    return (
        f"SELECT {head}, event_type AS property_name, cast({v} AS double) AS value, {tail} FROM m WHERE {_ENVELOPE} UNION ALL "
        f"SELECT {head}, 'k' AS property_name, cast(event_id % 97 AS double) AS value, {tail} FROM m WHERE {_ENVELOPE}"
    )


_FLAT = (
    "SELECT event_id AS msg_id, cast(396 + user_id % 2 AS varchar) AS company_id, concat('D', user_id) AS device_id, "
    "event_type AS property_name, num AS value, s * 1000 AS ts_ms FROM m WHERE event_id % 19 = 3 AND event_id % 2 = 1"
)

# ---- snapshots ------------------------------------------------------------------------------------------------
# written the direct way: every reading is copied to its 15 windows
SNAP = (
    "SELECT tick_ms, company_id, device_id, property_name, arg_max(value, (ts_ms, seq)) AS value, max(ts_ms) AS ts_ms FROM "
    "(SELECT *, (cast(floor(ts_ms / 60000.0) AS bigint) + 1 + k) * 60000 AS tick_ms FROM telemetry, range(15) r(k)) "
    "GROUP BY ALL"
)
TICKS = (
    "SELECT tick_ms, max(ts_ms) OVER (PARTITION BY tick_ms, company_id, device_id) AS snapshot_ms, company_id, device_id, "
    "property_name, value FROM snap"
)


def ticks(dense: bool = True) -> dict[str, str]:
    return {"telemetry": telemetry(dense), "snap": SNAP, "ticks": TICKS}


KEY = "company_id, device_id, property_name"
FORMATS = {"hour": "%Y%m%d%H", "day": "%Y%m%d", "month": "%Y%m", "year": "%Y", "total": "all"}


def period(unit: str, offset_ms: int = 0) -> str:
    return f"strftime(make_timestamp((snapshot_ms + {offset_ms}) * 1000), '{FORMATS[unit]}')"


def diff(unit: str, offset_ms: int = 0, by: str = KEY, value: str = "value") -> str:
    return f"{value} - first_value({value}) OVER (PARTITION BY {by}, {period(unit, offset_ms)} ORDER BY tick_ms)"


def _diff_query(unit: str, dense: bool = True, offset_ms: int = 0) -> str:
    return with_(**ticks(dense)) + f"SELECT tick_ms, snapshot_ms, {KEY}, {rnd(diff(unit, offset_ms))} AS diff FROM ticks"


def _stat_query(kind: str) -> str:
    return with_(**ticks()) + f"SELECT tick_ms, {KEY}, {rnd(f"{kind}(value) OVER (PARTITION BY {KEY}, {period('day')} ORDER BY tick_ms)")} AS stat FROM ticks"


# ---- rules, stated for the sample directly --------------------------------------------------------------------
Q = "chr(39)"
BAD = ("bad", "week", "short")


def _dep(var: str, point: str, device: str = "object_code") -> str:
    return f"'{{\"var\":\"{var}\",\"company_id\":', company_id, ',\"device_code\":\"', {device}, '\",\"point_code\":\"{point}\"}}'"


def _deps(*parts: str) -> str:
    return "concat('[', " + ", ',', ".join(parts) + ", ']')"


_NEXT = "concat('D', object_id - 1000 + 2)"
# point -> (expr_type, expr, depends_on, params)
COMPILED = {
    "clickDay": ("1", "'DAY_DIFF'", _deps(_dep("a", "click")), "'[]'"),
    "viewHour": ("1", "'HOUR_DIFF'", _deps(_dep("a", "view")), "'[]'"),
    "viewAll": ("1", "'TOTAL_DIFF'", _deps(_dep("a", "view")), "'[]'"),
    "clickMonth": ("1", "'MONTH_DIFF'", _deps(_dep("a", "click")), "'[]'"),
    "clickYear": ("1", "'YEAR_DIFF'", _deps(_dep("a", "click")), "'[]'"),
    "purStat": ("1", "'DAILY_STATS'", _deps(_dep("a", "purchase")), "concat('[{\"name\":\"type\",\"value\":\"', CASE object_id % 3 WHEN 1000 % 3 THEN 'avg' WHEN 1001 % 3 THEN 'max' ELSE 'min' END, '\"}]')"),
    "errBit": ("1", "'DEC_TO_BIN'", _deps(_dep("a", "error")), "concat('[{\"name\":\"bit\",\"value\":\"', (object_id - 1000) % 8 + 1, '\"}]')"),
    "price": ("2", "CASE WHEN (object_id - 1000) % 2 = 0 THEN concat((object_id - 1000) % 5 + 1, '.5') ELSE concat((object_id - 1000) % 3 + 2, '.25') END", "'[]'", "'[]'"),
    "signup": ("2", "'12'", "'[]'", "'[]'"),
    "revenue": ("0", "'a*b + a/2'", _deps(_dep("a", "purchase"), _dep("b", "price")), "'[]'"),
    "mix": ("0", "'(a+b)/2'", _deps(_dep("a", "click"), _dep("b", "view")), "'[]'"),
    "cross": ("0", "'a-b*0.5'", _deps(_dep("a", "click"), _dep("b", "view", _NEXT)), "'[]'"),
    "chain": ("0", "'r*2 - p'", _deps(_dep("r", "revenue"), _dep("p", "purchase")), "'[]'"),
    "chainDay": ("1", "'DAY_DIFF'", _deps(_dep("", "mix")), "'[]'"),
    "weighted": ("0", "'s*c/100'", _deps(_dep("s", "signup"), _dep("c", "click")), "'[]'"),
    "ratio": ("0", "'e/(bit-1)'", _deps(_dep("e", "error"), _dep("bit", "error")), "'[]'"),
    "blank": ("0", "''", "'[]'", "'[]'"),
    "broken": ("0", "'{\"formula\":'", "'[]'", "'[]'"),
    "plain": ("0", "'price'", "'[]'", "'[]'"),
    "plantSum": ("1", "'CHILD_SUM'", "'[]'", "'[{\"name\":\"model\",\"value\":\"BUILDING\"},{\"name\":\"point\",\"value\":\"purchase\"}]'"),
    "plantAvg": ("1", "'CHILD_AVG'", "'[]'", "'[{\"name\":\"model\",\"value\":\"BUILDING\"},{\"name\":\"point\",\"value\":\"purchase\"}]'"),
    "noModel": ("1", "'CHILD_SUM'", "'[]'", "'[{\"name\":\"model\",\"value\":\"NOPE\"},{\"name\":\"point\",\"value\":\"purchase\"}]'"),
}


def _by_code(i: int) -> str:
    return "CASE data_code " + " ".join(f"WHEN '{c}' THEN {v[i]}" for c, v in COMPILED.items()) + " END"


RULES = (
    "SELECT data_id, cast(company_id AS varchar) AS company_id, object_code AS device_code, data_code AS point_code, 2 AS point_type, "
    "CASE WHEN data_type = 'x' THEN 0 ELSE cast(data_type AS int) END AS value_type, "
    f"cast({_by_code(0)} AS int) AS expr_type, {_by_code(1)} AS expr, {_by_code(2)} AS depends_on, {_by_code(3)} AS params, status AS enabled "
    "FROM points JOIN objects USING (object_id, company_id) WHERE data_source IN (2, 3) AND data_code NOT IN ('bad', 'week', 'short')"
)
RULE_COLUMNS = "company_id, device_code, point_code, point_type, value_type, expr_type, expr, depends_on, params, enabled"
CONFIG_RULES = {**CONFIG, "rules": RULES}

# enabled devices of the sample, by device code, with their number
LIVE = "SELECT cast(company_id AS varchar) AS company_id, object_code AS device_id, object_id - 1000 AS c, parent_id FROM objects WHERE parent_id IS NOT NULL AND status = 1"
LIVE_RULES = {"plants": PLANTS, "devices": DEVICES, "objects": OBJECTS, "live": LIVE}
PRICE = "CASE WHEN c % 2 = 0 THEN c % 5 + 1.5 ELSE c % 3 + 2.25 END"

# last known value of every event type at every firing of each device (ticks at which any of its points is present)
WIDE = (
    "SELECT company_id, device_id, tick_ms, any_value(snapshot_ms) AS snapshot_ms, "
    + ", ".join(f"max(value) FILTER (property_name = '{t}') AS {t}" for t in TYPES)
    + " FROM ticks GROUP BY ALL"
)
KNOWN = "SELECT company_id, device_id, tick_ms, snapshot_ms, " + ", ".join(
    f"{t}, last_value({t} IGNORE NULLS) OVER (PARTITION BY company_id, device_id ORDER BY tick_ms) AS k_{t}" for t in TYPES
) + " FROM wide"
BASE = {**ticks(), **LIVE_RULES, "wide": WIDE, "known": f"SELECT k.*, c, parent_id FROM ({KNOWN}) k JOIN live USING (company_id, device_id)"}


def rule_sql(code: str, value: str, where: str) -> str:
    return (
        f"SELECT tick_ms, snapshot_ms, company_id, device_id, '{code}' AS property_name, value FROM "
        f"(SELECT *, {value} AS value FROM known WHERE {where}) WHERE value IS NOT NULL"
    )


def _series_rule(code: str, source: str, value: str) -> str:
    return (
        f"SELECT tick_ms, snapshot_ms, company_id, device_id, '{code}' AS property_name, {value} AS value "
        f"FROM ticks JOIN live USING (company_id, device_id) WHERE property_name = '{source}'"
    )


_DAYS = f"(PARTITION BY {KEY}, {period('day')} ORDER BY tick_ms)"
MIX = rule_sql("mix", "(k_click + k_view) / 2", "click IS NOT NULL OR view IS NOT NULL")
REVENUE = rule_sql("revenue", f"k_purchase * ({PRICE}) + k_purchase / 2", "purchase IS NOT NULL")
_CROSS_KNOWN = (
    "SELECT company_id, concat('D', d.c) AS device_id, tick_ms, "
    "max(snapshot_ms) FILTER ((t.device_id = concat('D', d.c) AND property_name = 'click') OR (t.device_id = concat('D', d.c + 2) AND property_name = 'view')) AS snapshot_ms, "
    "max(value) FILTER (t.device_id = concat('D', d.c) AND property_name = 'click') AS a, "
    "max(value) FILTER (t.device_id = concat('D', d.c + 2) AND property_name = 'view') AS b "
    "FROM ticks t JOIN live d USING (company_id) WHERE (t.device_id = concat('D', d.c) AND property_name = 'click') "
    "OR (t.device_id = concat('D', d.c + 2) AND property_name = 'view') GROUP BY ALL"
)
# a plant fires when any child reports; every child must have been seen
_CHILDREN = (
    "SELECT o.parent_id, cast(o.company_id AS varchar) AS company_id, o.object_code AS device_id FROM objects o "
    "JOIN (SELECT company_id, min(model_id) AS model_id FROM models WHERE object_code = 'BUILDING' GROUP BY ALL) m USING (company_id, model_id)"
)
_PLANT_GRID = (
    "SELECT f.parent_id, f.company_id, f.tick_ms, f.snapshot_ms, ch.device_id, t.value FROM "
    "(SELECT parent_id, ch.company_id, tick_ms, max(snapshot_ms) AS snapshot_ms FROM ticks JOIN children ch USING (company_id, device_id) WHERE property_name = 'purchase' GROUP BY ALL) f "
    "JOIN children ch USING (parent_id, company_id) LEFT JOIN ticks t ON t.company_id = f.company_id AND t.device_id = ch.device_id AND t.tick_ms = f.tick_ms AND t.property_name = 'purchase'"
)
_PLANT_KNOWN = (
    "SELECT parent_id, company_id, tick_ms, snapshot_ms, last_value(value IGNORE NULLS) OVER (PARTITION BY parent_id, device_id ORDER BY tick_ms) AS value FROM plant_grid"
)
PLANT = {"models": MODELS, "children": _CHILDREN, "plant_grid": _PLANT_GRID, "plant_known": _PLANT_KNOWN}


def _plant_rule(code: str, fn: str) -> str:
    return (
        f"SELECT tick_ms, any_value(snapshot_ms) AS snapshot_ms, company_id, concat('P', parent_id) AS device_id, '{code}' AS property_name, "
        f"{fn}(value) AS value FROM plant_known GROUP BY tick_ms, company_id, parent_id HAVING count(*) = count(value)"
    )


CROSS = {
    "cross_wide": _CROSS_KNOWN,
    "cross_known": "SELECT company_id, device_id, tick_ms, snapshot_ms, last_value(a IGNORE NULLS) OVER w AS a, last_value(b IGNORE NULLS) OVER w AS b FROM cross_wide WINDOW w AS (PARTITION BY company_id, device_id ORDER BY tick_ms)",
}
DERIVED = {
    "clickDay": _series_rule("clickDay", "click", diff("day")),
    "viewHour": _series_rule("viewHour", "view", diff("hour")),
    "viewAll": _series_rule("viewAll", "view", diff("total")),
    "clickMonth": _series_rule("clickMonth", "click", diff("month")),
    "clickYear": _series_rule("clickYear", "click", diff("year")),
    "purStat": _series_rule("purStat", "purchase", f"CASE c % 3 WHEN 0 THEN avg(value) OVER {_DAYS} WHEN 1 THEN max(value) OVER {_DAYS} ELSE min(value) OVER {_DAYS} END"),
    "errBit": _series_rule("errBit", "error", "cast((cast(trunc(value) AS bigint) >> (c % 8)::int) & 1 AS double)"),
    "revenue": REVENUE,
    "mix": MIX,
    "weighted": rule_sql("weighted", "coalesce(k_signup, 12) * k_click / 100", "click IS NOT NULL OR signup IS NOT NULL"),
    "ratio": rule_sql("ratio", "CASE WHEN k_error - 1 <> 0 THEN k_error / (k_error - 1) END", "error IS NOT NULL"),
    "cross": "SELECT tick_ms, snapshot_ms, company_id, device_id, 'cross' AS property_name, a - b * 0.5 AS value FROM cross_known WHERE a IS NOT NULL AND b IS NOT NULL",
    "chain": "SELECT * REPLACE ('chain' AS property_name) FROM (" + rule_sql("chain", f"(k_purchase * ({PRICE}) + k_purchase / 2) * 2 - k_purchase", "purchase IS NOT NULL") + ")",
    "chainDay": f"SELECT tick_ms, snapshot_ms, company_id, device_id, 'chainDay' AS property_name, {diff('day')} AS value FROM ({MIX})",
    "plantSum": _plant_rule("plantSum", "sum"),
    "plantAvg": _plant_rule("plantAvg", "avg"),
}


def derived(*codes: str) -> str:
    rows = " UNION ALL BY NAME ".join(DERIVED[c] for c in codes)
    return with_(**BASE, **CROSS, **PLANT) + (
        f"SELECT tick_ms, snapshot_ms, {KEY}, {rnd('value')} AS value FROM ({rows})"
    )


_MINUTE = "cast(floor(ts_ms / 60000.0) AS bigint)"


def aged(age: int) -> str:
    """Values looked up in the minutes of the readings themselves, and only if at most `age` minutes old."""

    def read(alias: str, device: str, point: str, of: str) -> str:
        return (
            f"ASOF JOIN (SELECT * FROM slots WHERE property_name = '{point}') {alias} ON {of}.company_id = {alias}.company_id "
            f"AND {device} = {alias}.device_id AND {of}.tick_ms // 60000 > {alias}.slot"
        )

    def young(of: str, *names: str) -> str:
        return " AND ".join(f"{of}.tick_ms // 60000 - {a}.slot <= {age}" for a in names)

    rows = [
        "SELECT w.tick_ms, w.snapshot_ms, w.company_id, w.device_id, 'mix' AS property_name, (x.value + y.value) / 2 AS value FROM "
        "(SELECT wide.* FROM wide JOIN live USING (company_id, device_id) WHERE click IS NOT NULL OR view IS NOT NULL) w "
        + read("x", "w.device_id", "click", "w") + " " + read("y", "w.device_id", "view", "w") + f" WHERE {young('w', 'x', 'y')}",
        "SELECT w.tick_ms, w.snapshot_ms, w.company_id, w.device_id, 'cross', x.value - y.value * 0.5 FROM "
        "(SELECT *, concat('D', cast(substr(device_id, 2) AS int) + 2) AS other FROM cross_wide) w "
        + read("x", "w.device_id", "click", "w") + " " + read("y", "w.other", "view", "w") + f" WHERE {young('w', 'x', 'y')}",
    ] + [
        f"SELECT tick_ms, any_value(snapshot_ms), company_id, concat('P', parent_id), '{code}', {fn}(value) FROM plant_young "
        "GROUP BY tick_ms, company_id, parent_id HAVING count(*) = count(value)"
        for code, fn in (("plantSum", "sum"), ("plantAvg", "avg"))
    ]
    slots = f"SELECT company_id, device_id, property_name, {_MINUTE} AS slot, arg_max(value, (ts_ms, seq)) AS value FROM telemetry GROUP BY ALL"
    young_plants = (
        f"SELECT g.tick_ms, g.snapshot_ms, g.company_id, g.parent_id, CASE WHEN {young('g', 'x')} THEN x.value END AS value FROM plant_grid g "
        + read("x", "g.device_id", "purchase", "g").replace("ASOF JOIN", "ASOF LEFT JOIN")
    )
    return with_(**BASE, **CROSS, **PLANT, slots=slots, plant_young=young_plants) + (
        f"SELECT tick_ms, snapshot_ms, {KEY}, {rnd('value')} AS value FROM ({' UNION ALL '.join(rows)})"
    )


# ---- catalogue ------------------------------------------------------------------------------------------------
def _listed(*deps: str) -> str:
    return "concat(" + ", ';', ".join(deps) + ")"


_OWN_DEVICE = "'D', object_id - 1000"
_PARSED = {  # point -> (expr, expr_type, depends_on) of formulas in JSON form
    "mix": ("'(a+b)/2'", 0, _listed(f"'a=', {_OWN_DEVICE}, '.click'", f"'b=', {_OWN_DEVICE}, '.view'")),
    "cross": ("'a-b*0.5'", 0, _listed(f"'a=', {_OWN_DEVICE}, '.click'", "'b=D', object_id - 1000 + 2, '.view'")),
    "chain": ("'r*2 - p'", 0, _listed(f"'r=', {_OWN_DEVICE}, '.revenue'", f"'p=', {_OWN_DEVICE}, '.purchase'")),
    "chainDay": ("'DAY_DIFF'", 1, _listed(f"'=', {_OWN_DEVICE}, '.mix'")),
    "weighted": ("'s*c/100'", 0, _listed(f"'s=', {_OWN_DEVICE}, '.signup'", f"'c=', {_OWN_DEVICE}, '.click'")),
    "ratio": ("'e/(bit-1)'", 0, _listed(f"'e=', {_OWN_DEVICE}, '.error'", f"'bit=', {_OWN_DEVICE}, '.error'")),
    "blank": ("''", 0, "''"), "broken": ("formula", 0, "''"), "plain": ("formula", 0, "''"),
}


def _parsed(i: int, other: str) -> str:
    return "CASE data_code " + " ".join(f"WHEN '{c}' THEN {v[i]}" for c, v in _PARSED.items()) + f" ELSE {other} END"


_ARGS = "string_split(regexp_extract(formula, '\\((.*)\\)$', 1), ',')"


def _arg(i: int) -> str:
    return f"regexp_replace(trim({_ARGS}[{i}]), '^[''\"‘’“”]|[''\"‘’“”]$', '', 'g')"


# point -> (expr if not 'a', names in order of first use) of its text as a same-device formula
_SAME_DEVICE: dict[str, tuple[str | None, list[str]]] = {
    "revenue": ("'a*b + a/2'", ["purchase", "price"]), "mix": ("'(a+b)/2'", ["a", "b"]), "cross": ("'a-b*0.5'", ["a", "b"]),
    "chain": ("'a*2 - b'", ["r", "p"]), "weighted": ("'a*b/100'", ["s", "c"]), "ratio": ("'a/(b-1)'", ["e", "bit"]),
    "price": ("coalesce(try_cast(formula AS json) ->> '$.formula', formula)", []), "signup": ("'12'", []), "blank": ("' '", []),
    "broken": ("'{\"a\":'", ["formula"]),
    **{k: (None, [v]) for k, v in {
        "plain": "price", "chainDay": "DAY_DIFF", "clickDay": "click", "week": "click", "clickMonth": "click", "clickYear": "click", "viewHour": "view",
        "viewAll": "view", "purStat": "purchase", "errBit": "error", "short": "error", "bad": "x", "plantSum": "BUILDING", "plantAvg": "BUILDING", "noModel": "NOPE",
    }.items()},
}


def _same_device(i: int) -> str:
    def deps(names: list[str]) -> str:
        return "concat(" + ", ".join([f"'{';' if k else ''}{chr(97 + k)}=', object_id, '.{n}'" for k, n in enumerate(names)] or ["''"]) + ")"

    return " ".join(f"WHEN data_code = '{c}' THEN {expr if i == 0 else deps(names)}" for c, (expr, names) in _SAME_DEVICE.items() if i or expr)


# rules that list operands: code -> what must be present, values of its operands
_FIRES = {
    "mix": ("click IS NOT NULL OR view IS NOT NULL", "k_click", "k_view"), "ratio": ("error IS NOT NULL", "k_error", "k_error"),
    "weighted": ("click IS NOT NULL OR signup IS NOT NULL", "k_signup", "k_click"), "revenue": ("purchase IS NOT NULL", "NULL", "NULL"),
    "chain": ("purchase IS NOT NULL", "NULL", "NULL"),
    **{c: (f"{t} IS NOT NULL", f"k_{t}", None) for c, t in {
        "clickDay": "click", "clickMonth": "click", "clickYear": "click", "viewHour": "view", "viewAll": "view", "purStat": "purchase", "errBit": "error",
    }.items()},
}

_BITS = "CASE WHEN seq % 2 = 0 THEN -value ELSE value END"
_FUNCTION_POINTS = "('clickDay', 'viewHour', 'viewAll', 'clickMonth', 'clickYear', 'purStat', 'errBit', 'chainDay')"
_ASOF = "FROM probes p ASOF LEFT JOIN history h ON p.company_id = h.company_id AND p.device_id = h.device_id AND p.property_name = h.property_name AND p.ts_ms >= h.timestamp"

_PASSED = "tick_ms <= (SELECT max(ts_ms) - 30000 FROM telemetry)"  # windows the watermark has passed

ALL: dict[str, str] = {
    "topic_fields": with_(m=MESSAGES) + (
        "SELECT event_id AS msg_id, "
        + ", ".join(f"CASE WHEN event_id % 19 IN (3, 4, 5) THEN 'unknown' ELSE {_topic(n)} END AS {n}" for n in _TOPICS)
        + " FROM m"
    ),
    "decode_envelope": with_(m=MESSAGES) + _envelope_points(),
    "decode_flat": with_(m=MESSAGES) + _FLAT,
    "decode_messages": with_(m=MESSAGES) + f"SELECT msg_id, company_id, device_id, property_name, value, ts_ms FROM ({_envelope_points()}) UNION ALL {_FLAT}",
    "decode_rejects": with_(m=MESSAGES) + (
        "SELECT event_id AS msg_id, CASE WHEN event_id % 19 = 4 THEN 'malformed message' WHEN event_id % 19 = 5 THEN 'nested payload' "
        "ELSE 'malformed payload' END AS reason FROM m WHERE event_id % 19 IN (4, 5) OR (event_id % 19 <> 3 AND event_id % 17 IN (5, 6))"
    ),
    "encode_envelope": with_(**ticks()) + (
        f"SELECT t.tick_ms, t.company_id, t.device_id, o.project_id, 'tcp' AS gateway_code, t.property_name, t.value, t.snapshot_ms // 1000 * 1000 AS ts_ms FROM "
        f"(SELECT tick_ms, snapshot_ms, {KEY}, {rnd(diff('day'))} AS value FROM ticks) t JOIN "
        "(SELECT tick_ms, company_id, device_id, arg_max(project_id, (ts_ms, seq)) AS project_id FROM "
        "(SELECT *, (cast(floor(ts_ms / 60000.0) AS bigint) + 1 + k) * 60000 AS tick_ms FROM telemetry, range(15) r(k)) GROUP BY ALL) o "
        "USING (tick_ms, company_id, device_id)"
    ),
    "latest_snapshot": with_(telemetry=telemetry()) + SNAP,
    "snapshot_time": with_(telemetry=telemetry(), snap=SNAP) + "SELECT tick_ms, company_id, device_id, max(ts_ms) AS snapshot_ms FROM snap GROUP BY ALL",
    "snapshot_ticks": with_(**ticks()) + "SELECT * FROM ticks",
    **{f"{u}_diff": _diff_query(u) for u in FORMATS},
    "day_diff_local": _diff_query("day", dense=False, offset_ms=8 * 3_600_000),
    "all_diffs": with_(**ticks()) + f"SELECT tick_ms, {KEY}, " + ", ".join(f"{rnd(diff(u))} AS {u}_diff" for u in FORMATS) + " FROM ticks",
    **{f"daily_{k}": _stat_query(k) for k in ("max", "min", "avg")},
    "daily_reading_stats": with_(
        telemetry=telemetry(),
        slots=f"SELECT {KEY}, cast(floor(ts_ms / 60000.0) AS bigint) AS slot, cast(floor(ts_ms / 86400000.0) AS bigint) AS day, max(value) AS mx, min(value) AS mn, sum(value) AS s, count(*) AS n FROM telemetry GROUP BY ALL",
    ) + (
        f"SELECT (slot + 1) * 60000 AS tick_ms, {KEY}, {rnd('max(mx) OVER w')} AS daily_max, {rnd('min(mn) OVER w')} AS daily_min, "
        f"{rnd('sum(s) OVER w / sum(n) OVER w')} AS daily_avg FROM slots WINDOW w AS (PARTITION BY {KEY}, day ORDER BY slot)"
    ),
    "row_image": with_(**CONFIG, ch=POINT_CHANGES) + "SELECT op, seq, data_id, data_source FROM ch",
    "route_config": with_(**CONFIG, ch=POINT_CHANGES) + (
        "SELECT \"table\", op, seq, data_id AS row_id FROM ch WHERE data_source IN (2, 3) UNION ALL "
        "SELECT 'object', 'r', cast(object_id AS bigint) * 10, object_id FROM objects UNION ALL "
        "SELECT 'object', 'u', cast(object_id AS bigint) * 10 + 1, object_id FROM objects WHERE parent_id IS NOT NULL AND object_id % 5 = 0"
    ),
    "apply_changes": with_(**CONFIG, ch=POINT_CHANGES) + (
        "SELECT data_id, company_id, object_id, data_code, data_type, data_source, formula FROM "
        "(SELECT *, row_number() OVER (PARTITION BY data_id ORDER BY seq DESC) AS rn FROM ch) WHERE rn = 1 AND op <> 'd'"
    ),
    "join_config": with_(**CONFIG) + "SELECT data_id, data_code, object_code, status, p.company_id FROM points p JOIN objects USING (object_id)",
    "tombstones": with_(**CONFIG) + (
        "SELECT cast(p.company_id AS varchar) AS company_id, coalesce(object_code, 'unknown') AS device_code, data_code AS point_code, 0 AS enabled "
        "FROM points p LEFT JOIN (SELECT * FROM objects WHERE status <> 0) o USING (object_id) WHERE data_id % 7 = 0"
    ),
    "resolve_model": with_(**CONFIG) + (
        "SELECT object_id, o.company_id, m.object_code AS model_code, (SELECT min(model_id) FROM models x WHERE x.company_id = o.company_id AND x.object_code = m.object_code) AS model_id "
        "FROM objects o JOIN models m USING (model_id)"
    ),
    "expand_children": with_(**CONFIG) + (
        "SELECT p.object_id, m.model_id, c.object_id AS child_id, c.object_code AS child_code FROM objects p JOIN models m USING (company_id) "
        "JOIN objects c ON c.parent_id = p.object_id AND c.model_id = m.model_id WHERE p.parent_id IS NULL"
    ),
    "parse_formula": with_(**CONFIG) + (
        f"SELECT data_id, {_parsed(0, 'formula')} AS expr, cast({_parsed(1, '1')} AS int) AS expr_type, {_parsed(2, chr(39) * 2)} AS depends_on FROM points WHERE data_source = 2"
    ),
    "parse_call": with_(**CONFIG) + (
        f"SELECT data_id, regexp_extract(formula, '^([a-zA-Z0-9_]+)', 1) AS function, cast(len({_ARGS}) AS int) AS n_args, {_arg(1)} AS arg0, "
        f"CASE WHEN len({_ARGS}) > 1 THEN {_arg(2)} END AS arg1 FROM points WHERE regexp_full_match(formula, '[a-zA-Z0-9_]+\\s*\\(.*\\)')"
    ),
    "compile_same_device": with_(**CONFIG) + (
        f"SELECT data_id, CASE {_same_device(0)} ELSE 'a' END AS expr, CASE {_same_device(1)} END AS depends_on FROM points WHERE formula IS NOT NULL"
    ),
    "compile_functions": with_(**CONFIG_RULES) + (
        "SELECT data_id, expr, expr_type, concat(depends_on ->> '$[0].var', '=', depends_on ->> '$[0].device_code', '.', depends_on ->> '$[0].point_code') AS depends_on, "
        "concat(params ->> '$[0].name', CASE WHEN params = '[]' THEN '' ELSE '=' END, params ->> '$[0].value') AS param "
        f"FROM rules WHERE point_code IN {_FUNCTION_POINTS}"
    ),
    "compile_rules": with_(**CONFIG_RULES) + f"SELECT {RULE_COLUMNS} FROM rules",
    "rejected_rules": with_(**CONFIG) + (
        "SELECT cast(company_id AS varchar) AS company_id, object_code AS device_code, data_code AS point_code, CASE data_code WHEN 'bad' THEN 'unknown function' "
        "WHEN 'week' THEN 'unknown granularity' WHEN 'short' THEN 'too few arguments' ELSE 'unknown model' END AS reason "
        "FROM points JOIN objects USING (object_id, company_id) WHERE data_code IN ('bad', 'week', 'short', 'noModel')"
    ),
    "active_rules": with_(**CONFIG_RULES) + "SELECT company_id, device_code, point_code, expr_type, expr FROM rules WHERE enabled <> 0",
    "upsert_rules": with_(**CONFIG_RULES) + (
        "SELECT company_id, device_code, point_code, "
        "CASE WHEN changed THEN CASE expr_type WHEN 2 THEN 2 ELSE 1 END ELSE expr_type END AS expr_type, "
        "CASE WHEN changed THEN CASE expr_type WHEN 2 THEN 'calcDailyStats(''view'',''min'')' ELSE 'DAILY_STATS' END WHEN expr_type = 0 THEN 'stale' ELSE expr END AS expr, enabled "
        "FROM (SELECT *, data_id % 3 = 0 AND data_id % 6 <> 0 AS changed FROM rules) UNION ALL "
        "SELECT cast(company_id AS varchar), object_code, data_code, 1, 'DAILY_STATS', status FROM points JOIN objects USING (object_id, company_id) "
        "WHERE data_id % 3 = 0 AND data_id % 6 <> 0 AND data_code IN ('bad', 'week', 'short')"
    ),
    "affected_rules": with_(**CONFIG_RULES) + (
        "SELECT DISTINCT r.company_id, r.device_code, r.point_code, p.model_code FROM rules r JOIN "
        "(SELECT object_id, data_code, CASE data_code WHEN 'noModel' THEN 'NOPE' ELSE 'BUILDING' END AS model_code FROM points WHERE data_code IN ('plantSum', 'plantAvg', 'noModel')) p "
        "ON r.point_code = p.data_code AND r.device_code = concat('P', p.object_id) JOIN "
        "(SELECT unnest(CASE WHEN o.object_id % 5 = 0 THEN [parent_id, (parent_id + 1) % 10 + 1] ELSE [parent_id] END) AS parent, m.object_code AS model_code FROM objects o JOIN models m USING (model_id) WHERE o.parent_id IS NOT NULL) t "
        "ON t.parent = p.object_id AND t.model_code = p.model_code"
    ),
    "trigger_rules": with_(**BASE, **CROSS) + " UNION ALL ".join(
        [f"SELECT tick_ms, company_id, device_id AS device_code, '{c}' AS point_code FROM known WHERE {fires}" for c, (fires, _, _) in _FIRES.items()]
        + ["SELECT tick_ms, company_id, device_id, 'cross' FROM cross_wide"]
    ),
    "bind_variables": with_(**BASE, **CROSS) + " UNION ALL ".join(
        [
            f"SELECT tick_ms, company_id, device_id AS device_code, '{c}' AS point_code, cast({a} AS double) AS v_0, cast({b or 'NULL'} AS double) AS v_1 "
            f"FROM known WHERE ({fires}) AND {a} IS NOT NULL" + (f" AND {b} IS NOT NULL" if b else "")
            for c, (fires, a, b) in _FIRES.items()
        ]
        + ["SELECT tick_ms, company_id, device_id, 'cross', a, b FROM cross_known WHERE a IS NOT NULL AND b IS NOT NULL"]
    ),
    "constant_points": with_(**BASE) + (
        f"SELECT tick_ms, company_id, device_id, 'price' AS property_name, cast({PRICE} AS double) AS value FROM known UNION ALL "
        "SELECT tick_ms, company_id, device_id, 'signup', coalesce(k_signup, 12.0) FROM known"
    ),
    "arithmetic_formulas": with_(**LIVE_RULES, telemetry=telemetry(), devs="SELECT cast(company_id AS varchar) AS company_id, object_code AS device_id FROM objects WHERE parent_id IS NOT NULL") + (
        f"SELECT seq, point_code, {rnd('result')} AS result FROM (SELECT seq, point_code, CASE point_code WHEN 'mix' THEN (value + seq % 3) / 2 WHEN 'cross' THEN value - (seq % 3) * 0.5 "
        "WHEN 'weighted' THEN value * (seq % 3) / 100 WHEN 'ratio' THEN CASE WHEN seq % 3 <> 1 THEN value / (seq % 3 - 1) END WHEN 'revenue' THEN value * (seq % 3) + value / 2 WHEN 'chain' THEN value * 2 - seq % 3 END AS result "
        "FROM telemetry JOIN devs USING (company_id, device_id), (VALUES ('mix'), ('cross'), ('weighted'), ('ratio'), ('revenue'), ('chain')) p(point_code)) WHERE result IS NOT NULL"
    ),
    "bit_at": with_(telemetry=telemetry()) + (
        f"SELECT seq, cast(bit AS int) AS bit, cast((cast(floor(abs(value)) AS bigint) * sign({_BITS})::bigint >> (bit - 1)::bigint) & 1 AS double) AS bit_value FROM telemetry, range(1, 10) r(bit)"
    ),
    "derive_aged": aged(180),
    "encode_results": with_(
        **BASE, **CROSS, **PLANT,
        fired="SELECT tick_ms, company_id, device_id, arg_max(project_id, (ts_ms, seq)) AS project_id FROM "
        f"(SELECT *, ({_MINUTE} + 1 + k) * 60000 AS tick_ms FROM telemetry, range(15) r(k)) GROUP BY ALL",
        own="SELECT company_id, device_id, arg_max(project_id, (ts_ms, seq)) AS project_id FROM telemetry GROUP BY ALL",
        parent="SELECT company_id, concat('P', parent_id) AS device_id, max(project_id) AS project_id FROM children JOIN own USING (company_id, device_id) GROUP BY ALL",
    ) + (
        "SELECT tick_ms, company_id, device_id, coalesce(f.project_id, o.project_id, p.project_id) AS project_id, 'tcp' AS gateway_code, property_name, "
        f"{rnd('value')} AS value, snapshot_ms // 1000 * 1000 AS ts_ms FROM ({' UNION ALL BY NAME '.join(DERIVED[c] for c in ('mix', 'cross', 'plantSum'))}) "
        "LEFT JOIN fired f USING (tick_ms, company_id, device_id) LEFT JOIN own o USING (company_id, device_id) LEFT JOIN parent p USING (company_id, device_id)"
    ),
    "rollup_sum": derived("plantSum"),
    "rollup_avg": derived("plantAvg"),
    "rollup_spikes": with_(**{**BASE, "telemetry": f"SELECT * REPLACE ({sample.SPIKED.replace('D ', ' ')} AS value) FROM ({telemetry()})"}, **PLANT)
    + "SELECT tick_ms, snapshot_ms, company_id, device_id, property_name, "
    + f"CASE WHEN abs(value) < 1e15 THEN {rnd('value')} ELSE round(value / 1e9, 0) END AS value FROM ("
    + " UNION ALL BY NAME ".join(
        f"SELECT tick_ms, any_value(snapshot_ms) AS snapshot_ms, company_id, concat('P', parent_id) AS device_id, '{code}' AS property_name, "
        f"cast(sum(cast(value AS DECIMAL(38, 10))) AS double){of} AS value FROM plant_known GROUP BY ALL HAVING count(value) = count(*)"
        for code, of in (("plantSum", ""), ("plantAvg", " / count(*)"))
    ) + ")",
    "arithmetic": derived("mix", "ratio", "revenue", "weighted"),
    "cross_device": derived("cross"),
    "bit_rules": derived("errBit"),
    "diff_rules": derived("clickDay", "viewHour", "viewAll", "clickMonth", "clickYear"),
    "stats_rules": derived("purStat"),
    "chained_rules": derived("chain", "chainDay"),
    "derive_points": derived(*DERIVED),
    "stream_snapshots": with_(telemetry=telemetry(), snap=SNAP) + f"SELECT * FROM snap WHERE {_PASSED}",
    "stream_device_state": with_(**ticks()) + (
        f"SELECT * FROM (SELECT tick_ms, snapshot_ms, {KEY}, {rnd(diff('day'))} AS day_diff, "
        f"{rnd('avg(value) OVER ' + _DAYS)} AS day_avg FROM ticks) WHERE {_PASSED}"
    ),
    "asof_history": with_(probes=PROBES, history=HISTORY) + f"SELECT p.probe_id, p.company_id, p.device_id, p.property_name, p.ts_ms, h.property_num_value {_ASOF}",
    "asof_history_full": with_(probes=PROBES, history=HISTORY) + (
        "SELECT p.probe_id, h.data_id, epoch_us(h.data_date) // 1000 AS data_date, h.data_type, h.project_id, h.gateway_code, h.protocol_code, h.product_id, h.property_value, "
        f"h.property_num_value, h.message_id, h.timestamp, epoch_us(h.create_date) // 1000 AS create_date, h.year, h.month, h.day, h.hour {_ASOF}"
    ),
}
