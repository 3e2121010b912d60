"""The same results in plain SQL, for an independent engine."""

from __future__ import annotations

from namewake.entities import ENTITIES, EntitySpec
from namewake.plans.tables import PRIORITIES

_OP = "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END"
_NAME = "event_type || '#' || CAST(event_id AS VARCHAR)"
_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
_PRIORITY = (
    "CASE event_id % 5 "
    + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PRIORITIES))
    + " END"
)


def _changes(key: str = "user_id", name: str = _NAME, alias: str = "chg") -> str:
    return (
        f"{alias} AS (SELECT {key} AS key, {_OP} AS op_type, {name} AS name, ts, event_id "
        "FROM events)"
    )


def _last(source: str = "chg", alias: str = "last_u", where: str = "WHERE op_type = 'U'") -> str:
    return (
        f"{alias} AS (SELECT key, op_type, name, event_id FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY key ORDER BY ts DESC, event_id DESC) AS rn FROM {source} {where}) "
        "WHERE rn = 1)"
    )


_LAST_U = f"WITH {_changes()}, {_last()}"
_LAST_ANY = f"WITH {_changes()}, {_last(where='')}"
_OLD = "'old#' || CAST(o_custkey AS VARCHAR)"
_ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


def _upsert(name: str = _NAME, when: str = "u.key IS NOT NULL") -> str:
    return (
        f"WITH {_changes(name=name)}, {_last()} SELECT {_ORDER}, "
        f"CASE WHEN {when} THEN u.name ELSE {_OLD} END AS customer_name "
        "FROM orders LEFT JOIN last_u u ON o_custkey = u.key"
    )


def _plan() -> str:
    keys = ", ".join(
        f"abs(o_custkey - {i}) AS {spec.fk}" for i, spec in enumerate(ENTITIES.values())
    )
    return (
        "plan AS (SELECT o_orderkey AS PLAN_ID, o_orderstatus AS op_type, "
        "o_orderpriority AS PLAN_NAME, o_orderkey AS ORIGINAL_PLAN_ID, "
        "o_orderkey % 7 AS PORTFOLIO_PLAN_ID, o_orderkey % 11 AS PRG_PLAN_ID, "
        f"o_orderkey % 3 AS REVISION_NO, o_orderkey % 13 AS STEW_LINK_ID, {keys} FROM orders)"
    )


def _entity(spec: EntitySpec) -> str:
    keep = "".join(f", p.{c}" for c in spec.keep)
    return (
        f"{_LAST_U}, {_plan()} SELECT p.PLAN_ID, p.op_type, p.{spec.fk}, "
        f"'{spec.entity}:' || u.name AS {spec.plan_name}{keep} "
        f"FROM plan p JOIN last_u u ON p.{spec.fk} = u.key"
    )


def _all_entities() -> str:
    names = ", ".join(
        f"'{s.entity}:' || u{i}.name AS {s.plan_name}" for i, s in enumerate(ENTITIES.values())
    )
    joins = " ".join(
        f"LEFT JOIN last_u u{i} ON p.{s.fk} = u{i}.key" for i, s in enumerate(ENTITIES.values())
    )
    return f"{_LAST_U}, {_plan()} SELECT p.PLAN_ID, p.op_type, {names} FROM plan p {joins}"


_NARROW = (
    f"{_LAST_U} SELECT o_orderkey, o_orderstatus, o_custkey, u.name AS customer_name "
    "FROM orders JOIN last_u u ON o_custkey = u.key"
)
_BOTH = (
    f"WITH {_changes()}, {_last()}, {_changes(key=_PRIORITY, alias='chg_p')}, "
    f"{_last('chg_p', 'last_p')} SELECT {_ORDER}, "
    f"CASE WHEN u.key IS NOT NULL THEN u.name ELSE {_OLD} END AS customer_name, "
    "CASE WHEN p.key IS NOT NULL THEN p.name END AS priority_name "
    "FROM orders LEFT JOIN last_u u ON o_custkey = u.key "
    "LEFT JOIN last_p p ON o_orderpriority = p.key"
)

_LIVE = f"{_LAST_ANY} SELECT key, op_type, name, event_id FROM last_u WHERE op_type <> 'D'"


def _varint_hex(number: str) -> str:
    """Hex of a zigzag number of up to 62 bits that is not negative."""
    z = f"(2 * CAST({number} AS BIGINT))"
    return (
        f"array_to_string(list_transform(list_filter(range(0, 9), lambda k: k = 0 OR ({z} >> CAST(7 * k AS INT)) > 0), "
        f"lambda k: printf('%02X', (({z} >> CAST(7 * k AS INT)) & 127) | "
        f"CASE WHEN ({z} >> CAST(7 * (k + 1) AS INT)) > 0 THEN 128 ELSE 0 END)), '')"
    )


def _text_hex(text: str) -> str:
    return f"({_varint_hex(f'octet_length(encode({text}))')} || hex({text}))"


_AVRO = (
    "'0000000007' || " + _varint_hex("o_orderkey")
    + f" || CASE WHEN o_orderkey % 7 = 0 THEN '00' ELSE '02' || {_varint_hex('o_custkey')} END"
    + f" || {_text_hex('o_orderstatus')}"
    + f" || CASE WHEN o_orderkey % 5 = 0 THEN '02' ELSE '00' || {_text_hex('o_orderpriority')} END"
)

_REPORT_ALL = f"WITH {_changes(key='user_id * 11')}, {_last()}, {_plan()} " + " UNION ALL ".join(
    f"SELECT '{s.entity}' AS entity, CAST(key AS VARCHAR) AS key, '{s.entity}:' || name AS name "
    f"FROM last_u WHERE NOT EXISTS (SELECT 1 FROM plan WHERE {s.fk} = last_u.key)"
    for s in ENTITIES.values()
)


def _state(k: int) -> str:
    """The star after the first ``k`` thirds of the events."""
    upto = f"WHERE op_type = 'U' AND event_id <= (SELECT max(event_id) * {k} // 3 FROM events)"
    return (
        f"SELECT * FROM (WITH {_last(where=upto)}, {_last('chg_p', 'last_p', where=upto)} "
        f"SELECT o_orderkey, {k} AS state, CASE WHEN u.key IS NOT NULL THEN u.name ELSE {_OLD} END AS customer_name, "
        "p.name AS priority_name FROM orders LEFT JOIN last_u u ON o_custkey = u.key "
        "LEFT JOIN last_p p ON o_orderpriority = p.key)"
    )


ORACLES: dict[str, str] = {
    "change_extract": f"WITH {_changes()} SELECT key, op_type, name FROM chg",
    "update_filter": f"WITH {_changes()} SELECT key, op_type, name FROM chg WHERE op_type = 'U'",
    "latest_update_per_key": f"{_LAST_U} SELECT key, name, event_id FROM last_u",
    "compact_latest": f"{_LAST_ANY} SELECT key, op_type, name, event_id FROM last_u",
    "compact_live": _LIVE,
    "stream_compact_live": _LIVE,
    "rekey": (
        "SELECT CAST(user_id AS VARCHAR) AS key, hex(CAST(user_id AS VARCHAR)) AS key_hex, "
        "event_id, user_id, event_type, value, props FROM events"
    ),
    "rekey_bucketed_join": (
        "SELECT CAST(user_id AS VARCHAR) AS key, event_id, event_type, c_name FROM events "
        "LEFT JOIN customer ON user_id = c_custkey"
    ),
    "key_lookup": (
        f"SELECT {_ORDER}, {_OLD} AS customer_name FROM orders WHERE o_custkey = 42"
    ),
    "propagate_narrow": _NARROW,
    "stream_partial_rows": _NARROW,
    "propagate_wide": (
        f"{_LAST_U} SELECT {_ORDER}, u.name AS customer_name "
        "FROM orders JOIN last_u u ON o_custkey = u.key"
    ),
    "unmatched_updates": (
        f"WITH {_changes(key='user_id * 11')}, {_last()} SELECT key, name FROM last_u u "
        "WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = u.key)"
    ),
    "upsert_target": _upsert(),
    "upsert_null_name": _upsert(name=f"CASE WHEN {_K} < 10 THEN NULL ELSE {_NAME} END"),
    "multi_entity": _BOTH,
    "stream_multi_entity": _BOTH,
    "star_enrich": (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, p_name, s_name, "
        "sn.n_name AS supp_nation, sr.r_name AS supp_region, o_orderpriority, c_name, "
        "cn.n_name AS cust_nation, cr.r_name AS cust_region FROM lineitem "
        "LEFT JOIN part ON l_partkey = p_partkey "
        "LEFT JOIN supplier ON l_suppkey = s_suppkey "
        "LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey "
        "LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey "
        "LEFT JOIN orders ON l_orderkey = o_orderkey "
        "LEFT JOIN customer ON o_custkey = c_custkey "
        "LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey "
        "LEFT JOIN region cr ON cn.n_regionkey = cr.r_regionkey"
    ),
    "star_from_feed": (
        f"WITH {_changes()}, {_last(where='')}, {_changes(key=_PRIORITY, alias='chg_p')}, "
        f"{_last('chg_p', 'last_p', where='')} SELECT o_orderkey, o_custkey, o_orderpriority, "
        "u.name AS customer_now, p.name AS priority_now FROM orders "
        "LEFT JOIN last_u u ON o_custkey = u.key AND u.op_type <> 'D' "
        "LEFT JOIN last_p p ON o_orderpriority = p.key AND p.op_type <> 'D'"
    ),
    "to_json_value": (
        f"SELECT CAST(o_orderkey AS VARCHAR) AS msg_key, {_ORDER}, {_OLD} AS customer_name, "
        "hex(format('{{\"o_orderkey\":{},\"o_custkey\":{},\"o_orderstatus\":\"{}\",\"o_totalprice\":{},"
        "\"o_orderpriority\":\"{}\",\"customer_name\":\"old#{}\"}}', o_orderkey, o_custkey, o_orderstatus, "
        "CAST(o_totalprice AS VARCHAR), o_orderpriority, o_custkey)) AS msg_hex FROM orders"
    ),
    "framed_value": (
        "SELECT event_id, '0000000015' || hex(props) AS message_hex, 21 AS schema_id, props FROM events"
    ),
    "union_unwrap": f"SELECT event_id, {_K} AS k, event_type AS kind FROM events",
    "keyed_line_records": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey AS PLAN_ID, "
        "o_custkey AS ADVERTISER_ID, o_orderpriority AS PLAN_NAME, "
        "CAST(NULL AS BIGINT) AS AGENCY_ID, format('\"{}\":{{\"PLAN_ID\":{},\"ADVERTISER_ID\":"
        "{{\"long\": {}}}, \"PLAN_NAME\" :\"{}\",\"AGENCY_ID\":null}}', o_orderkey, o_orderkey, o_custkey, "
        "o_orderpriority) AS line FROM orders"
    ),
    "date_parse": (
        "SELECT o_orderkey, upper(strftime(o_orderdate, '%d-%b-%y')) AS text, "
        "strftime(strptime(strftime(o_orderdate, '%d-%b-20%y'), '%d-%b-%Y'), '%Y-%m-%d') AS day "
        "FROM orders"
    ),
    "time_parse": f"SELECT event_id, {_TS} AS text, strftime(ts, '%Y%m%d%H%M%S.%f') AS at FROM events",
    "avro_schema_to_struct": (
        "SELECT event_id, user_id, event_type, props, 'event_id:bigint,user_id:bigint,event_type:string,"
        "props:string' AS fields, format('{{\"event_id\":{},\"user_id\":{},\"event_type\":\"{}\",\"props\":{}}}', "
        "event_id, user_id, event_type, CAST(to_json(props) AS VARCHAR)) AS text FROM events"
    ),
    "avro_encode": f"SELECT o_orderkey, {_AVRO} AS message_hex FROM orders",
    "avro_decode": (
        f"WITH sent AS (SELECT *, {_AVRO} AS whole, o_orderkey % 11 = 0 AS cut FROM orders) SELECT o_orderkey AS sent_key, "
        "CASE WHEN cut THEN left(whole, length(whole) - 2) ELSE whole END AS message_hex, "
        "CASE WHEN NOT cut THEN o_orderkey END AS o_orderkey, "
        "CASE WHEN NOT cut AND o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey, "
        "CASE WHEN NOT cut THEN o_orderstatus END AS o_orderstatus, "
        "CASE WHEN NOT cut AND o_orderkey % 5 <> 0 THEN o_orderpriority END AS o_orderpriority FROM sent"
    ),
    "mixed_schema_feed": (
        "SELECT event_id AS sent_id, event_id % 3 + 1 AS schema_id, "
        + ", ".join(f"CASE WHEN event_id % 3 < 2 THEN {c} END AS {c}" for c in ("event_id", "user_id", "event_type"))
        + ", CASE WHEN event_id % 3 = 1 THEN props END AS props, CASE WHEN event_id % 3 < 2 THEN 'feed' END AS origin FROM events"
    ),
    "select_star_view": (
        f"SELECT event_id, {_TS} AS ts, user_id, event_type, value, props FROM events"
    ),
    "stream_rekey": (
        "SELECT event_type AS key, event_id, user_id, event_type, value, props FROM events"
    ),
    "stream_report": (
        f"WITH {_changes(key='user_id * 11')}, {_last()} "
        "SELECT 'customer' AS entity, CAST(key AS VARCHAR) AS key, name FROM last_u u "
        "WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = u.key)"
    ),
    "stream_report_all": _REPORT_ALL,
    "stream_report_index": _REPORT_ALL,
    "stream_counts": (
        f"WITH {_changes()} SELECT count(*) AS changes, count(*) FILTER (op_type = 'U') AS updates, "
        "count(*) FILTER (key IS NULL) AS without_key FROM chg"
    ),
    "upsert_without_updates": f"SELECT {_ORDER}, {_OLD} AS customer_name FROM orders",
    "mixed_case_columns": _NARROW,
    "stream_upserted_rows": _upsert(),
    "stream_old_files": _upsert(),
    "stream_fold_two_entities": _BOTH,
    "stream_fold_beside_writer": _upsert(),
    "upsert_buckets": _upsert(),
    "key_lookup_skipping": f"{_upsert()} WHERE o_custkey = 42",
    "star_as_of": (
        f"WITH {_changes()}, {_changes(key=_PRIORITY, alias='chg_p')} " + " UNION ALL ".join(map(_state, (1, 2, 3)))
    ),
    "stream_propagate": _upsert(),
    "stream_resume": _upsert(),
    "stream_late_rows": _upsert(when="u.key IS NOT NULL AND o_orderkey % 2 = 0"),
    "stream_fold": _upsert(),
    "stream_all_entities": _all_entities(),
    "change_log": (
        f"SELECT CAST(user_id AS VARCHAR) AS msg_key, {_OP} AS op_type, "
        "lpad(CAST(event_id AS VARCHAR), 20, '0') AS pos, user_id AS PROPERTY_ID, "
        f"'property:' || {_NAME} AS PROPERTY_NAME FROM events"
    ),
    "change_log_compacted": (
        f"{_LAST_ANY} SELECT CAST(key AS VARCHAR) AS msg_key, op_type, "
        "'division:' || name AS CHANNEL_DIVISION_NAME FROM last_u"
    ),
    "change_log_two_queries": (
        f"WITH {_changes()}, last_c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key "
        "ORDER BY event_id <= (SELECT max(event_id) // 2 FROM events) DESC, event_id DESC) AS rn FROM chg) "
        "WHERE rn = 1) SELECT CAST(key AS VARCHAR) AS msg_key, op_type, 'agency:' || name AS AGENCY_NAME "
        "FROM last_c WHERE op_type <> 'D'"
    ),
    "stream_from_log": (
        "SELECT CAST(user_id AS VARCHAR) AS msg_key, event_id > (SELECT max(event_id) * 2 // 3 FROM events) AS late, "
        f"lpad(CAST(event_id AS VARCHAR), 20, '0') AS pos, 'property:' || {_NAME} AS PROPERTY_NAME FROM events "
        "WHERE event_id > (SELECT max(event_id) // 3 FROM events)"
    ),
    "change_log_raw": (
        "WITH lines AS (SELECT event_id % 97 = 0 AS broken, CAST(user_id AS VARCHAR) AS k, "
        "CASE WHEN event_id % 97 = 0 THEN 'no record ' || event_id ELSE format('{{\"op_type\": \"U\",  "
        "\"PROPERTY_ID\": {}, \"PROPERTY_NAME\": \"{}\", \"EXTRA\": \"{}\"}}', user_id, event_type, event_id) END "
        "AS line FROM events) SELECT CASE WHEN NOT broken THEN k END AS msg_key, line AS msg_value, "
        "'logged' AS \"in\" FROM lines UNION ALL SELECT NULL, line, 'rejected' FROM lines WHERE broken"
    ),
} | {f"entity_{e}": _entity(spec) for e, spec in ENTITIES.items()}
