"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

from countermill.functions.types import WIDENING_ORDER
from countermill.plans.queries import EVENT_DAY, ORDER_DAY
from countermill.plans.standins import CATALOG_TYPES, COUNTERS, KEY_ROWS
from countermill.schemas import VECTOR_BINS

# Events as counter rows: quarter hour, names and whole hundredths.
LONG = """
SELECT event_id, user_id, ts, event_type,
       time_bucket(INTERVAL 15 MINUTE, ts) AS start,
       strftime(ts, '%Y%m%d') AS date_id,
       'SubNetwork=S,MeContext=' || user_id AS nedn,
       CAST(user_id AS VARCHAR) AS node,
       'ManagedElement=1,Cell' || (user_id % 5) || '=' || user_id AS moid,
       'Cell' || (user_id % 5) AS measurement,
       CAST(floor(value * 100) AS BIGINT) AS v
FROM events
"""

# What a document per user and quarter hour says: the last value of each counter.
DOC = f"""
SELECT user_id, start, event_type, min(date_id) AS date_id, min(nedn) AS nedn, min(node) AS node,
       min(moid) AS moid, min(measurement) AS measurement,
       arg_max(v, event_id) AS v, count(*) AS times
FROM ({LONG}) GROUP BY user_id, start, event_type
"""

ORDER_PATH = "'/in/' || o_orderkey || '.xml'"
LINE_PATH = "'/in/' || l_orderkey || '.xml'"


def _wide(aggregate: str) -> str:
    """One aggregate per counter; ``{c}`` stands for the counter."""
    return ", ".join(aggregate.format(c=c) for c in COUNTERS)


FIRST = _wide("arg_min(v, event_id) FILTER (WHERE event_type = '{c}') AS {c}")
SUMS = _wide("CAST(sum(v) FILTER (WHERE event_type = '{c}') AS BIGINT) AS {c}")

PIVOT = f"""
SELECT date_id, '900' AS granularity, moid, nedn, node, start AS ropendtime, {FIRST}
FROM ({LONG}) GROUP BY date_id, moid, nedn, node, start
"""

_BINS = ", ".join(
    f"CAST(floor(CAST(embedding[{i + 1}] AS DOUBLE) * 1000) AS BIGINT) AS bin{i}" if i < 64 else f"CAST(NULL AS BIGINT) AS bin{i}"
    for i in range(VECTOR_BINS)
)

_ESCAPED = """replace(replace(replace(replace(
    replace(replace(replace(replace(text, chr(150), ' '), chr(160), ' '), '›', ''), chr(133), '...'),
    '&', '&amp;'), '"', '&quot;'), '>', '&gt;'), '<', '&lt;')"""
_UNESCAPED = """replace(replace(replace(replace(replace(
    escaped, '&lt;', '<'), '&gt;', '>'), '&apos;', ''''), '&quot;', '"'), '&amp;', '&')"""

_HASH = "CAST(('0x' || substr(md5(c_name), 1, 8)) AS BIGINT)"

BACKLOG = f"SELECT {LINE_PATH} AS path, CASE WHEN l_linestatus = 'F' THEN 'Parsed' END AS status FROM lineitem"
LISTING = f"SELECT {ORDER_PATH} AS path FROM orders WHERE o_orderstatus <> 'P'"
ORDER_BACKLOG = f"""
SELECT {ORDER_PATH} AS path, CASE WHEN o_orderstatus = 'F' THEN 'Parsed' END AS status, o_orderdate AS received,
       o_orderpriority FROM orders
"""

AGED = f"""
SELECT min(strftime(ts, '%Y%m%d')) FROM events
WHERE ts BETWEEN DATE '{EVENT_DAY}' - INTERVAL 5 DAY AND DATE '{EVENT_DAY}' - INTERVAL 3 DAY
"""
HOT = "SELECT event_id, strftime(ts, '%Y%m%d') AS date_id, CAST(floor(value * 100) AS BIGINT) AS counter_value FROM events"

VERSION_COLUMNS = """
SELECT DISTINCT o_orderpriority AS entity, 'v' || year(o_orderdate) AS version, o_orderstatus AS "column",
       CASE WHEN year(o_orderdate) % 4 = 0 THEN 'BIGINT' WHEN year(o_orderdate) % 4 = 1 THEN 'INT'
            WHEN year(o_orderdate) % 4 = 2 AND o_orderstatus = 'P' THEN 'VARCHAR'
            WHEN o_orderpriority = '5-LOW' THEN 'MISSING' ELSE 'DOUBLE' END AS type
FROM orders
"""

_KEY = "CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey END"
STITCHED = f"""
SELECT k, x, y, z
FROM (SELECT {_KEY} AS k, o_custkey AS x FROM orders WHERE o_orderstatus <> 'P')
FULL JOIN (SELECT {_KEY} AS k, o_totalprice AS y FROM orders WHERE o_orderstatus <> 'F') USING (k)
FULL JOIN (SELECT {_KEY} AS k, o_orderstatus AS z FROM orders) USING (k)
"""

_PART = "SELECT nullif(p_brand, 'Brand#2') AS p_brand, p_type, p_size FROM part"

ENTITIES = """
SELECT n_name || ':' || s_name AS eid, n_name AS techpack_version_id, s_suppkey, r_name, r_regionkey, n_regionkey, n_nationkey,
       'E' || s_suppkey || CASE WHEN s_acctbal < 0 THEN '_1' ELSE '' END AS reportable_entity_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
ENTITY_COLUMNS = f"""
SELECT DISTINCT reportable_entity_name, techpack_version_id, 'pm' || l_linenumber AS entity_column_name,
       l_linenumber AS entity_column_order,
       CASE WHEN l_linenumber <= 2 THEN 'key' ELSE 'counter' END AS entity_column_type,
       CASE WHEN l_linenumber = 1 THEN 'STRING' WHEN l_linenumber = 7 THEN 'ARRAY<BIGINT>:16' ELSE 'DOUBLE' END AS entity_data_type,
       'Cell' AS source_entity_name, 'src_pm' || l_linenumber AS source_entity_column_name
FROM ({ENTITIES}) JOIN lineitem ON s_suppkey = l_suppkey
"""

ATTRIBUTES = """
SELECT replace(p_brand, '#', '-') AS mo_name,
       CASE WHEN p_size % 5 = 0 THEN 'pmFlex' WHEN p_size % 7 = 0 THEN 'other' ELSE 'pm' END
         || '.' || replace(p_name, ' ', '-') || p_partkey AS name,
       CASE WHEN p_type = 'PROMO' THEN 'PDF' ELSE 'PEG' END AS counter_type,
       CAST(p_size AS VARCHAR) AS max_length, p_size
FROM part
"""
ROUTED = f"""
SELECT *, 'PM_X' AS target_package_name,
       replace('PM_X_' || upper(mo_name)
         || CASE WHEN counter_type = 'PDF' THEN '_V' WHEN starts_with(name, 'pmFlex') THEN '_FLEX' ELSE '' END, '-', '_') AS tab
FROM ({ATTRIBUTES}) WHERE counter_type = 'PDF' OR starts_with(name, 'pm')
"""
NUMBERED = f"""
SELECT *, lower(replace(replace(name, '-', '_'), '.', '_')) AS cname,
       row_number() OVER (PARTITION BY tab ORDER BY lower(replace(replace(name, '-', '_'), '.', '_'))) - 1 AS rn,
       count(*) OVER (PARTITION BY tab) AS total
FROM ({ROUTED})
"""
ROUTED_COLUMNS = f"""
SELECT target_package_name, CASE WHEN total > 42 THEN tab || '_' || (rn // 42) ELSE tab END AS "table",
       cname AS entity_column_name, CAST(8 + rn % 42 AS INTEGER) AS entity_column_order,
       mo_name AS source_entity_name, name AS source_entity_column_name,
       CASE WHEN counter_type = 'PDF' THEN 'ARRAY<BIGINT>:' || max_length ELSE 'BIGINT' END AS entity_data_type,
       CASE WHEN counter_type = 'PDF' AND p_size > 25 THEN 'COMPRESSED_PDF' ELSE counter_type END AS entity_counter_type,
       'counter' AS entity_column_type
FROM ({NUMBERED})
"""
_KEYS = ", ".join(f"('{name}', {order}, '{kind}', '{counter}')" for name, order, kind, counter in KEY_ROWS)


def _properties(name: str, nation: str, segment: str, source: str) -> str:
    path = f"'Node/' || {name} AS path"
    return f"""
    SELECT {path}, 'nation' AS prop, CAST({nation} AS VARCHAR) AS value FROM {source}
    UNION ALL SELECT {path}, 'segment', {segment} FROM {source}"""


OLD_MODEL = _properties("c_name", "c_nationkey", "c_mktsegment", "customer")
NEW_MODEL = (
    _properties(
        "c_name",
        "c_nationkey",
        "CASE WHEN c_nationkey = 3 THEN NULL ELSE replace(c_mktsegment, 'MACHINERY', 'MACHINES') END",
        "(SELECT * FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey))",
    )
    + " UNION ALL "
    + _properties("s_name", "s_nationkey", "'SUPPLY'", "supplier")
)

LOG_LINES = """
SELECT CAST(user_id AS VARCHAR) AS source_file, event_id, event_type = 'signup' AS is_header,
       CASE WHEN event_type = 'signup'
            THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' [t' || user_id || '] INFO Session - opened ' || event_id
            ELSE '  at ' || event_type || ' ' || event_id END AS line,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime,
       CASE WHEN event_type = 'signup' THEN 'opened ' || event_id
            ELSE '  at ' || event_type || ' ' || event_id END AS part
FROM events
"""
LOG_NUMBERED = f"""
SELECT *, sum(CASE WHEN is_header THEN 1 ELSE 0 END) OVER (PARTITION BY source_file ORDER BY event_id) AS record
FROM ({LOG_LINES})
"""

REPLICATION = """
WITH e AS (
  SELECT event_id, event_type, 'c' || user_id AS cuid, 'n' || user_id AS name, 'k' || (user_id % 3) AS kind,
         CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS num, strftime(ts, '%Y%m%d') AS day
  FROM events),
last_field AS (
  SELECT *, CASE event_type WHEN 'click' THEN 'message ' || event_id WHEN 'purchase' THEN num ELSE kind END AS field,
         lag(event_type) OVER (PARTITION BY day ORDER BY event_id) AS before,
         lag(event_id) OVER (PARTITION BY day ORDER BY event_id) AS before_id
  FROM e),
errors AS (
  SELECT field AS target_id, arg_max('message ' || before_id, event_id) AS message
  FROM last_field WHERE before = 'click' GROUP BY field),
exported AS (SELECT cuid, max(event_id) AS at, arg_max(num, event_id) AS num FROM e WHERE event_type = 'signup' GROUP BY cuid),
state AS (
  SELECT e.cuid, min(e.name) AS name, min(e.kind) AS kind, any_value(x.num) AS source_id,
         arg_max(e.num, e.event_id) FILTER (WHERE e.event_type = 'view' AND e.event_id > coalesce(x.at, -1)) AS target_id,
         count(*) FILTER (WHERE e.event_type = 'error' AND e.event_id > coalesce(x.at, -1)) > 0 AS deleted
  FROM e LEFT JOIN exported x ON e.cuid = x.cuid
  WHERE e.event_type IN ('signup', 'view', 'error') GROUP BY e.cuid)
SELECT cuid, name, coalesce(source_id, '') AS source_id, coalesce(s.target_id, '') AS target_id, kind AS si_kind, deleted,
       message IS NOT NULL AS error, coalesce(message, 'Null') AS error_message
FROM state s LEFT JOIN errors r ON coalesce(s.target_id, '') = r.target_id
"""

_COUNTED = f"""
SELECT date_id, measurement, event_type AS counter_name, count(*) AS rows, CAST(sum(v) AS BIGINT) AS total
FROM ({DOC}) GROUP BY date_id, measurement, event_type
"""

# Structs in structs, opened level by level; a path ends at a struct it has passed.
CLOSURE = """
WITH RECURSIVE structs AS (
  SELECT DISTINCT CAST(p_size AS VARCHAR) AS struct_name, p_type AS member,
         CASE WHEN p_type = 'ECONOMY' THEN 'e' || (p_size % 4) END AS enum_ref,
         CASE WHEN p_type = 'PROMO' THEN CAST(CASE WHEN p_size = 1 THEN 48 WHEN p_size % 9 = 0 THEN -1 ELSE p_size // 2 END AS VARCHAR) END AS struct_ref
  FROM part),
walk AS (
  SELECT struct_name AS root, [] :: VARCHAR[] AS names, [struct_name] AS passed, 'open' AS kind, struct_name AS ref
  FROM (SELECT DISTINCT {root} AS struct_name FROM {roots})
  UNION ALL
  SELECT w.root, CASE WHEN s.struct_name IS NULL THEN w.names ELSE list_append(w.names, s.member) END,
         CASE WHEN s.struct_ref IS NULL THEN w.passed ELSE list_append(w.passed, s.struct_ref) END,
         CASE WHEN s.struct_name IS NULL THEN 'undefined' WHEN list_contains(w.passed, s.struct_ref) THEN 'cycle'
              WHEN s.struct_ref IS NOT NULL THEN 'open' WHEN s.enum_ref IS NOT NULL THEN 'enum' ELSE 'member' END,
         CASE WHEN s.struct_name IS NULL THEN w.ref ELSE coalesce(s.struct_ref, s.enum_ref) END
  FROM walk w LEFT JOIN structs s ON s.struct_name = w.ref WHERE w.kind = 'open'),
closure AS (
  SELECT root, array_to_string(names, '.') AS path, CAST(len(names) AS INTEGER) AS depth, kind, ref FROM walk WHERE kind <> 'open')
"""

ORACLE: dict[str, str] = {
    "q_mdc_files": _COUNTED,
    "q_stream_mdc": _COUNTED,
    "q_mdc_parts": f"""
        SELECT nedn, count(*) AS blocks, min(m) AS first_mts, max(m) AS last_mts
        FROM (SELECT DISTINCT nedn, strftime(start, '%Y%m%d%H%M%S') || 'Z' AS m FROM ({LONG})) GROUP BY nedn
    """,
    "q_long_batches": f"""
        SELECT date_id, measurement, event_type AS counter_name, count(*) AS rows, CAST(sum(v) AS BIGINT) AS total
        FROM ({LONG}) GROUP BY date_id, measurement, event_type
    """,
    "q_counter_pivot": PIVOT,
    "q_counter_pivot_native": PIVOT,
    "q_counter_pivot_sum": f"SELECT date_id, node, {SUMS} FROM ({DOC}) GROUP BY date_id, node",
    "q_mdc_long": f"""
        SELECT date_id, '900' AS granularity, moid, nedn, node, measurement,
               strftime(start, '%Y%m%d%H%M%S') AS ropendtime, strftime(start, '%Y%m%d%H%M%S') AS utc_timestamp,
               strftime(start, '%Y%m%d%H%M%S') AS local_timestamp, event_type AS counter_name, v AS counter_value
        FROM ({DOC})""",
    "q_mdc_entity": f"""
        SELECT date_id, measurement, moid, node, {SUMS} FROM ({DOC}) GROUP BY date_id, measurement, moid, node""",
    "q_entity_map_lookup": f"""
        SELECT date_id AS day, moid AS object, user_id || '/' || strftime(start, '%Y%m%d%H%M') AS file,
               {_wide("CAST(max(v) FILTER (WHERE event_type = '{c}') AS VARCHAR) AS pm_{c}")}
        FROM ({DOC}) GROUP BY date_id, moid, user_id, start""",
    "q_entity_merge_first": f"""
        SELECT date_id, node, {_wide("arg_min(v, start) FILTER (WHERE event_type = '{c}') AS {c}")}
        FROM ({DOC}) GROUP BY date_id, node""",
    "q_entity_merge_sum": f"SELECT date_id, node, {SUMS} FROM ({DOC}) GROUP BY date_id, node",
    "q_counter_map_values": f"""
        SELECT user_id || '/' || strftime(start, '%Y%m%d%H%M') AS file, event_type AS counter_name_raw,
               CAST(v AS VARCHAR) AS counter_value_raw
        FROM ({DOC}) WHERE event_type IN ('view', 'error')""",
    "q_vector_bins": f"SELECT vec_id, 'pmVec' AS counter_name, {_BINS} FROM embeddings",
    "q_vector_long": """
        SELECT vec_id, 'pmVec' AS counter_name, CAST(i AS INTEGER) AS bin,
               CAST(floor(CAST(embedding[i + 1] AS DOUBLE) * 1000) AS BIGINT) AS value
        FROM embeddings, range(64) AS r(i)""",
    "q_counter_coverage": f"""
        SELECT measurement, count(DISTINCT event_type) AS counter_count,
               string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS counters
        FROM ({LONG}) GROUP BY measurement""",
    "q_path_profile": f"""
        WITH d AS (SELECT count(*) AS counters, count(DISTINCT (user_id, start)) AS docs,
                          count(*) + count(*) FILTER (WHERE times > 1) AS results FROM ({DOC})),
        p AS (SELECT unnest(['mdc', 'mdc.mfh', 'mdc.mfh.sn', 'mdc.md', 'mdc.md.mi', 'mdc.md.mi.mts', 'mdc.md.mi.gp',
                             'mdc.md.mi.mv', 'mdc.md.mi.mv.moid']) AS path, docs AS n FROM d
              UNION ALL SELECT 'mdc.md.mi.mt', counters FROM d UNION ALL SELECT 'mdc.md.mi.mv.r', results FROM d)
        SELECT path, CASE WHEN n > 1 THEN 'Multiple' ELSE 'Single' END AS occurrence,
               split_part(path, '.', -1) IN ('sn', 'mts', 'gp', 'mt', 'moid', 'r') AS contains_text,
               CASE WHEN path = 'mdc.md.mi.mv.r' THEN 'p' ELSE '' END AS attributes
        FROM p""",
    "q_batch_fanout": f"""
        SELECT 'long' AS sink, date_id, event_type AS name, count(*) AS rows, CAST(sum(v) AS BIGINT) AS total
        FROM ({DOC}) GROUP BY date_id, event_type
        UNION ALL
        SELECT 'entity', date_id, measurement, count(DISTINCT moid),
               CAST(sum(v) FILTER (WHERE event_type = 'view') AS BIGINT)
        FROM ({DOC}) GROUP BY date_id, measurement
        UNION ALL
        SELECT 'files', NULL, 'Parsed', count(DISTINCT user_id % 8), NULL FROM events
        UNION ALL
        SELECT 'files', NULL, 'Dropped', 2, NULL""",
    "q_file_listing": """
        SELECT 'o_orderstatus=' || o_orderstatus || '/o_orderpriority=' || o_orderpriority AS folder, 'new' AS outcome,
               CAST(18 + length(CAST(count(*) AS VARCHAR)) AS BIGINT) AS size, true AS dated
        FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_orderstatus, o_orderpriority
        UNION ALL SELECT 'o_orderstatus=O/empty', 'new', 0, false
        UNION ALL SELECT '/gone/lost.xml', 'failed', NULL, false""",
    "q_stream_ingest": f"""
        SELECT date_id, event_type AS counter_name, count(*) AS rows, CAST(sum(v) AS BIGINT) AS total
        FROM ({LONG}) GROUP BY date_id, event_type""",
    "q_rdn_scalars": """
        SELECT o_orderkey, 'OrderFDD' AS measurement, CAST(o_orderkey AS VARCHAR) AS node,
               strftime(o_orderdate, '%Y%m%d') AS date_id,
               strftime(o_orderdate - INTERVAL 330 MINUTE, '%Y%m%d%H%M') AS instant,
               strftime(o_orderdate, '%Y%m%d%H%M') AS wall_clock,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END AS first_value,
               lower(replace(replace(o_orderpriority, '-', '_'), '.', '_')) AS column_name,
               CAST(o_orderkey AS VARCHAR) AS seconds,
               (o_orderkey % 15) BETWEEN 1 AND 12 AND o_orderkey % 15 <> 2 AS valid_day
        FROM orders""",
    "q_config_map": """
        SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority, CAST(o_custkey AS VARCHAR) AS cust,
               '' AS empty, CAST(NULL AS VARCHAR) AS absent,
               'cust=' || o_custkey || '::empty=::priority=' || o_orderpriority || '::status=' || o_orderstatus AS text
        FROM orders""",
    "q_markup_escape": f"""
        SELECT doc_id, escaped, {_UNESCAPED} AS unescaped FROM (SELECT doc_id, {_ESCAPED} AS escaped FROM documents)""",
    "q_store_names": """
        SELECT p_partkey, '/PM/X/CELL/' || p_type || '/E_' || p_size AS location, 'E' AS base, true AS is_split,
               p_type || '.' || p_size || '.9' AS version, split_part(p_name, ' ', -1) AS last_word,
               CASE WHEN p_size < 20 THEN 'BIGINT []' WHEN p_size < 30 THEN 'VARCHAR' ELSE 'REAL' END AS hot_type
        FROM part""",
    "q_hash_slices": f"""
        SELECT c_custkey, CAST(CASE WHEN h > 2147483647 THEN h - 4294967296 ELSE h END AS INTEGER) AS key_hash,
               CAST(((CASE WHEN h > 2147483647 THEN h - 4294967296 ELSE h END) + 2147483648) * 200 // 4294967296 AS INTEGER) AS slice
        FROM (SELECT c_custkey, {_HASH} AS h FROM customer)""",
    "q_backlog_reconcile": f"""
        WITH b AS ({BACKLOG}), fresh AS (SELECT path FROM ({LISTING}) EXCEPT SELECT path FROM b WHERE status IS NOT NULL),
        waiting AS (SELECT DISTINCT path FROM b WHERE status IS NULL)
        SELECT path, 'new' AS outcome FROM (SELECT path FROM fresh EXCEPT SELECT path FROM waiting)
        UNION ALL SELECT path, 'failed' FROM (SELECT path FROM waiting EXCEPT SELECT path FROM fresh)""",
    "q_backlog_register": f"""
        WITH b AS (SELECT * FROM ({ORDER_BACKLOG}) WHERE o_orderpriority <> '5-LOW'),
        fresh AS (SELECT path FROM ({LISTING}) EXCEPT SELECT path FROM b WHERE status IS NOT NULL),
        lost AS (SELECT path FROM b WHERE status IS NULL EXCEPT SELECT path FROM fresh)
        SELECT path, CASE WHEN path IN (SELECT path FROM lost) THEN 'Failed' ELSE status END AS status,
               strftime(received, '%Y%m%d') AS received,
               CASE WHEN path IN (SELECT path FROM lost) THEN '20240201' END AS processed
        FROM b
        UNION ALL SELECT path, NULL, '20240201', NULL
        FROM (SELECT path FROM fresh EXCEPT SELECT path FROM b WHERE status IS NULL)""",
    "q_backlog_close": f"""
        WITH r AS (SELECT DISTINCT {LINE_PATH} AS path FROM lineitem WHERE l_returnflag = 'R')
        SELECT b.path, CASE WHEN status IS NOT NULL THEN status WHEN r.path IS NULL THEN 'Dropped' ELSE 'Parsed' END AS status,
               strftime(received, '%Y%m%d') AS received, CASE WHEN status IS NULL THEN '20240201' END AS processed
        FROM ({ORDER_BACKLOG}) b LEFT JOIN r ON b.path = r.path""",
    "q_backlog_queries": f"""
        SELECT DISTINCT path, CASE WHEN status IS NULL THEN 'waiting' ELSE 'processed' END AS state FROM ({BACKLOG})""",
    "q_backlog_archive": f"""
        SELECT path, CASE WHEN received < DATE '{ORDER_DAY}' - INTERVAL 3 DAY THEN strftime(received, '%Y%m%d') END AS received_day
        FROM ({ORDER_BACKLOG})""",
    "q_backlog_old": f"SELECT path, status FROM ({ORDER_BACKLOG}) WHERE received < DATE '{ORDER_DAY}' - INTERVAL 3 DAY",
    "q_age_out_archived": f"SELECT * FROM ({HOT}) WHERE date_id = ({AGED})",
    "q_age_out_remaining": f"SELECT * FROM ({HOT}) WHERE date_id IS DISTINCT FROM ({AGED})",
    "q_archive_day": f"""
        SELECT CASE WHEN date_id BETWEEN strftime(DATE '{EVENT_DAY}' - INTERVAL 5 DAY, '%Y%m%d')
                              AND strftime(DATE '{EVENT_DAY}' - INTERVAL 4 DAY, '%Y%m%d') THEN 'cold' ELSE 'hot' END AS store,
               date_id, count(*) AS rows, CAST(sum(counter_value) AS BIGINT) AS total
        FROM ({HOT}) GROUP BY date_id""",
    "q_retention_purge": f"""
        SELECT event_id, CASE WHEN ts >= DATE '{EVENT_DAY}' - INTERVAL 7 DAY THEN 'kept' ELSE 'purged' END AS state FROM events""",
    "q_partition_calendar": """
        SELECT date_id, lpad(CAST(h AS VARCHAR), 2, '0') AS hour_id, lpad(CAST(m * 15 AS VARCHAR), 2, '0') AS rop_id,
               '/pm/cell/date_id=' || date_id || '/hour_id=' || lpad(CAST(h AS VARCHAR), 2, '0')
                 || '/rop_id=' || lpad(CAST(m * 15 AS VARCHAR), 2, '0') AS location
        FROM (SELECT DISTINCT strftime(ts + INTERVAL 1 DAY, '%Y%m%d') AS date_id FROM events), range(24) AS a(h), range(4) AS b(m)""",
    "q_expired_partitions": f"""
        SELECT DISTINCT '/pm/cell/date_id=' || strftime(ts, '%Y%m%d') AS location, strftime(ts, '%Y%m%d') AS date_id
        FROM events WHERE CAST(ts AS DATE) < DATE '{EVENT_DAY}' - INTERVAL 7 DAY""",
    "q_table_partitions": f"""
        WITH days AS (SELECT date_id, counter_value FROM ({HOT})
                      UNION ALL SELECT '20990101', counter_value FROM ({HOT}) WHERE date_id = '20240120'
                      UNION ALL SELECT '20240119', counter_value FROM ({HOT}) WHERE date_id = '20240120')
        SELECT 'date_id=' || date_id AS location, CASE WHEN date_id < '20240113' THEN 'unlisted' ELSE 'listed' END AS state,
               CASE WHEN date_id >= '20240113' THEN count(*) END AS rows,
               CASE WHEN date_id >= '20240113' THEN CAST(sum(counter_value) AS BIGINT) END AS total
        FROM days GROUP BY date_id
        UNION ALL SELECT 'date_id=20991231', 'empty', NULL, NULL""",
    "q_merge_versions": """
        SELECT 'v1' AS version, o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS a,
               CAST(o_custkey AS DOUBLE) AS b, CAST(NULL AS VARCHAR) AS c FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'v2', o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), o_totalprice, NULL
        FROM orders WHERE o_orderstatus = 'O'
        UNION ALL SELECT 'v3', o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), NULL, o_orderpriority
        FROM orders WHERE o_orderstatus = 'P'""",
    "q_array_posexplode": """
        SELECT 'v1' AS version, vec_id, CAST(i AS INTEGER) AS embedding_index, embedding[i + 1] AS embedding, label
        FROM embeddings, range(64) AS r(i) WHERE label < 4
        UNION ALL SELECT 'v2', vec_id, NULL, NULL, label FROM embeddings WHERE label >= 4""",
    "q_widened_columns": f"""
        SELECT entity, "column",
               CASE max(CASE type WHEN 'INT' THEN 1 WHEN 'BIGINT' THEN 2 WHEN 'DOUBLE' THEN 3 WHEN 'VARCHAR' THEN 4 ELSE 0 END)
                 WHEN 1 THEN 'INT' WHEN 2 THEN 'BIGINT' WHEN 3 THEN 'DOUBLE' WHEN 4 THEN 'VARCHAR' ELSE 'MISSING' END AS type
        FROM ({VERSION_COLUMNS}) GROUP BY entity, "column" """,
    "q_widened_types": f"""
        WITH typed AS (
          SELECT p_brand AS entity, 'c' || (p_partkey % 97) AS "column",
                 split_part(({CATALOG_TYPES})[(p_partkey * 7 + p_size) % {len(CATALOG_TYPES)} + 1], ':', 1) AS t
          FROM part),
        inner_types AS (
          SELECT entity, "column", t LIKE 'ARRAY<%' AS is_array,
                 CASE WHEN t LIKE 'ARRAY<%' THEN t[7:-2] ELSE t END AS e FROM typed WHERE t <> 'MISSING'),
        plain AS (
          SELECT entity, "column", is_array,
                 CASE WHEN split_part(e, '(', 1) IN ('VARCHAR', 'CHAR', 'STRING') THEN 'VARCHAR' ELSE e END AS e FROM inner_types),
        grouped AS (
          SELECT entity, "column", bool_and(is_array) AS arrays, bool_or(is_array) AS any_array,
                 count(DISTINCT e) AS kinds, min(e) AS one, min(list_position({WIDENING_ORDER}, e)) IS NULL
                 OR count(*) > count(list_position({WIDENING_ORDER}, e)) AS odd,
                 max(list_position({WIDENING_ORDER}, e)) AS place, bool_or(e IN ('INT', 'BIGINT')) AS digits
          FROM plain GROUP BY entity, "column"),
        widest AS (
          SELECT *, CASE WHEN any_array AND NOT arrays THEN 'VARCHAR' WHEN kinds = 1 THEN one WHEN odd THEN 'VARCHAR'
                         WHEN ({WIDENING_ORDER})[place] = 'FLOAT' AND digits THEN 'DOUBLE' ELSE ({WIDENING_ORDER})[place] END AS w
          FROM grouped)
        SELECT DISTINCT t.entity, t."column",
               CASE WHEN w IS NULL THEN 'MISSING' WHEN arrays THEN 'ARRAY<' || w || '>' ELSE w END AS type
        FROM typed t LEFT JOIN widest g ON g.entity = t.entity AND g."column" = t."column" """,
    "q_usable_versions": f"""
        SELECT entity, version, count(*) FILTER (WHERE type = 'MISSING') AS absent, count(*) AS columns
        FROM ({VERSION_COLUMNS}) GROUP BY entity, version HAVING count(*) FILTER (WHERE type = 'MISSING') < count(*)""",
    "q_column_versions": f"""
        SELECT entity, "column", type, string_agg(DISTINCT version, '::' ORDER BY version) AS versions
        FROM ({VERSION_COLUMNS}) WHERE type <> 'MISSING' GROUP BY entity, "column", type""",
    "q_stitch_splits": STITCHED,
    "q_stitch_splits_unique": STITCHED,
    "q_natural_full": f"""
        SELECT * FROM (SELECT * FROM ({_PART}) WHERE p_size <= 30) NATURAL FULL JOIN (SELECT * FROM ({_PART}) WHERE p_size > 20)""",
    "q_kpi_ratio_daily": f"""
        SELECT date_id, node,
               CAST(sum(v) FILTER (WHERE event_type = 'click') AS DOUBLE)
                 / nullif(CAST(sum(v) FILTER (WHERE event_type = 'view') AS DOUBLE), 0) AS click_rate,
               CAST(sum(v) FILTER (WHERE event_type = 'error') AS DOUBLE)
                 / nullif(CAST(sum(v) FILTER (WHERE event_type = 'view') AS DOUBLE), 0) AS error_share,
               CAST(sum(v) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS purchases
        FROM ({LONG}) GROUP BY date_id, node""",
    "q_kpi_ratio_hourly": f"""
        SELECT date_id, strftime(date_trunc('hour', start), '%Y%m%d%H%M') AS ropendtime,
               CAST(sum(v) FILTER (WHERE event_type = 'error') AS DOUBLE)
                 / nullif(CAST(sum(v) FILTER (WHERE event_type = 'click') AS DOUBLE), 0) AS error_rate
        FROM ({LONG}) GROUP BY date_id, date_trunc('hour', start)""",
    "q_kpi_documents": f"""
        WITH sums AS (
          SELECT date_id, node, {', '.join(f"CAST(sum(v) FILTER (WHERE event_type = '{c}') AS DOUBLE) AS {c}" for c in COUNTERS)}
          FROM ({LONG}) GROUP BY date_id, node),
        by_node AS (SELECT node, {', '.join(f"sum({c}) AS {c}" for c in COUNTERS)} FROM sums GROUP BY node),
        days AS (
          SELECT date_id || '/' || node AS key,
                 unnest([{{'kpi': 'click_share', 'value': click / nullif(click + "view", 0)}},
                         {{'kpi': 'margin', 'value': 100 * (purchase - error) / nullif("view", 0)}},
                         {{'kpi': 'error_rate', 'value': error / nullif("view", 0)}}]) AS k
          FROM sums),
        nodes AS (
          SELECT node AS key, unnest([{{'kpi': 'net', 'value': -error + 2.5::DOUBLE * signup}},
                                      {{'kpi': 'no_divisor', 'value': "view" / nullif("view" - "view", 0)}}]) AS k
          FROM by_node)
        SELECT key, k.kpi AS kpi, k.value AS value FROM days UNION ALL SELECT key, k.kpi, k.value FROM nodes""",
    "q_catalog_columns": f"SELECT * EXCLUDE (techpack_version_id) FROM ({ENTITY_COLUMNS})",
    "q_catalog_partition_columns": f"""
        SELECT DISTINCT reportable_entity_name, entity_column_name, entity_column_order
        FROM ({ENTITY_COLUMNS}) WHERE entity_column_order = 1""",
    "q_catalog_retention": f"""
        SELECT reportable_entity_name, 'E' || s_suppkey || '_R' || n_nationkey AS table_name,
               '/PM/X/' || n_regionkey || '/R' || n_nationkey || '/E' || s_suppkey AS location,
               CAST((r_regionkey + 1) * 7 AS INTEGER) AS retention_period,
               CAST(r_regionkey + 3 AS INTEGER) AS hot_store_retention_period
        FROM ({ENTITIES})""",
    "q_catalog_tables_by_retention": f"""
        SELECT DISTINCT CAST(r_regionkey + 3 AS INTEGER) AS hot_store_retention_period, reportable_entity_name AS "table"
        FROM ({ENTITIES})""",
    "q_catalog_persistence_columns": f"""
        SELECT DISTINCT reportable_entity_name, entity_column_name, entity_data_type
        FROM ({ENTITY_COLUMNS}) WHERE techpack_version_id LIKE 'NATION_1%'""",
    "q_catalog_versions_in": f"""
        SELECT techpack_version_id, reportable_entity_name FROM ({ENTITIES})
        WHERE techpack_version_id IN (SELECT n_name FROM nation WHERE n_regionkey = 2)""",
    "q_catalog_column_groups": f"""
        SELECT reportable_entity_name, entity_column_type,
               string_agg(entity_column_name || ':' || source_entity_column_name, ',' ORDER BY entity_column_order) AS columns
        FROM ({ENTITY_COLUMNS}) GROUP BY reportable_entity_name, entity_column_type""",
    "q_catalog_split_entities": """
        SELECT 'E' || s_suppkey AS entity, CAST(1 AS BIGINT) AS splits FROM supplier
        JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal < 0""",
    "q_catalog_upsert": """
        WITH changes AS (SELECT o_custkey AS c_custkey, max(o_orderstatus) AS state FROM orders
                         WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)
        SELECT c_custkey, c_mktsegment AS state FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM changes)
        UNION ALL SELECT c_custkey, state FROM changes""",
    "q_route_columns": f"""
        WITH c AS ({ROUTED_COLUMNS})
        SELECT * FROM c
        UNION ALL
        SELECT target_package_name, "table", k.name, CAST(k.ord AS INTEGER), NULL, NULL, k.kind, k.counter, 'key'
        FROM (SELECT DISTINCT target_package_name, "table" FROM c), (VALUES {_KEYS}) AS k(name, ord, kind, counter)""",
    "q_route_by_join": f"""SELECT mo_name, name, target_package_name, tab AS "table" FROM ({ROUTED})""",
    "q_model_changes": f"""
        SELECT coalesce(o.path, n.path) AS path, coalesce(o.prop, n.prop) AS prop, o.value AS old_value, n.value AS new_value,
               CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed'
                    WHEN o.value IS DISTINCT FROM n.value THEN 'changed' ELSE 'unchanged' END AS change_type
        FROM ({OLD_MODEL}) o FULL JOIN ({NEW_MODEL}) n ON o.path = n.path AND o.prop = n.prop""",
    "q_instance_measurements": """
        SELECT p_brand AS mo_name, p_name || '.' || p_partkey AS name, p_type AS data_type,
               CAST(p_size AS VARCHAR) AS counter_type, p_brand <> 'Brand#3' AS declared
        FROM part""",
    "q_reference_members": """
        WITH m AS (
          SELECT DISTINCT 'enum' AS member_type, l_linestatus AS ref, l_returnflag AS member, CAST(NULL AS VARCHAR) AS nested_ref FROM lineitem
          UNION ALL SELECT DISTINCT 'struct', CAST(p_size AS VARCHAR), p_type, CASE WHEN p_type = 'PROMO' THEN 'F' END FROM part),
        a AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'struct' ELSE 'enum' END AS member_type,
                     CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus WHEN o_orderpriority = '5-LOW' THEN '-'
                          ELSE substr(o_orderpriority, 1, 1) END AS ref FROM orders)
        SELECT o_orderkey, a.member_type, a.ref, member, nested_ref
        FROM a LEFT JOIN m ON a.member_type = m.member_type AND a.ref = m.ref""",
    "q_model_catalog": """
        WITH e AS (SELECT DISTINCT s_suppkey, s_name AS v, 'E' || l_returnflag AS e FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
        c AS (SELECT DISTINCT s_name AS v, s_name || ':E' || l_returnflag AS e, l_linenumber AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
        r(t, x) AS (
          SELECT 'techpack_versions', s_name || '|T' || s_nationkey || '|||||||||A,B' || s_suppkey FROM supplier
          UNION ALL SELECT 'supported_node_versions', s_name || '|L' || s_suppkey || '|' || s_suppkey || '.0|' FROM supplier
          UNION ALL SELECT 'node_mo_structure', s_name || '|N' || s_nationkey || '|C|0|' || CASE WHEN s_suppkey % 5 = 0 THEN '~' ELSE CAST(s_suppkey AS VARCHAR) END FROM supplier
          UNION ALL SELECT 'mo_table_mapping', v || '|Mo|' || e FROM e WHERE e = 'EA'
          UNION ALL SELECT 'retention_plan', 'SHORT' || s_suppkey || '|' || s_suppkey || '|~' FROM supplier
          UNION ALL SELECT 'reportable_entity', v || ':' || e || '|' || v || '|' || e || '|RAW|||' FROM e
          UNION ALL SELECT 'reportable_entity_columns', v || '|' || e || '|' || e || ':c' || n || '|c' || n || '|' || n || '||ARRAY<BIGINT>:4||' || (n % 2) || '|its ' || n FROM c
          UNION ALL SELECT 'reportable_entity_column_source', e || ':c' || n || '|' || v || '|' || e || '|Cell|' FROM c
          UNION ALL SELECT 'flow_configuration', s_name || '|F|Collect||in=/d' || s_suppkey || '::out=/o||' FROM supplier
          UNION ALL SELECT 'flow_scheduling', s_name || '|F|Collect|||15|~|1' FROM supplier WHERE s_suppkey % 2 = 0
          UNION ALL SELECT 'designrules', s_name || '|PM|All|T' || s_nationkey || '|0|ALL|||' FROM supplier
          UNION ALL SELECT 'designrules', s_name || '|PM|V|All|0|equals|name|m' || s_suppkey || '|_V' FROM supplier)
        SELECT t AS "table", x AS row FROM r""",
    "q_model_closure": CLOSURE.replace("{root}", "struct_name").replace("{roots}", "structs") + "SELECT * FROM closure",
    "q_nested_references": CLOSURE.replace("{root}", "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)").replace(
        "{roots}", "lineitem WHERE l_returnflag <> 'N'"
    ) + """
        , lines AS (SELECT CASE WHEN l_returnflag <> 'N' THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS ref FROM lineitem)
        SELECT l.ref, kind, count(*) AS rows, count(DISTINCT path) AS paths
        FROM lines l LEFT JOIN closure c ON c.root = l.ref GROUP BY l.ref, kind""",
    "q_entity_tree_paths": """
        WITH RECURSIVE lines AS (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag) - 1 AS n
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
        nodes AS (
          SELECT c_custkey AS doc, 'c' || c_custkey AS id, NULL AS parent, NULL AS section, c_name AS name, 0 AS place FROM customer
          UNION ALL
          SELECT o_custkey, 'o' || o_orderkey, 'c' || o_custkey, 'Orders', 'o' || o_orderkey,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 FROM orders
          UNION ALL
          SELECT o_custkey, 'l' || l_orderkey || '-' || n, 'o' || l_orderkey, 'Lines', CAST(l_partkey AS VARCHAR), n FROM lines
        ),
        properties AS (
          SELECT 'c' || c_custkey AS id, unnest([{'at': 0, 'prop': 'SEGMENT', 'value': c_mktsegment || ' & <co>'},
                                                 {'at': 1, 'prop': 'NOTE', 'value': ''}]) AS p FROM customer
          UNION ALL
          SELECT 'o' || o_orderkey, unnest([{'at': 0, 'prop': 'STATUS', 'value': o_orderstatus},
                                            {'at': 1, 'prop': 'PRIORITY', 'value': '<' || o_orderpriority || '>'}]) FROM orders
          UNION ALL
          SELECT 'l' || l_orderkey || '-' || n, unnest([{'at': 0, 'prop': 'line', 'value': CAST(l_linenumber AS VARCHAR)},
                                                        {'at': 1, 'prop': 'flag', 'value': l_returnflag}]) FROM lines),
        tree AS (
          SELECT doc, id, name AS model, name AS path, CAST(NULL AS VARCHAR) AS parent_path, CAST(NULL AS VARCHAR) AS section,
                 name, CAST(place AS INTEGER) AS entity_pos
          FROM nodes WHERE parent IS NULL
          UNION ALL
          SELECT n.doc, n.id, t.model, t.path || '/' || n.section || ':' || n.name, t.path, n.section, n.name, CAST(n.place AS INTEGER)
          FROM nodes n JOIN tree t ON n.parent = t.id)
        SELECT doc, model, path, parent_path, section, name, entity_pos, p.at AS prop_pos, p.prop AS prop, p.value AS value
        FROM tree JOIN properties USING (id)""",
    "q_hierarchy_edges": """
        SELECT 'PM_X_R1' AS techpack_version_id, n_name AS parent_mo_name, c_name AS child_mo_name,
               CAST(0 AS INTEGER) AS cardinality_min, n_regionkey AS cardinality_max
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0""",
    "q_log_stitch": f"""
        SELECT source_file, min(datetime) FILTER (WHERE is_header) AS datetime, '[t' || source_file || ']' AS thread,
               'INFO' AS log_level, 'Session' AS classname, string_agg(part, chr(10) ORDER BY event_id) AS logmessage
        FROM ({LOG_NUMBERED}) WHERE record > 0 GROUP BY source_file, record""",
    "q_log_file_lines": """
        SELECT day, row_number() OVER (PARTITION BY day ORDER BY event_id) AS number,
               CASE WHEN event_id % 10 = 0 THEN '' ELSE concat_ws(' ', event_type, event_id, props) END AS line
        FROM (SELECT *, strftime(ts, '%Y%m') || (day(ts) // 10) AS day FROM events)""",
    "q_log_orphans": f"SELECT source_file, line FROM ({LOG_NUMBERED}) WHERE record = 0",
    "q_replication_state": REPLICATION,
}
