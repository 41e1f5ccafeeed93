"""Declared schemas: counter files, the long counter table, the catalog.

Files are always read with a schema. That skips an inference pass over the
input and fixes the type of every field. Schemas are DDL text, which readers and
from_xml() take as it is.
"""

from __future__ import annotations

# Record of an "mdc" counter file (row tag mdc). Attributes carry the prefix _.
# Only fields that an operator reads are declared: a struct field of an XML
# record cannot be pruned later. _corrupt_record keeps unreadable files visible.
MDC_RECORD = """
    mfh STRUCT<sn: STRING>,
    md ARRAY<STRUCT<
        mi: ARRAY<STRUCT<
            mts: STRING,
            gp: STRING,
            mt: ARRAY<STRING>,
            mv: ARRAY<STRUCT<moid: STRING, r: ARRAY<STRUCT<_p: BIGINT, _VALUE: STRING>>>>>>>>,
    _corrupt_record STRING
"""

# One info block of such a file, the part scan_mdc_parts() reads.
MDC_INFO = """
    mts STRING,
    gp STRING,
    mt ARRAY<STRING>,
    mv ARRAY<STRUCT<moid: STRING, r: ARRAY<STRUCT<_p: BIGINT, _VALUE: STRING>>>>,
    _corrupt_record STRING
"""

# All fields of the same file, for callers that want header and footer too.
MDC_RECORD_FULL = """
    mfh STRUCT<ffv: STRING, sn: STRING, st: STRING, vn: STRING, cbt: STRING>,
    md ARRAY<STRUCT<
        neid: STRUCT<neun: STRING, nedn: STRING, nesw: STRING>,
        mi: ARRAY<STRUCT<
            mts: STRING,
            gp: STRING,
            mt: ARRAY<STRING>,
            mv: ARRAY<STRUCT<moid: STRING, r: ARRAY<STRUCT<_p: BIGINT, _VALUE: STRING>>>>>>>>,
    mff STRUCT<ts: STRING>,
    _corrupt_record STRING
"""

# Record of a "measData" counter file (row tag measData).
MEAS_DATA_RECORD = """
    managedElement STRUCT<
        _localDn: STRING,
        measInfo: ARRAY<STRUCT<
            _measInfoId: STRING,
            granPeriod: STRUCT<_endTime: STRING, _duration: STRING>,
            measType: ARRAY<STRUCT<_p: BIGINT, _VALUE: STRING>>,
            measValue: ARRAY<STRUCT<
                _measObjLdn: STRING,
                r: ARRAY<STRUCT<_p: BIGINT, _VALUE: BIGINT>>>>>>>,
    _corrupt_record STRING
"""

# Key columns of every entity table, in column order.
KEY_COLUMNS = [
    "date_id",
    "granularity",
    "moid",
    "nedn",
    "node",
    "ropendtime",
    "utc_timestamp",
    "local_timestamp",
]

# Number of bin columns of a vector entity, and columns per physical table.
VECTOR_BINS = 256
TABLE_COLUMN_LIMIT = 5000

# Where a row came from: the deterministic order used to break ties between
# rows that repeat one key.
ORIGIN_COLUMNS = ["source_file", "source_pos"]

KPI_DOCUMENT = """
    source STRING,
    kpi_definitions ARRAY<STRUCT<
        name: STRING, alias: STRING, expression: STRING, object_type: STRING,
        aggregation_type: STRING, aggregation_period: BIGINT,
        aggregation_elements: ARRAY<STRING>>>
"""

# Catalog tables. A "pack" is a versioned bundle of entity definitions.
CATALOG = {
    "techpack_versions": (
        "techpack_version_id STRING, techpack_name STRING, techpack_release STRING, techpack_type STRING,"
        "vendor STRING, technology STRING, product_number STRING, feature_name STRING, description STRING,"
        "license STRING, dependency ARRAY<STRING>"
    ),
    "supported_node_versions": (
        "techpack_version_id STRING, node_version STRING, model_version STRING, description STRING"
    ),
    "node_mo_structure": (
        "techpack_version_id STRING, parent_mo_name STRING, child_mo_name STRING,"
        "cardinality_min INT, cardinality_max INT"
    ),
    "mo_table_mapping": ("techpack_version_id STRING, mo_name STRING, reportable_entity_name STRING"),
    "retention_plan": ("plan_name STRING, retention_period INT, hot_store_retention_period INT"),
    "reportable_entity": (
        "reportable_entity_id STRING, techpack_version_id STRING, reportable_entity_name STRING,"
        "entity_type STRING, partition_plan STRING, retention_plan STRING, description STRING"
    ),
    "reportable_entity_columns": (
        "techpack_version_id STRING, reportable_entity_id STRING, entity_column_id STRING,"
        "entity_column_name STRING, entity_column_order INT, entity_column_type STRING,"
        "entity_data_type STRING, entity_counter_type STRING, partition_by SMALLINT,"
        "entity_column_description STRING"
    ),
    "reportable_entity_column_source": (
        "entity_column_id STRING, techpack_version_id STRING, reportable_entity_id STRING,"
        "source_entity_name STRING, source_entity_column_name STRING"
    ),
    "reportable_entity_joins": (
        "entity_column_id STRING, techpack_version_id STRING, reportable_entity_id STRING,"
        "reportable_entity_name STRING, source_entity_name STRING, source_entity_column_name STRING,"
        "target_entity_name STRING, target_entity_column_name STRING"
    ),
    "flow_configuration": (
        "techpack_version_id STRING, flow_name STRING, action_name STRING, worker_name STRING,"
        "worker_config STRING, dependency_flow_name STRING, dependency_action_name STRING"
    ),
    "flow_scheduling": (
        "techpack_version_id STRING, flow_name STRING, action_name STRING, worker_name STRING,"
        "reoccuring STRING, rop_interval INT, rop_offset INT, enabled INT"
    ),
    "filebacklog": (
        "techpack_name STRING, flow_name STRING, worker_name STRING, filepath STRING, status STRING,"
        "received_date TIMESTAMP, processed_date TIMESTAMP"
    ),
    "designrules": (
        "techpack_version_id STRING, target_package_name STRING, rule_name STRING, parent_rule_name STRING,"
        "execution_order INT, match_type STRING, match_argument STRING, match_value STRING, target_name STRING"
    ),
}
