"""Spark-native analytics for network performance counters.

Every operator takes and returns DataFrames; the plan stays lazy until the
caller writes or counts. See README.md for the operator map.
"""

from countermill.operators.ageing import age_out, archive_oldest
from countermill.operators.entities import to_entity, to_entity_from_map, to_vector_entity
from countermill.operators.files import close_batch, reconcile_files, register_files
from countermill.operators.flatten import flatten_mdc, flatten_measdata, mdc_counter_maps
from countermill.operators.kpi import kpi_table, kpi_tables, read_kpis
from countermill.operators.log_records import stitch_log_records
from countermill.operators.model_diff import model_diff
from countermill.operators.models import catalog_from_model
from countermill.operators.partitions import expired_partitions, partition_calendar
from countermill.operators.profiles import counter_coverage, xml_path_profile
from countermill.operators.replication import replication_state
from countermill.operators.routing import route_columns
from countermill.operators.splits import natural_full_join, stitch_splits
from countermill.operators.versions import merge_versions
from countermill.sources.counter_files import scan_mdc, scan_measdata, stream_mdc, stream_measdata

__all__ = [
    "age_out",
    "archive_oldest",
    "catalog_from_model",
    "close_batch",
    "counter_coverage",
    "expired_partitions",
    "flatten_mdc",
    "flatten_measdata",
    "kpi_table",
    "kpi_tables",
    "mdc_counter_maps",
    "merge_versions",
    "model_diff",
    "natural_full_join",
    "partition_calendar",
    "read_kpis",
    "reconcile_files",
    "register_files",
    "replication_state",
    "route_columns",
    "scan_mdc",
    "scan_measdata",
    "stitch_log_records",
    "stitch_splits",
    "stream_mdc",
    "stream_measdata",
    "to_entity",
    "to_entity_from_map",
    "to_vector_entity",
    "xml_path_profile",
]
