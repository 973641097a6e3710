"""Warehouse-table jobs on Spark: scans, writes, snapshots, checks and SQL steps."""

from tablejobs.descriptor import TableDescriptor, describe_table
from tablejobs.functions.aggregates import UserAggregate, aggregate_with, apply_generator
from tablejobs.functions.sketches import merge_sketches, read_sketches, sketch_groups
from tablejobs.functions.user import apply_filter, apply_function
from tablejobs.operators.contract import check_contract, validate_table
from tablejobs.operators.copy import copy_to_file, copy_to_table
from tablejobs.operators.fields import align_to_table, partition_filter, project_fields
from tablejobs.operators.joins import asof_join, interval_join
from tablejobs.operators.rows import (
    distinct_values,
    filter_rows,
    group_count,
    insert_constant,
    limit_rows,
    map_columns,
    order_rows,
)
from tablejobs.plans.metrics import StepMetrics
from tablejobs.plans.steps import SqlStep, load_file, run_sql_steps
from tablejobs.sinks.changes import (
    adopt_files,
    apply_changes,
    insert_events,
    remove_uncommitted,
    write_base,
    write_delta,
)
from tablejobs.sinks.discard import discard
from tablejobs.sinks.tables import (
    create_table,
    drop_table,
    insert_into,
    register_partitions,
    remove_partitions,
    truncate_table,
    write_files,
    write_partitioned,
    write_table,
)
from tablejobs.sinks.text import write_text_table
from tablejobs.sources.inputs import query_inputs
from tablejobs.sources.sequence import scan_sequence_table, write_sequence_table
from tablejobs.sources.snapshot import Snapshot, snapshot_read
from tablejobs.sources.tables import scan_at_location, scan_partitioned, scan_table, table_location
from tablejobs.sources.text import accepted_rows, create_text_view, judged_lines, rejected_lines, scan_text_table

__all__ = [
    "Snapshot", "SqlStep", "StepMetrics", "TableDescriptor", "UserAggregate", "accepted_rows", "adopt_files", "aggregate_with", "align_to_table", "apply_changes",
    "apply_filter", "apply_function", "apply_generator", "asof_join", "check_contract", "copy_to_file", "copy_to_table",
    "create_table", "create_text_view", "describe_table", "discard", "distinct_values", "drop_table", "filter_rows",
    "group_count", "insert_constant", "insert_events", "insert_into", "interval_join", "judged_lines", "limit_rows", "load_file",
    "map_columns", "merge_sketches", "order_rows", "partition_filter", "project_fields", "query_inputs", "read_sketches",
    "register_partitions", "rejected_lines", "remove_partitions", "remove_uncommitted", "run_sql_steps", "scan_at_location",
    "scan_partitioned", "scan_sequence_table", "scan_table", "scan_text_table", "sketch_groups", "snapshot_read",
    "table_location", "truncate_table", "validate_table", "write_base", "write_delta", "write_files",
    "write_partitioned", "write_sequence_table", "write_table", "write_text_table",
]
