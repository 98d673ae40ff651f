"""DataFrame to DataFrame operators. None runs an action except delivery."""

from tidegauge.operators.deliver import (
    deliver,
    not_delivered,
    print_events,
    read_delivered,
    read_rejects,
    send_requests,
    write_rejects,
    write_table,
)
from tidegauge.operators.delivered import Delivered
from tidegauge.operators.events import (
    dedupe_events,
    merge_streams,
    observed,
    quarantine,
    reserved_fields,
    run_stats,
    split_rejects,
)
from tidegauge.operators.extract import (
    extract_json_fields,
    extract_log_events,
    extract_text_fields,
    filter_logs,
    json_equals,
    require_org,
)
from tidegauge.operators.ledger import Conflict, Ledger, OffsetStore
from tidegauge.operators.metrics import metric_events, metric_org, select_labels
from tidegauge.operators.numbering import number_rows
from tidegauge.operators.payload import (
    entries_of,
    payload_struct,
    prefix_values,
    request_batches,
    to_payload,
)
from tidegauge.operators.queries import metric_query_plan
from tidegauge.operators.ranges import (
    OffsetTable,
    commit_offsets,
    current_offsets,
    duplicate_streams,
    latest_ingested,
    offset_keys,
    offsets_from_delivered,
    plan_ranges,
    poll_times,
    resolve_offsets,
)
from tidegauge.operators.series import (
    aggregate_by,
    counter_rate,
    histogram_quantile,
    match_labels,
    rate_grid,
    rollup,
    select_series,
    series_ratio,
    shift_series,
    step_grid,
)

__all__ = [
    "Conflict", "Delivered", "Ledger", "OffsetStore", "OffsetTable", "aggregate_by", "commit_offsets", "counter_rate", "current_offsets",
    "dedupe_events", "deliver", "duplicate_streams", "entries_of", "extract_json_fields",
    "extract_log_events", "extract_text_fields", "filter_logs", "histogram_quantile",
    "json_equals", "latest_ingested", "match_labels", "merge_streams", "metric_events",
    "metric_org", "metric_query_plan", "number_rows", "observed", "offset_keys",
    "not_delivered", "offsets_from_delivered", "payload_struct", "plan_ranges", "poll_times", "prefix_values", "print_events", "quarantine",
    "read_delivered", "read_rejects",
    "rate_grid", "request_batches", "require_org", "reserved_fields", "resolve_offsets",
    "rollup", "run_stats", "select_labels", "select_series", "send_requests", "series_ratio",
    "shift_series", "split_rejects", "step_grid", "to_payload", "write_rejects",
    "write_table",
]
