"""Schemas of the records that flow between operators, as column name to Spark type."""


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


#: One landed provider response. ``query_index`` says which query of the input the
#: page answers, for inputs that run several queries over one time range.
RAW_PAGES = {
    "stream_key": "string",
    "provider": "string",
    "kind": "string",
    "query_index": "int",
    "start_ms": "bigint",
    "end_ms": "bigint",
    "page_no": "int",
    "body": "string",
}

#: A page that also names the input it was fetched for, which inputs of one stream key,
#: provider and kind need.
INPUT_PAGES = RAW_PAGES | {"input_key": "string"}

#: A time range to fetch, ``[start_ms, end_ms)``.
FETCH_RANGE = {"stream_key": "string", "start_ms": "bigint", "end_ms": "bigint"}

LOG_METADATA = "struct<log_stream_name:string,service:string,status:string,tags:array<string>>"

LOG_ENTRY = {
    "stream_key": "string",
    "log_id": "string",
    "content": "string",
    "is_json": "boolean",
    "metadata": LOG_METADATA,
    "event_ts": "timestamp",
}

METRIC_ENTRY = {
    "stream_key": "string",
    "metric_name": "string",
    "value": "double",
    "organization_id": "string",
    "organization_identifier": "string",
    "labels": "map<string,string>",
    "event_ts": "timestamp",
}

#: The values object of an event: keys in order, each value as JSON text.
ENTRIES = "array<struct<k:string,j:string>>"

EVENT = {
    "stream_key": "string",
    "idempotency_key": "string",
    "event_ts": "timestamp",
    "organization_id": "string",
    "entries": ENTRIES,
}

OFFSETS = {"stream_key": "string", "offset_ms": "bigint", "updated_at": "timestamp"}

#: One query an input runs, and the organisation its series belongs to.
QUERY_PLAN = {
    "stream_key": "string",
    "metric_name": "string",
    "query_index": "int",
    "query_id": "string",
    "organization_id": "string",
    "query_text": "string",
    "chunk_no": "int",
}

REJECT = "reject_reason"

#: The record a rejected row was made from; null for accepted rows.
CONTENT = "content"
