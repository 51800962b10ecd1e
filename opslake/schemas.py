"""Declared schemas. Nothing in the library infers a schema from data."""

from __future__ import annotations

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EMBEDDINGS = "vec_id bigint, embedding array<float>, label int"
PAGES = "page_id bigint, url string, html string"
BENCHMARK = "item_id bigint, text string"
LABELS = "doc_id bigint, quality int, toxic int"
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"
PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
LINEITEM = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int"

TABLES = {
    "events": EVENTS, "documents": DOCUMENTS, "embeddings": EMBEDDINGS, "pages": PAGES,
    "benchmark": BENCHMARK, "labels": LABELS, "conversations": CONVERSATIONS, "part": PART,
    "lineitem": LINEITEM,
}

# One telemetry message as it travels in JSON; the time is an ISO-8601 string.
TELEMETRY_MESSAGE = (
    "event_id bigint, device_id string, device_type string, location string, timestamp string, "
    "temperature double, vibration double, pressure double, humidity double, power_usage double, "
    "rpm double, error_code string"
)
TELEMETRY = TELEMETRY_MESSAGE.replace("timestamp string", "event_time timestamp")
TELEMETRY_COLUMNS = [field.split()[0] for field in TELEMETRY.split(", ")]

DEVICES = (
    "device_id string, device_type string, manufacturer string, model string, install_date date, "
    "location string, zone string, maintenance_interval_days int, last_maintenance_date date, "
    "status string, updated_at timestamp"
)
MANUALS = "id string, title string, content string, text string, device_id string, severity string"
LOG_LINE = "timestamp string, service string, level string, message string"
API_RESPONSE = (
    "data array<struct<id:bigint,title:string,typeName:string,status:string,acceptDate:string,number:string,"
    "rowNum:bigint,citation:string,effectDate:string,registerCode:string,registerDate:string,htmlPath:string,"
    "fields:string,relation:string,classCodes:string>>"
)
TIMING_PAYLOAD = "stage string, started_at_ms double, completed_at_ms double, duration_ms double"
CORPUS = "url string, type string, name string, text string"
