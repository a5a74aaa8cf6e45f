"""Sources and sinks of records: schemas, text/CSV readers, Kafka line codec, and the
mapping of the shared test tables onto the behaviour records."""

from evtlens.sources import schemas
from evtlens.sources.text import (
    read_user_behavior, read_ad_clicks, read_logins, read_order_events, read_receipts,
    read_apache_log, parse_apache_log, format_apache_log, read_csv_records,
)
from evtlens.sources.kafka import decode_lines, encode_lines, read_kafka_lines, publish_lines_kafka
from evtlens.sources import tables

__all__ = [
    "schemas", "tables", "read_user_behavior", "read_ad_clicks", "read_logins",
    "read_order_events", "read_receipts", "read_apache_log", "parse_apache_log",
    "format_apache_log", "read_csv_records", "decode_lines", "encode_lines",
    "read_kafka_lines", "publish_lines_kafka",
]
