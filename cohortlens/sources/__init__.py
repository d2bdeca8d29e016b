"""Scans, sinks, raw schemas and the fixture views over the driver tables."""

from .fixtures import (FIXTURE_AS_OF, FIXTURE_CONFIG, events_view, licenses_view, raw_inputs,
                       transactions_view)
from .io import in_window, load_text, publish_text, read_source, store_by_month, write_table
from .publish import Counters, current, expire, publish, publish_table, read_published
from .schemas import EVENTS_RAW, LICENSES_RAW, RAW_SCHEMAS, TRANSACTIONS_RAW

__all__ = [
    "Counters", "EVENTS_RAW", "FIXTURE_AS_OF", "FIXTURE_CONFIG", "LICENSES_RAW", "RAW_SCHEMAS",
    "TRANSACTIONS_RAW", "current", "events_view", "expire", "in_window", "licenses_view", "load_text", "publish",
    "publish_table", "publish_text", "raw_inputs", "read_published", "read_source", "store_by_month", "transactions_view",
    "write_table",
]
