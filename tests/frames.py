"""Hand-written raw frames for trap tests."""

from __future__ import annotations

import datetime as dt

from cohortlens.sources.schemas import EVENTS_RAW, LICENSES_RAW, TRANSACTIONS_RAW


def _rows(schema, rows):
    names = schema.fieldNames()
    return [tuple(r.get(n) for n in names) for r in rows]


def licenses(spark, rows):
    return spark.createDataFrame(_rows(LICENSES_RAW, rows), LICENSES_RAW)


def events(spark, rows):
    return spark.createDataFrame(_rows(EVENTS_RAW, rows), EVENTS_RAW)


def transactions(spark, rows):
    return spark.createDataFrame(_rows(TRANSACTIONS_RAW, rows), TRANSACTIONS_RAW)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)
