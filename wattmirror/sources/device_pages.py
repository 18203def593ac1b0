"""Landed API pages of the health device: one row per record, typed columns lifted from JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmirror.functions.records import project

PAGE_SCHEMA = "data array<string>, next_token string"

# Per endpoint the key of its table and the lifted columns as
# (column, JSON path, type). Everything else stays in `data`.
_DAY_SCORED = (("id",), [("id", "$.id", "string"), ("day", "$.day", "date"), ("score", "$.score", "int")])
ENDPOINTS: dict[str, tuple[tuple[str, ...], list[tuple[str, str, str]]]] = {
    "daily_activity": _DAY_SCORED,
    "daily_sleep": _DAY_SCORED,
    "daily_readiness": _DAY_SCORED,
    "sleep": (("id",), [
        ("id", "$.id", "string"), ("day", "$.day", "date"), ("bedtime_start", "$.bedtime_start", "timestamp"),
        ("bedtime_end", "$.bedtime_end", "timestamp"), ("total_sleep_duration", "$.total_sleep_duration", "int")]),
    "daily_spo2": (("id",), [
        ("id", "$.id", "string"), ("day", "$.day", "date"),
        ("spo2_percentage", "$.spo2_percentage.average", "double")]),
    "daily_stress": (("day",), [("day", "$.day", "date")]),
    "heartrate": (("timestamp", "source"), [
        ("timestamp", "$.timestamp", "timestamp"), ("source", "$.source", "string"), ("bpm", "$.bpm", "int")]),
    "workout": (("id",), [
        ("id", "$.id", "string"), ("day", "$.day", "date"), ("activity", "$.activity", "string"),
        ("calories", "$.calories", "double"), ("start_datetime", "$.start_datetime", "timestamp"),
        ("end_datetime", "$.end_datetime", "timestamp")]),
    "session": (("id",), [
        ("id", "$.id", "string"), ("day", "$.day", "date"), ("session_type", "$.type", "string"),
        ("start_datetime", "$.start_datetime", "timestamp"), ("end_datetime", "$.end_datetime", "timestamp")]),
    "enhanced_tag": (("id",), [
        ("id", "$.id", "string"), ("start_day", "$.start_day", "date"), ("end_day", "$.end_day", "date")]),
}
WITHOUT_DATA = {"heartrate"}


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages as files, one JSON envelope per line; the schema is declared, never inferred."""
    return spark.read.schema(PAGE_SCHEMA).json(path)


def unnest_pages(raw: DataFrame) -> DataFrame:
    """One row per record of the envelopes, as JSON text; pages without data vanish."""
    return raw.select(F.explode("data").alias("data"))


def lift_fields(records: DataFrame, endpoint: str) -> DataFrame:
    """The typed columns of an endpoint next to the raw record. A wrong type is an error."""
    _, lifted = ENDPOINTS[endpoint]
    return project(records, lifted, keep=[] if endpoint in WITHOUT_DATA else ["data"])


def table_key(endpoint: str) -> list[str]:
    return list(ENDPOINTS[endpoint][0])
