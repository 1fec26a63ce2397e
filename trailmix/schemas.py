"""Schemas of the two record kinds, and the mapping of driver tables onto them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the reference's data model (must match for right results).
# Audit-trail line, field order: id, user, entity, operation, timestamp, duration, count.
# Browser-action line, field order: timestamp, name, action.
# Entity values: Customer, SalesRep.  Operations: Create, Read, Update, Delete.
# Actions: Login, Logout, View Video, View Link, View Review.
# Stream tags of the combined stream: Stream-1, Stream-2.  Alert sentinel: No Alerts.
# Published action when no duration applies: None.
AUDIT_FIELDS: list[tuple[str, T.DataType]] = [
    ("id", T.LongType()),
    ("user", T.StringType()),
    ("entity", T.StringType()),
    ("operation", T.StringType()),
    ("timestamp", T.LongType()),
    ("duration", T.IntegerType()),
    ("count", T.IntegerType()),
]

BROWSER_FIELDS: list[tuple[str, T.DataType]] = [
    ("timestamp", T.LongType()),
    ("name", T.StringType()),
    ("action", T.StringType()),
]

STREAM_TAGS = ("Stream-1", "Stream-2")
NO_ALERT = "No Alerts"
NO_ACTION = "None"


def struct_of(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


AUDIT_SCHEMA = struct_of(AUDIT_FIELDS)
BROWSER_SCHEMA = struct_of(BROWSER_FIELDS)

# The driver's ``events`` table stands in for both record kinds:
#   user / name          <- user_id
#   operation / action   <- event_type
#   timestamp            <- ts   (order key: ts, event_id)
#   duration             <- value
# Names of the reference's special actions map onto event types:
EVENT_DELETE = "error"      # "Delete"
EVENT_LOGIN = "signup"      # "Login"
EVENT_LOGOUT = "purchase"   # "Logout"
EVENT_CUSTOMER = "click"    # entity == "Customer"

EVENTS_KEY = "user_id"
EVENTS_TIME = "ts"
EVENTS_ORDER = ("ts", "event_id")


def audit_from_events(events: DataFrame) -> DataFrame:
    """Audit-trail records derived from the driver's events table."""
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("user"),
        F.when(F.col("event_type") == EVENT_CUSTOMER, F.lit("Customer"))
         .otherwise(F.lit("SalesRep")).alias("entity"),
        F.col("event_type").alias("operation"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.round(F.col("value")).cast("int").alias("duration"),
        F.length("props").alias("count"),
    )


def browser_from_events(events: DataFrame) -> DataFrame:
    """Browser-action records derived from the driver's events table."""
    return events.select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("user_id").cast("string").alias("name"),
        F.col("event_type").alias("action"),
    )
