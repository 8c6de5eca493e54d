"""Declared schemas. Streams need one, and a declared schema spares a pass over the files."""

from pyspark.sql import types as T

PAGES = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]
)
#: Pages with the time at which they were fetched.
FETCHED = T.StructType([*PAGES, T.StructField("fetched_at", T.TimestampType())])
MESSAGES = T.StructType(
    [
        T.StructField("thread_id", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("author", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
ACTIVITY = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
    ]
)
#: Activity as it lies in files: times without a zone.
ACTIVITY_FILES = T.StructType([T.StructField(f.name, T.TimestampNTZType()) if f.name == "ts" else f for f in ACTIVITY])
