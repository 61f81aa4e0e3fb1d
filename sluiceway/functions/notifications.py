"""Object-created notifications: JSON bodies to rows of path, event time and receipt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of a notification and the name of the event that announces a file.
RECORDS = "Records array<struct<eventName: string, eventTime: string, s3: struct<bucket: struct<name: string>, object: struct<key: string>>>>"
CREATED = "ObjectCreated"
#: ISO 8601 in UTC, with up to nine digits of a second's fraction.
TIME_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?Z(?![\s\S])"
SCHEME = "s3://"

#: How a notification is judged; all but CREATED_FILE are acknowledged without further ado.
CREATED_FILE, DISCARDED, UNPARSEABLE = "created", "discarded", "unparseable"


def event_millis(text: Column) -> Column:
    """Epoch milliseconds of an event time in UTC, finer digits cut off; null where it isn't one."""
    return F.when(text.rlike(TIME_PATTERN), F.unix_millis(F.try_to_timestamp(text)))


def object_path(bucket: Column, key: Column) -> Column:
    """The object's path; keys are URL-encoded in notifications (+ is a space)."""
    return F.try_url_decode(F.concat(F.lit(SCHEME), bucket, F.lit("/"), key))


def records(body: Column) -> Column:
    """The records of a body, taken out of the envelope of a fan-out topic where there is one."""
    inner = F.coalesce(F.get_json_object(body, "$.Message"), body)
    return F.from_json(inner, RECORDS)["Records"]


def parse(messages: DataFrame, body_col: str = "body", first_record_only: bool = False) -> DataFrame:
    """messages with outcome, path and event_ms; a row per record, or per message without a usable one.

    A record whose event is another than a creation is `discarded`. A message that isn't
    JSON of this form, or a record without bucket, key or a valid time, is `unparseable`.
    first_record_only: the other records of a message are left out.
    """
    found = records(F.col(body_col))
    some = F.filter(found, lambda r: r.isNotNull())
    each = F.slice(some, 1, 1) if first_record_only else some
    rows = messages.withColumn("record", F.explode_outer(F.coalesce(each, F.array())))
    r = F.col("record")
    created = F.coalesce(F.contains(r["eventName"], F.lit(CREATED)), F.lit(False))
    path = F.when(created, object_path(r["s3"]["bucket"]["name"], r["s3"]["object"]["key"]))
    time = F.when(created, event_millis(r["eventTime"]))
    rows = rows.withColumns({"path": path, "event_ms": time})
    valid = F.col("path").isNotNull() & F.col("event_ms").isNotNull()
    outcome = F.when(r["eventName"].isNull(), UNPARSEABLE).when(~created, DISCARDED).when(valid, CREATED_FILE).otherwise(UNPARSEABLE)
    rows = rows.withColumn("outcome", outcome).drop("record")
    announced = F.col("outcome") == CREATED_FILE
    return rows.withColumns({"path": F.when(announced, F.col("path")), "event_ms": F.when(announced, F.col("event_ms"))})


def created_files(messages: DataFrame, body_col: str = "body", first_record_only: bool = False) -> DataFrame:
    """Only the parsed records that announce a file."""
    return parse(messages, body_col, first_record_only).filter(F.col("outcome") == CREATED_FILE).drop("outcome")


def discarded(messages: DataFrame, body_col: str = "body") -> DataFrame:
    """The rest: what is acknowledged and counted only."""
    return parse(messages, body_col).filter(F.col("outcome") != CREATED_FILE)


def notification_body(bucket: Column, key: Column, event_name: Column, event_time: Column) -> Column:
    """A body that parse() reads, for generators and tests."""
    record = F.struct(event_name.alias("eventName"), event_time.alias("eventTime"), F.struct(F.struct(bucket.alias("name")).alias("bucket"), F.struct(F.url_encode(key).alias("key")).alias("object")).alias("s3"))
    return F.to_json(F.struct(F.array(record).alias("Records")))
