"""Column names and schemas of the datasets and of the audit table."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from beaconmill.avsc import compile_avsc

# Field names and types of the sources, as their producers ship them.
AD_IMPRESSIONS = "ad_creative_id string, user_id string, timestamp string, website string"
BID_REQUESTS = (
    "user_info struct<user_id:string,location:string,age:int>, "
    "auction_details struct<auction_id:string,bid_amount:float,timestamp:string>, "
    "ad_targeting_criteria struct<keywords:array<string>,device_type:string>"
)

# What standardizing sets, and the names of the audited operations.
STANDARD = {"website": "example.com"}
READ_STAGING = "read_staging"
FILTER_DATA = "filter_data"
DEDUPLICATE_DATA = "deduplicate_data"
READ_INGESTION = "read_ingestion"

# Operations audited beyond those.
FILTER_INCREMENTAL = "filter_incremental"
INVALID_TIMESTAMP = "invalid_timestamp"
STREAM_READ = "stream_read"
STREAM_LOAD = "stream_load"
STREAM_LATE = "stream_late"

# Headers of the interactions file, and the names every later layer uses.
INTERACTION_NAMES = {
    "Event Timestamp": "timestamp",
    "User ID": "user_id",
    "Ad Campaign ID": "ad_campaign_id",
    "Conversion Type": "conversion_type",
}

USER = "user_id"
TIME = "timestamp"
KEYS = (USER, TIME)
LOAD_DATE = "load_date"
IS_CURRENT = "is_current"
MALFORMED = "_corrupt_record"

AUDIT = "operation string, record_count bigint, operation_timestamp timestamp"


def schema_from_file(spark: SparkSession, path: str) -> StructType:
    """The schema kept in a file that Spark can read: a ``StructType`` as JSON
    (``df.schema.json()``), or an Avro schema document."""
    text = spark.read.text(path, wholetext=True).first().value
    found = json.loads(text)
    return StructType.fromJson(found) if isinstance(found, dict) and found.get("type") == "struct" else compile_avsc(found)
