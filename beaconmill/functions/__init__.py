from beaconmill.functions.columns import all_present, event_id, instant, micros, refuse_column, time_bucket, unused

__all__ = ["all_present", "event_id", "instant", "micros", "refuse_column", "time_bucket", "unused"]
