from beaconmill.streaming.event_time import close_stream, stream_correlated, stream_deduplicated
from beaconmill.streaming.incremental import stream_load

__all__ = ["close_stream", "stream_correlated", "stream_deduplicated", "stream_load"]
