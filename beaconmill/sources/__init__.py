from beaconmill.sources.files import read_avro_strings, read_csv_strings, read_json_strings
from beaconmill.sources.mixed import file_layouts, read_json_mixed
from beaconmill.sources.spec import (
    SOURCES,
    SourceSpec,
    check_json_layout,
    read_source,
    readable,
    source_spec,
    split_malformed,
)

__all__ = [
    "file_layouts",
    "read_json_mixed",
    "SOURCES",
    "SourceSpec",
    "check_json_layout",
    "read_avro_strings",
    "read_csv_strings",
    "read_json_strings",
    "read_source",
    "readable",
    "source_spec",
    "split_malformed",
]
