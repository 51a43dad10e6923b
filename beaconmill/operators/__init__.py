from beaconmill.operators.attribution import attribute_first, attribute_last_touch, attribute_within
from beaconmill.operators.cleanse import (
    convert_types,
    deduplicate,
    drop_null_keys,
    newer_than,
    stamp_version,
    standardize,
    uppercase,
)
from beaconmill.operators.correlate import correlate
from beaconmill.operators.staging import (
    clicks_of,
    conversions_of,
    flatten,
    rename_interactions,
    stamp_arrival,
    stringify,
)
from beaconmill.operators.validity import as_of, validity
from beaconmill.operators.versions import close_out, current_versions, not_loaded, within_span

__all__ = [
    "as_of",
    "attribute_first",
    "attribute_last_touch",
    "attribute_within",
    "clicks_of",
    "close_out",
    "conversions_of",
    "convert_types",
    "correlate",
    "current_versions",
    "deduplicate",
    "drop_null_keys",
    "flatten",
    "newer_than",
    "not_loaded",
    "rename_interactions",
    "stamp_arrival",
    "stamp_version",
    "standardize",
    "stringify",
    "uppercase",
    "validity",
    "within_span",
]
