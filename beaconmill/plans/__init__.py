from beaconmill.plans.analytical import correlate_layers, load_all, run_all
from beaconmill.plans.audit import append_audit, counted, measure, read_audit
from beaconmill.plans.delta import update_analytical
from beaconmill.plans.ingest import malformed_rows, snapshot, stage, staged
from beaconmill.plans.columns import merged, recorded_columns
from beaconmill.plans.layers import Buckets, Layers, append, overwrite, read_if_present, read_layer, save_arrivals
from beaconmill.plans.loads import (
    cleanse,
    close_versions,
    full_load,
    full_load_frame,
    incremental_load,
    incremental_load_frame,
    remembered_mark,
)
from beaconmill.plans.published import Listed, Load, add_load, listed, read_loads, remove_unlisted, replace_dataset, write_load
from beaconmill.plans.reconcile import compared, fingerprint, read_reconciled, reconcile

__all__ = [
    "Buckets",
    "Layers",
    "Listed",
    "Load",
    "add_load",
    "append",
    "append_audit",
    "cleanse",
    "close_versions",
    "compared",
    "correlate_layers",
    "counted",
    "fingerprint",
    "full_load",
    "full_load_frame",
    "incremental_load",
    "incremental_load_frame",
    "listed",
    "load_all",
    "malformed_rows",
    "measure",
    "merged",
    "overwrite",
    "read_audit",
    "read_if_present",
    "read_layer",
    "read_reconciled",
    "reconcile",
    "recorded_columns",
    "read_loads",
    "remembered_mark",
    "remove_unlisted",
    "replace_dataset",
    "save_arrivals",
    "run_all",
    "snapshot",
    "stage",
    "staged",
    "update_analytical",
    "write_load",
]
