from medallion.sources.raw import (
    read_gen_info_json,
    read_gold,
    read_malformed_json,
    read_measures_csv,
)
from medallion.sources.snapshot import (
    Snapshot,
    latest_csv,
    load_latest_snapshot,
    read_latest_snapshot,
    snapshot_provenance,
)

__all__ = [
    "Snapshot",
    "latest_csv",
    "load_latest_snapshot",
    "read_gen_info_json",
    "read_gold",
    "read_latest_snapshot",
    "read_malformed_json",
    "read_measures_csv",
    "snapshot_provenance",
]
