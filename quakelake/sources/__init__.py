from quakelake.sources.bronze import (
    SameNameError,
    land_documents,
    land_payloads,
    scan_documents,
    scan_lines,
    scan_payloads,
    scan_text,
)
from quakelake.sources.silver_lines import (
    outcome_lines,
    read_lost,
    read_rejects,
    read_silver,
    silver_lines,
    write_lines,
)
from quakelake.sources.tables import (
    POSITION,
    CommitConflictError,
    EmptyBatchError,
    VersionedTable,
    with_position,
)

__all__ = [
    "POSITION",
    "CommitConflictError",
    "EmptyBatchError",
    "SameNameError",
    "VersionedTable",
    "land_documents",
    "land_payloads",
    "outcome_lines",
    "read_lost",
    "read_rejects",
    "read_silver",
    "scan_documents",
    "scan_lines",
    "scan_payloads",
    "scan_text",
    "silver_lines",
    "with_position",
    "write_lines",
]
