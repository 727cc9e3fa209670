from quarry.sources.io import (  # noqa: F401
    INCIDENT_SCHEMA,
    VersionedTable,
    scan_csv,
    scan_csv_checked,
    scan_parquet,
    sink_csv,
    sink_parquet,
)
from quarry.sources.tables import TABLES, read_table, table_path  # noqa: F401
