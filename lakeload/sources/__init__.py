from lakeload.sources.archive import (
    attach_lineage,
    log_frame,
    read_archive,
    read_archive_log,
    read_export_log,
    read_log,
    read_process_log,
)
from lakeload.sources.landing import direct_files, list_landing, list_tree
from lakeload.sources.tables import (
    archive_log_locations,
    archive_tables,
    jdbc_options,
    read_archive_tables,
    read_jdbc,
    read_query,
    read_table,
)
