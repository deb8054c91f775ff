from lakeload.operators.alignment import align_schemas, common_schema, conform, union_drifting
from lakeload.operators.fold import fact_fold, number_in_order, scd1_fold, scd1_fold_filtered, scd2_from_snapshots
from lakeload.operators.history import (
    dimension_as_of,
    open_versions,
    scd2_as_of,
    scd2_close_deleted,
    scd2_current,
    scd2_merge,
    scd2_merge_current,
    scd2_rewind,
)
from lakeload.operators.incremental import (
    changed_since,
    export_watermark,
    initial_watermark,
    load_order,
    load_watermark,
    mark_ignorable,
    next_watermark,
    pending_files,
    process_log_rows,
    repair_log_types,
    visible_files,
)
from lakeload.operators.matching import keep_last, match_condition, members, pair, require_unique, unique_source
from lakeload.operators.merge import (
    fact_merge,
    fact_soft_delete,
    scd1_merge,
    scd1_merge_partitions,
    slice_flag,
    touched_partitions,
)
from lakeload.operators.projection import (
    complex_as_string,
    drop_null_keys,
    exclude,
    extract,
    prepare_source,
    underscore_names,
    with_lineage,
    with_partition_columns,
)
from lakeload.operators.retention import choose_tables, mark_purged, purge_candidates, purge_report, purge_summary, purge_totals
from lakeload.operators.splice import fact_splice, scd2_splice, unseen_since
