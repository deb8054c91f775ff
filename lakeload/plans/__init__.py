from lakeload.plans.archive import archive_batch, archive_job
from lakeload.plans.export import export_frame, export_query, export_table, to_jdbc, to_warehouse
from lakeload.plans.load import LateFileError, LoadSpec, load_fact, load_scd1, load_scd1_frame, load_scd1_jdbc, load_scd2
from lakeload.plans.publish import publish_as_is, publish_select, stage_to, stage_to_jdbc, stage_to_warehouse
from lakeload.plans.purge import purge_catalog, purge_job
