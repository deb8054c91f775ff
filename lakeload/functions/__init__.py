from lakeload.functions.hashing import hash_expression, row_hash
from lakeload.functions.identifiers import brackets_to_backticks, catalog_name, catalog_name_of, column, parse_columns, quote
from lakeload.functions.scalars import (
    archive_calendar,
    day_number,
    epoch_millis,
    file_extension,
    file_name,
    human_bytes,
    instant,
    name_prefix,
    utc_clock,
)
