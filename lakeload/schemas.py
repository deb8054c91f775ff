"""Fixed schemas of the logs and names of the technical columns."""

from __future__ import annotations

from pyspark.sql import types as T

HASH = "__HashDiff"
MODIFIED = "__ModifiedDatetimeUTC"
ARCHIVED = "__ArchiveDatetimeUTC"
ARCHIVE_FILE = "__ArchiveFilePath"
STAGING_NAME = "__OriginalStagingFileName"
DELETED = "__DeletedDatetimeUTC"
#: In tables of the load jobs: the last extract with a current-image row, and the first extract
#: without a deleted fact row.
SEEN = "__SeenDatetimeUTC"
ABSENT = "__AbsentDatetimeUTC"
START = "__StartDatetimeUTC"
END = "__EndDatetimeUTC"
CURRENT = "__Current"

LINEAGE = (MODIFIED, ARCHIVED, ARCHIVE_FILE, STAGING_NAME)
VALIDITY = (START, END, CURRENT)
OPEN_END = "9999-12-31 00:00:00"

LOG_PARTITION = "ArchiveyyyyMMddUTC"

ARCHIVE_LOG = T.StructType(
    [
        T.StructField("ArchiveDatetimeUTC", T.TimestampType()),
        T.StructField("ArchiveYearUTC", T.IntegerType()),
        T.StructField("ArchiveMonthUTC", T.IntegerType()),
        T.StructField("ArchiveDayUTC", T.IntegerType()),
        T.StructField("ArchiveyyyyMMddUTC", T.IntegerType()),
        T.StructField("OriginalStagingFilePath", T.StringType()),
        T.StructField("OriginalStagingFileName", T.StringType()),
        T.StructField("OriginalStagingFileSize", T.LongType()),
        T.StructField("OriginalModificationTime", T.TimestampType()),
        T.StructField("ArchiveFilePath", T.StringType()),
        T.StructField("ArchiveFileName", T.StringType()),
        T.StructField("IsPurged", T.BooleanType()),
        T.StructField("PurgeDatetimeUTC", T.TimestampType()),
        T.StructField("IsIgnorable", T.BooleanType()),
        T.StructField("Notes", T.StringType()),
    ]
)

PROCESS_LOG = T.StructType(
    [
        T.StructField("ProcessDatetime", T.TimestampType()),
        T.StructField("ArchiveDatetimeUTC", T.TimestampType()),
        T.StructField("OriginalStagingFilePath", T.StringType()),
        T.StructField("OriginalStagingFileName", T.StringType()),
        T.StructField("OriginalStagingFileSize", T.LongType()),
        T.StructField("ArchiveFilePath", T.StringType()),
        T.StructField("ArchiveFileName", T.StringType()),
    ]
)

EXPORT_LOG = T.StructType([T.StructField("ProcessDatetime", T.TimestampType())])

# The binaryFile source; only what describes a file is used, its content is never read.
BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType()),
    ]
)
FILE_LISTING = T.StructType(BINARY_FILE.fields[:3])
