import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from lakeload.functions import row_hash  # noqa: E402
from lakeload.operators import with_lineage  # noqa: E402
from lakeload.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", "/tmp/lakeload-warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path)


def day(n: int, hour: int = 0) -> dt.datetime:
    return dt.datetime(2023, 1, 1, hour) + dt.timedelta(days=n)


def ntz(value: dt.datetime):
    return F.lit(str(value)).cast("timestamp_ntz")


@pytest.fixture
def extract_of(spark):
    """``extract_of(n, rows)``: rows (k, a, d) as the file archived on day ``n``."""

    def make(n: int, rows, mode: str = "safe", schema: str = "k int, a string, d string"):
        df = row_hash(spark.createDataFrame(rows, schema), mode=mode)
        return with_lineage(df, ntz(day(n, 1)), ntz(day(n)), f"file{n}", f"name{n}")

    return make


def rows(df, *columns):
    """Chosen columns as sorted tuples; times as day numbers or None."""

    def plain(value):
        if isinstance(value, dt.datetime):
            return "open" if value.year == 9999 else (value - dt.datetime(2023, 1, 1)).days
        return value

    picked = df.select(*columns) if columns else df
    return sorted((tuple(plain(v) for v in r) for r in picked.collect()), key=repr)
