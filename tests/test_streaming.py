import os
from pathlib import Path

from lakeload.plans import load_fact
from lakeload.plans.load import LoadSpec
from lakeload.sinks.tables import LakeTable
from lakeload.sources import read_archive_log
from lakeload.streaming import archive_stream, load_stream
from tests.conftest import rows
from tests.test_jobs import EPOCH, landing


def test_landing_to_table_with_restarts(spark, lake):
    folder = landing(lake, a__csv=b"k,a\n1,x\n2,y\n", b__csv__partial=b"k,a\n9,z\n")
    spec = LoadSpec(
        f"{lake}/archive/log", f"{lake}/table", f"{lake}/tablelog", bk="k", fmt="csv", initial=EPOCH
    )

    def run():
        archive_stream(
            spark, str(folder), f"{lake}/archive", f"{lake}/c1", max_files_per_trigger=1, available_now=True
        ).awaitTermination()
        load_stream(spark, spec, f"{lake}/c2", load_fact, available_now=True).awaitTermination()

    run()
    run()
    assert rows(LakeTable(spark, spec.target_path).read(), "k", "a") == [("1", "x"), ("2", "y")]
    (Path(folder) / "c.csv").write_bytes(b"k,a\n1,x2\n")
    os.rename(folder / "b.csv.partial", folder / "d.csv")
    run()
    log = read_archive_log(spark, f"{lake}/archive/log")
    assert rows(log, "OriginalStagingFileName") == [("a.csv",), ("c.csv",), ("d.csv",)]
    assert [n for n in os.listdir(folder) if not n.startswith(".")] == []
    assert rows(LakeTable(spark, spec.target_path).read(), "k") == [("1",), ("2",), ("9",)]
