"""Steps of merges and folds whose tasks, or whose shuffles, follow the input's size."""

import pytest
from pyspark.sql import functions as F

from lakeload.operators import fact_fold, keep_last, scd2_from_snapshots, scd2_merge
from lakeload.operators import matching
from lakeload.operators.matching import members, tasks_for
from lakeload.sinks.tables import LakeTable
from tests.conftest import day, ntz, rows

VALID = ["k", "a", "__StartDatetimeUTC", "__EndDatetimeUTC"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def tiny_tasks(monkeypatch):
    monkeypatch.setattr(matching, "TASK_BYTES", 100)


def test_tasks_follow_the_files(spark, lake, tiny_tasks):
    small = stored(spark, spark.range(10), f"{lake}/small")
    large = stored(spark, spark.range(100_000), f"{lake}/large")
    assert tasks_for(large) > 10 * tasks_for(small) > 0
    assert tasks_for(large.join(large.where("id > 5"), "id")) == tasks_for(large)
    assert tasks_for(spark.createDataFrame([(1,)], "id long")) == 0


def test_merge_deals_large_input_over_more_tasks(spark, lake, extract_of, tiny_tasks):
    """both sides of a merge, NULL keys included."""
    first = stored(spark, extract_of(0, [(1, "x", "p"), (None, "n", "p"), (3, "z", "p")]), f"{lake}/0")
    second = stored(spark, extract_of(1, [(1, "y", "p"), (None, "n", "p")]), f"{lake}/1")
    table = scd2_merge(None, first, ["k"], ntz(day(0)))
    merged = scd2_merge(table, second, ["k"], ntz(day(1)), delete="full")
    assert f", {tasks_for(merged)}), REPARTITION_BY_NUM" in plan(merged)
    assert rows(merged, *VALID) == sorted(
        [(1, "x", 0, 1), (1, "y", 1, "open"), (3, "z", 0, 1), (None, "n", 0, "open")], key=repr
    )


@pytest.mark.parametrize("chunk_files", [None, 2])
def test_runs_are_found_over_more_tasks(spark, lake, extract_of, tiny_tasks, chunk_files):
    """without another shuffle than the windows' own."""
    days = [[(1, "x", "p"), (2, "a", "p")], [(1, "x", "p")], [(1, "y", "p"), (2, "a", "p")]]
    batch = None
    for n, day_rows in enumerate(days):
        part = extract_of(n, day_rows)
        batch = part if batch is None else batch.unionByName(part)
    batch = stored(spark, batch, f"{lake}/batch")
    history = scd2_from_snapshots(batch, ["k"], on_duplicates="assume_unique", chunk_files=chunk_files)
    assert plan(history).count("REPARTITION_BY_NUM") == (1 if chunk_files is None else 2)
    assert rows(history, *VALID) == sorted(
        [(1, "x", 0, 2), (1, "y", 2, "open"), (2, "a", 0, 1), (2, "a", 2, "open")], key=repr
    )


def test_filters_on_keys_pass_the_last_row(spark, lake):
    """the rows of other periods are not grouped first."""
    data = [(1, 1, 5, "a"), (1, 1, 7, "b"), (1, 2, 1, "c"), (None, 2, 4, None)]
    df = stored(spark, spark.createDataFrame(data, "k long, yr int, at int, v string"), f"{lake}/rows")
    last = keep_last(df, ["k", "yr"], ["at"])
    assert last.columns == df.columns
    assert rows(last) == sorted([(1, 1, 7, "b"), (1, 2, 1, "c"), (None, 2, 4, None)], key=repr)
    lines = last.where("yr = 2")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    names = [line.strip(" +-:").split(" ")[0] for line in lines]
    assert names.index("Aggregate") < names.index("Filter")


def test_short_lists_leave_the_rows_in_place(spark, lake):
    """a list of files made by the driver has no known size."""
    df = stored(spark, spark.range(100).withColumn("f", F.col("id") % 3), f"{lake}/rows")
    files = spark.createDataFrame([(0, 10), (1, 11)], "f long, n long")
    found = members(df, files, ["f"], "inner", few=True)
    assert "hashpartitioning" not in plan(found)
    assert found.count() == members(df, files, ["f"], "inner").count() == 67


def test_known_slices_give_the_same_facts(spark, extract_of):
    """the rows stay in place where the slices of each file are listed."""
    batch = extract_of(0, [(1, "x", "p"), (2, "y", "q")]).unionByName(extract_of(1, [(3, "z", "p")]))
    batch = batch.unionByName(extract_of(2, [(2, "y", "q")]))
    snapshots = batch.select("__ArchiveDatetimeUTC").distinct()
    named = batch.select("d", "__ArchiveDatetimeUTC").distinct()
    shown = ["k", "a", "__DeletedDatetimeUTC"]
    expected = [(1, "x", 5), (2, "y", None), (3, "z", None)]
    for slices in (None, named):
        options = {"snapshots": snapshots, "filter_cols": ["d"], "slices": slices, "on_duplicates": "assume_unique"}
        folded = fact_fold(None, batch, ["k"], ntz(day(5)), **options)
        assert rows(folded, *shown) == sorted(expected, key=repr)


def test_staged_partitions_are_not_dealt_again(spark, lake, monkeypatch):
    """one shuffle balances the files; putting them in place takes none."""
    hints = []

    def counted(self, name, *parameters):
        hints.append(name)
        return hint(self, name, *parameters)

    table = LakeTable(spark, f"{lake}/t", ["p"])
    data = spark.range(1000).withColumn("p", F.col("id") % 4)
    table.write(data)
    hint = type(data).hint
    monkeypatch.setattr(type(data), "hint", counted)
    touched = data.where("p < 2").select("p").distinct()
    table.replace(lambda _: data.where("p = 0").withColumn("id", -F.col("id")), touched)
    left = rows(table.read().groupBy("p").agg(F.count("*").alias("n"), F.min("id").alias("low")))
    assert left == sorted([(0, 250, -996), (2, 250, 2), (3, 250, 3)], key=repr)
    assert hints.count("rebalance") == 1
