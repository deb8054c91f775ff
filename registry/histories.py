"""Full-history tables: merge steps, rebuilding from extracts, point-in-time reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeload.functions import row_hash
from lakeload.operators import (
    dimension_as_of,
    open_versions,
    scd2_as_of,
    scd2_close_deleted,
    scd2_current,
    scd2_from_snapshots,
    scd2_merge,
    scd2_rewind,
)
from lakeload.schemas import ARCHIVED, END, START
from registry import extracts as x
from registry import query

COLS = [*x.CUSTOMER_COLS, "__HashDiff", *x.LINEAGE_COLS]
VALID = "__StartDatetimeUTC, __EndDatetimeUTC, __Current"
OPEN = "TIMESTAMP '9999-12-31 00:00:00'"


def opened_sql(body: str, ts: str) -> str:
    return f"SELECT *, TIMESTAMP '{ts}' AS __StartDatetimeUTC, {OPEN} AS __EndDatetimeUTC, true AS __Current FROM ({body})"


def base(spark, sf):
    return open_versions(x.customer_base(spark, sf), x.stamp(x.BASE_TS))


_TS = f"WITH t AS ({opened_sql(x.CUSTOMER_BASE_SQL, x.BASE_TS)}), s AS ({x.CUSTOMER_DELTA_SQL})"


def merged_sql(closed: str, insert: bool = True) -> str:
    """Target rows with the end set where ``closed``, then the new versions."""
    kept = f"""
    SELECT {", ".join("t." + c for c in COLS)}, t.__StartDatetimeUTC,
           CASE WHEN {closed} THEN TIMESTAMP '{x.DELTA_TS}' ELSE t.__EndDatetimeUTC END AS __EndDatetimeUTC,
           NOT ({closed}) AS __Current
    FROM t LEFT JOIN s ON t.custkey = s.custkey"""
    new = f"""
    UNION ALL SELECT {", ".join("s." + c for c in COLS)}, TIMESTAMP '{x.DELTA_TS}', {OPEN}, true
    FROM s LEFT JOIN t ON t.custkey = s.custkey WHERE t.custkey IS NULL OR t.__HashDiff <> s.__HashDiff"""
    return kept + (new if insert else "")


_CHANGED = "coalesce(s.__HashDiff <> t.__HashDiff, false)"


@query("scd2_initial", opened_sql(x.CUSTOMER_BASE_SQL, x.BASE_TS))
def scd2_initial(spark, sf):
    return scd2_merge(None, x.customer_base(spark, sf), ["custkey"], x.stamp(x.BASE_TS))


@query("scd2_merge", _TS + merged_sql(_CHANGED))
def scd2_merge_query(spark, sf):
    return scd2_merge(base(spark, sf), x.customer_delta(spark, sf), ["custkey"], x.stamp(x.DELTA_TS))


@query("scd2_merge_full_extract", _TS + merged_sql(f"({_CHANGED} OR s.custkey IS NULL)"))
def scd2_merge_full_extract(spark, sf):
    """Close changed and vanished keys and open new versions in one join."""
    return scd2_merge(
        base(spark, sf), x.customer_delta(spark, sf), ["custkey"], x.stamp(x.DELTA_TS), delete="full"
    )


@query("scd2_delete_full", _TS + merged_sql("s.custkey IS NULL", insert=False))
def scd2_delete_full(spark, sf):
    return scd2_close_deleted(base(spark, sf), x.customer_delta(spark, sf), ["custkey"], x.stamp(x.DELTA_TS))


# Parts as entered, and the parts that were ordered, under a later price.
_PART = ["partkey", "name", "brand", "kind", "size"]


def _parts(spark, sf, later: bool):
    part = x.table(spark, sf, "part")
    if later:
        sold = x.table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select("l_partkey")
        part = part.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left_semi")
    size = F.when(F.col("p_retailprice") > 1000, F.col("p_size") + 1).otherwise(F.col("p_size"))
    rows = part.select(
        F.col("p_partkey").alias("partkey"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("kind"),
        (size if later else F.col("p_size")).alias("size"),
    )
    hashed = row_hash(rows, mode="concat")
    return x.delta_lineage(hashed, "part") if later else x.base_lineage(hashed, "part")


def _parts_sql(later: bool) -> str:
    size = "CASE WHEN p_retailprice > 1000 THEN p_size + 1 ELSE p_size END" if later else "p_size"
    where = "WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')" if later else ""
    return f"""SELECT *, {x.hash_sql(_PART)}, {x.lineage_sql("part", 2 if later else 1)}
      FROM (SELECT p_partkey AS partkey, p_name AS name, p_brand AS brand, p_type AS kind, {size} AS size
            FROM part {where})"""


_PARTS = [*_PART, "__HashDiff", *x.LINEAGE_COLS]
_PART_GONE = "(s.partkey IS NULL AND (t.brand, t.kind) IN (SELECT (brand, kind) FROM s))"


@query(
    "scd2_delete_filtered",
    f"""WITH t AS ({opened_sql(_parts_sql(False), x.BASE_TS)}), s AS ({_parts_sql(True)})
    SELECT {", ".join("t." + c for c in _PARTS)}, t.__StartDatetimeUTC,
           CASE WHEN {_PART_GONE} OR {_CHANGED} THEN TIMESTAMP '{x.DELTA_TS}' ELSE t.__EndDatetimeUTC END AS __EndDatetimeUTC,
           NOT ({_PART_GONE} OR {_CHANGED}) AS __Current
    FROM t LEFT JOIN s ON t.partkey = s.partkey
    UNION ALL SELECT {", ".join("s." + c for c in _PARTS)}, TIMESTAMP '{x.DELTA_TS}', {OPEN}, true
    FROM s LEFT JOIN t ON t.partkey = s.partkey WHERE t.partkey IS NULL OR t.__HashDiff <> s.__HashDiff""",
)
def scd2_delete_filtered(spark, sf):
    """Parts vanish only inside the (brand, type) slices that the file names."""
    return scd2_merge(
        open_versions(_parts(spark, sf, False), x.stamp(x.BASE_TS)),
        _parts(spark, sf, True),
        ["partkey"],
        x.stamp(x.DELTA_TS),
        delete="filtered",
        filter_cols=["brand", "kind"],
    )


def runs_sql(rows: str = "n") -> str:
    return f"""
    c AS (SELECT *, lag(__HashDiff) OVER w AS ph, lag(seq) OVER w AS ps FROM {rows}
          WINDOW w AS (PARTITION BY custkey ORDER BY seq)),
    f AS (SELECT *, sum(CASE WHEN ps IS NULL OR ps <> seq - 1 OR ph <> __HashDiff THEN 1 ELSE 0 END)
                    OVER (PARTITION BY custkey ORDER BY seq) AS run FROM c),
    times AS (SELECT DISTINCT seq, __ArchiveDatetimeUTC AS ts FROM n),
    g AS (SELECT *, max(seq) OVER (PARTITION BY custkey, run) AS hi,
                 row_number() OVER (PARTITION BY custkey, run ORDER BY seq) AS rn FROM f),
    h AS (SELECT {", ".join(COLS)}, __ArchiveDatetimeUTC AS __StartDatetimeUTC,
                 coalesce(ts, {OPEN}) AS __EndDatetimeUTC, ts IS NULL AS __Current
          FROM g LEFT JOIN times ON times.seq = hi + 1 WHERE rn = 1)"""


HISTORY_SQL = f"WITH {x.NUMBERED_YEARS_SQL}, {runs_sql()}"


def history(spark, sf, **options):
    options = {"on_duplicates": "assume_unique", "snapshots": x.customer_files(spark, sf), **options}
    return scd2_from_snapshots(x.customer_years(spark, sf), ["custkey"], **options)


@query("scd2_from_snapshots", f"{HISTORY_SQL} SELECT * FROM h")
def scd2_from_snapshots_query(spark, sf):
    return history(spark, sf)


@query("scd2_from_snapshots_chunked", f"{HISTORY_SQL} SELECT * FROM h")
def scd2_from_snapshots_chunked(spark, sf):
    """The same with groups of at most two files, as for keys that fill much of the data."""
    return history(spark, sf, chunk_files=2)


def _split_years(spark, sf):
    years, files = x.customer_years(spark, sf), x.customer_files(spark, sf)
    late = F.col(ARCHIVED) > x.stamp("2000-06-01 00:00:00")
    early = scd2_from_snapshots(
        years.where(~late), ["custkey"], snapshots=files.where(~late), on_duplicates="assume_unique"
    )
    return early, years.where(late), files.where(late)


@query("scd2_snapshots_onto_table", f"{HISTORY_SQL} SELECT * FROM h")
def scd2_snapshots_onto_table(spark, sf):
    """A table built from the early extracts takes the later ones in one pass."""
    early, late, files = _split_years(spark, sf)
    return scd2_from_snapshots(
        late, ["custkey"], target=early, snapshots=files, on_duplicates="assume_unique"
    )


@query(
    "scd2_rewind",
    f"""{HISTORY_SQL} SELECT * REPLACE (
      CASE WHEN {END} >= TIMESTAMP '2000-06-01 00:00:00' THEN {OPEN} ELSE {END} END AS {END},
      {END} >= TIMESTAMP '2000-06-01 00:00:00' AS __Current) FROM h
    WHERE {START} < TIMESTAMP '2000-06-01 00:00:00'""",
)
def scd2_rewind_query(spark, sf):
    """The history as it was when only the early extracts were known."""
    return scd2_rewind(history(spark, sf), x.stamp("2000-06-01 00:00:00"))


@query("scd2_reappear", f"{HISTORY_SQL} SELECT * FROM h")
def scd2_reappear(spark, sf):
    """The later extracts merged one by one: vanished customers come back as new versions."""
    table, late, files = _split_years(spark, sf)
    for taken in [F.lit(r[ARCHIVED]).cast("timestamp_ntz") for r in files.orderBy(ARCHIVED).collect()]:
        table = scd2_merge(table, late.where(F.col(ARCHIVED) == taken), ["custkey"], taken, delete="full")
    return table


@query("scd2_current", f"{HISTORY_SQL} SELECT * FROM h WHERE __Current")
def scd2_current_query(spark, sf):
    return scd2_current(history(spark, sf))


@query(
    "scd2_as_of",
    f"""{HISTORY_SQL} SELECT * FROM h
    WHERE __StartDatetimeUTC <= TIMESTAMP '1999-05-05 00:00:00' AND TIMESTAMP '1999-05-05 00:00:00' < __EndDatetimeUTC""",
)
def scd2_as_of_query(spark, sf):
    return scd2_as_of(history(spark, sf), x.stamp("1999-05-05 00:00:00"))


@query(
    "fact_dim_as_of",
    f"""{HISTORY_SQL}
    SELECT o_orderkey, o_custkey, o_orderdate, status AS cust_status, segment, __StartDatetimeUTC AS since
    FROM orders LEFT JOIN h ON o_custkey = custkey
         AND __StartDatetimeUTC <= o_orderdate AND o_orderdate < __EndDatetimeUTC""",
)
def fact_dim_as_of(spark, sf):
    """Every order with the customer version valid on its date."""
    orders = x.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    versions = history(spark, sf).select(
        "custkey", F.col("status").alias("cust_status"), "segment", START, END, F.col(START).alias("since")
    )
    found = dimension_as_of(orders, versions, ["o_custkey"], ["custkey"], "o_orderdate")
    return found.drop(START, END)
