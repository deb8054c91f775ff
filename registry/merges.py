"""Current-image and fact merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeload.functions import row_hash
from lakeload.operators import (
    fact_fold,
    fact_merge,
    fact_soft_delete,
    keep_last,
    number_in_order,
    scd1_fold,
    scd1_merge,
    scd1_merge_partitions,
    union_drifting,
)
from lakeload.schemas import ARCHIVE_FILE, ARCHIVED, DELETED, HASH
from registry import extracts as x
from registry import query

CUSTOMER = [*x.CUSTOMER_COLS, "__HashDiff", *x.LINEAGE_COLS]
ORDER = [*x.ORDER_COLS, "__HashDiff", *x.LINEAGE_COLS]
TAKE = "t.__HashDiff IS NULL OR s.__HashDiff <> t.__HashDiff"


def pick(cols, take: str = TAKE) -> str:
    return ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)


def with_ts(t: str, s: str) -> str:
    return f"WITH t AS ({t}), s AS ({s})"


# ---- SCD1 ----------------------------------------------------------------------------


@query(
    "scd1_merge",
    f"""{with_ts(x.CUSTOMER_BASE_SQL, x.CUSTOMER_DELTA_SQL)}
    SELECT {pick(CUSTOMER)} FROM t FULL JOIN s ON t.custkey = s.custkey""",
)
def scd1_merge_query(spark, sf):
    """Extracts hold each customer once by construction, so nothing is left to check."""
    return scd1_merge(
        x.customer_base(spark, sf), x.customer_delta(spark, sf), ["custkey"], on_duplicates="assume_unique"
    )


@query(
    "scd1_checked_unique",
    f"""{with_ts(x.CUSTOMER_BASE_SQL, x.CUSTOMER_DELTA_SQL)}
    SELECT {pick(CUSTOMER)} FROM t FULL JOIN s ON t.custkey = s.custkey""",
)
def scd1_checked_unique(spark, sf):
    """The same merge with the check that fails on repeated keys."""
    return scd1_merge(x.customer_base(spark, sf), x.customer_delta(spark, sf), ["custkey"])


@query(
    "scd1_merge_broadcast",
    f"""{with_ts(x.CUSTOMER_BASE_SQL, x.CUSTOMER_DELTA_SQL)}
    SELECT {pick(CUSTOMER)} FROM t FULL JOIN s ON t.custkey = s.custkey""",
)
def scd1_merge_broadcast(spark, sf):
    return scd1_merge(
        x.customer_base(spark, sf), x.customer_delta(spark, sf), ["custkey"], strategy="broadcast"
    )


@query("scd1_initial", f"SELECT * FROM ({x.CUSTOMER_BASE_SQL})")
def scd1_initial(spark, sf):
    return scd1_merge(None, x.customer_base(spark, sf), ["custkey"])


@query(
    "scd1_update_filter",
    f"""{with_ts(x.CUSTOMER_BASE_SQL, x.CUSTOMER_DELTA_SQL)}
    SELECT {pick(CUSTOMER, "t.__HashDiff IS NULL OR (s.__HashDiff <> t.__HashDiff AND s.status > t.status)")}
    FROM t FULL JOIN s ON t.custkey = s.custkey""",
)
def scd1_update_filter(spark, sf):
    return scd1_merge(
        x.customer_base(spark, sf),
        x.customer_delta(spark, sf),
        ["custkey"],
        update_filter="s.status > t.status",
    )


_WIDE_SQL = f"""
  SELECT s.custkey, s.name, s.segment, s.status, c_nationkey AS nation,
         sha256(concat_ws('||', s.custkey, s.name, s.segment, s.status, c_nationkey)) AS __HashDiff,
         {", ".join("s." + c for c in x.LINEAGE_COLS)}
  FROM ({x.CUSTOMER_DELTA_SQL}) s JOIN customer ON s.custkey = c_custkey"""
_NARROW_SQL = f"SELECT CAST(custkey AS INTEGER) AS custkey, * EXCLUDE (custkey) FROM ({x.CUSTOMER_BASE_SQL})"
_WIDE_HAVE = ["name", "status", "__HashDiff", *x.LINEAGE_COLS]


@query(
    "scd1_new_columns",
    f"""{with_ts(_NARROW_SQL, _WIDE_SQL)}
    SELECT CASE WHEN {TAKE} THEN s.custkey ELSE t.custkey END AS custkey, {pick(_WIDE_HAVE)},
           t.segment, CASE WHEN {TAKE} THEN s.nation END AS nation
    FROM t FULL JOIN s ON t.custkey = s.custkey""",
)
def scd1_new_columns(spark, sf):
    """A column is added, one is missing in the file, the key widens from int to long."""
    target = x.customer_base(spark, sf).withColumn("custkey", F.col("custkey").cast("int"))
    nation = x.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nation")
    )
    source = x.customer_delta(spark, sf).join(nation, "custkey")
    source = row_hash(source, [*x.CUSTOMER_COLS, "nation"], "concat")
    return scd1_merge(target, source.drop("segment"), ["custkey"])


# Keys with NULLs: the segment is NULL for customers without an open order status.
_NK = ["segkey", "nation", "orders_n"]


def _segments(spark, sf, early: bool):
    """Orders counted per (segment, nation); finished orders come without a segment."""
    orders = x.table(spark, sf, "orders")
    split = F.col("o_orderdate") < x.stamp(x.SPLIT)
    rows = orders.where(split if early else ~split).join(
        x.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    counted = rows.groupBy(
        F.when(F.col("o_orderstatus") != "F", F.col("c_mktsegment")).alias("segkey"),
        F.col("c_nationkey").alias("nation"),
    ).agg(F.count(F.lit(1)).alias("orders_n"))
    hashed = row_hash(counted, mode="concat")
    return x.base_lineage(hashed, "segment") if early else x.delta_lineage(hashed, "segment")


def _segments_sql(early: bool) -> str:
    return f"""
      SELECT *, {x.hash_sql(_NK)}, {x.lineage_sql('segment', 1 if early else 2)}
      FROM (SELECT CASE WHEN o_orderstatus <> 'F' THEN c_mktsegment END AS segkey, c_nationkey AS nation,
                   count(*) AS orders_n
            FROM orders JOIN customer ON o_custkey = c_custkey
            WHERE {'' if early else 'NOT '}(o_orderdate < TIMESTAMP '{x.SPLIT}') GROUP BY 1, 2)"""


_SEG = [*_NK, "__HashDiff", *x.LINEAGE_COLS]


@query(
    "scd1_null_safe",
    f"""{with_ts(_segments_sql(True), _segments_sql(False))}
    SELECT {pick(_SEG)} FROM t FULL JOIN s
    ON t.segkey IS NOT DISTINCT FROM s.segkey AND t.nation IS NOT DISTINCT FROM s.nation""",
)
def scd1_null_safe(spark, sf):
    return scd1_merge(_segments(spark, sf, True), _segments(spark, sf, False), ["segkey", "nation"])


@query(
    "scd1_null_unsafe",
    f"""{with_ts(_segments_sql(True), _segments_sql(False))}
    SELECT {pick(_SEG)} FROM t FULL JOIN s ON t.segkey = s.segkey AND t.nation = s.nation""",
)
def scd1_null_unsafe(spark, sf):
    return scd1_merge(
        _segments(spark, sf, True), _segments(spark, sf, False), ["segkey", "nation"], null_safe=False
    )


def _part_delta(spark, sf):
    """Orders with lines, moved to the year of their latest shipment."""
    ship = (
        x.table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("orderkey"))
        .agg(F.year(F.max("l_shipdate")).alias("shipyear"))
    )
    rows = x.order_delta(spark, sf).join(ship, "orderkey")
    rows = rows.withColumn("yr", F.col("shipyear")).drop("shipyear")
    return row_hash(rows.drop(HASH), x.ORDER_COLS, "concat").select(*ORDER)


_PART_DELTA_SQL = f"""
  SELECT orderkey, custkey, status, total, orderdate, yr, mon, {x.hash_sql(x.ORDER_COLS)},
         {", ".join(x.LINEAGE_COLS)}
  FROM (SELECT * REPLACE (CAST(shipyear AS INTEGER) AS yr) FROM ({x.ORDER_DELTA_SQL}) d
        JOIN (SELECT l_orderkey, year(max(l_shipdate)) AS shipyear FROM lineitem GROUP BY 1) ON l_orderkey = orderkey)
"""


@query(
    "scd1_partition_pruned",
    f"""{with_ts(x.ORDER_BASE_SQL, _PART_DELTA_SQL)},
    touched AS (SELECT yr FROM s UNION SELECT t.yr FROM t WHERE orderkey IN (SELECT orderkey FROM s)),
    tt AS (SELECT * FROM t WHERE yr IN (SELECT yr FROM touched))
    SELECT {pick(ORDER).replace("t.", "tt.")} FROM tt FULL JOIN s ON tt.orderkey = s.orderkey""",
)
def scd1_partition_pruned(spark, sf):
    """Only touched years are rewritten; keys that changed year leave the old one."""
    return scd1_merge_partitions(x.order_base(spark, sf), _part_delta(spark, sf), ["orderkey"], ["yr"])


_LINE = ["orderkey", "linenumber", "partkey", "suppkey", "flag", "shipdate"]


@query(
    "scd1_duplicates_last",
    f"""WITH l AS (
      SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_partkey AS partkey, l_suppkey AS suppkey,
             l_returnflag AS flag, CAST(l_shipdate AS DATE) AS shipdate,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_returnflag DESC) AS rn
      FROM lineitem)
    SELECT {", ".join(_LINE)}, {x.hash_sql(_LINE)} FROM l WHERE rn = 1""",
)
def scd1_duplicates_last(spark, sf):
    lines = x.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_shipdate").cast("date").alias("shipdate"),
    )
    return scd1_merge(
        None,
        row_hash(lines, mode="concat"),
        ["orderkey", "linenumber"],
        on_duplicates="last",
        order_by=["shipdate", "partkey", "suppkey", "flag"],
    )


def year_files(spark, sf):
    return number_in_order(x.customer_files(spark, sf), ARCHIVED, [ARCHIVE_FILE])


UNIQUE = {"on_duplicates": "assume_unique"}


@query(
    "scd1_fold",
    f"""WITH {x.NUMBERED_YEARS_SQL},
    c AS (SELECT *, lag(__HashDiff) OVER (PARTITION BY custkey ORDER BY seq) AS prev FROM n),
    r AS (SELECT *, row_number() OVER (PARTITION BY custkey ORDER BY seq DESC) AS rn FROM c
          WHERE prev IS NULL OR prev <> __HashDiff)
    SELECT {", ".join(CUSTOMER)} FROM r WHERE rn = 1""",
)
def scd1_fold_query(spark, sf):
    return scd1_fold(None, x.customer_years(spark, sf), ["custkey"], year_files(spark, sf), **UNIQUE)


@query(
    "scd1_fold_onto_table",
    f"""WITH {x.NUMBERED_YEARS_SQL},
    u AS (SELECT * FROM n UNION ALL SELECT *, 0 AS seq FROM ({x.CUSTOMER_BASE_SQL})),
    c AS (SELECT *, lag(__HashDiff) OVER (PARTITION BY custkey ORDER BY seq) AS prev FROM u),
    r AS (SELECT *, row_number() OVER (PARTITION BY custkey ORDER BY seq DESC) AS rn FROM c
          WHERE prev IS NULL OR prev <> __HashDiff)
    SELECT {", ".join(CUSTOMER)} FROM r WHERE rn = 1""",
)
def scd1_fold_onto_table(spark, sf):
    target, years = x.customer_base(spark, sf), x.customer_years(spark, sf)
    return scd1_fold(target, years, ["custkey"], year_files(spark, sf), chunk_files=2, **UNIQUE)


# ---- facts ---------------------------------------------------------------------------

_NOT_DELETED = "CAST(NULL AS TIMESTAMP) AS __DeletedDatetimeUTC"
_T_FACT = f"SELECT *, {_NOT_DELETED} FROM ({x.ORDER_BASE_SQL})"
_S_FACT = f"SELECT *, {_NOT_DELETED} FROM ({x.ORDER_DELTA_SQL})"
_F = [*ORDER, "__DeletedDatetimeUTC"]


def fact_target(spark, sf):
    return x.order_base(spark, sf).withColumn(DELETED, F.lit(None).cast("timestamp_ntz"))


@query(
    "fact_merge",
    f"""{with_ts(_T_FACT, _S_FACT)}
    SELECT {pick(_F)} FROM t FULL JOIN s ON t.orderkey = s.orderkey""",
)
def fact_merge_query(spark, sf):
    return fact_merge(fact_target(spark, sf), x.order_delta(spark, sf), ["orderkey"], x.stamp(x.NOW_DELTA))


@query(
    "fact_update_filter",
    f"""{with_ts(_T_FACT, _S_FACT)}
    SELECT {pick(_F, "t.__HashDiff IS NULL OR (s.__HashDiff <> t.__HashDiff AND s.status = 'F' AND t.yr < 1999)")}
    FROM t FULL JOIN s ON t.orderkey = s.orderkey""",
)
def fact_update_filter(spark, sf):
    return fact_merge(
        fact_target(spark, sf),
        x.order_delta(spark, sf),
        ["orderkey"],
        x.stamp(x.NOW_DELTA),
        update_filter="s.status = 'F' AND t.yr < 1999",
    )


_T_GONE = f"""SELECT * REPLACE (CASE WHEN total < 200000 THEN TIMESTAMP '2023-01-15 00:00:00' END
                                 AS __DeletedDatetimeUTC) FROM ({_T_FACT})"""
_REVIVE = "s.__HashDiff = t.__HashDiff AND t.__DeletedDatetimeUTC IS NOT NULL"


@query(
    "fact_resurrect",
    f"""{with_ts(_T_GONE, _S_FACT)}
    SELECT {pick(ORDER[:-4])},
      {pick(x.LINEAGE_COLS, f"({TAKE}) OR ({_REVIVE})")},
      CASE WHEN ({TAKE}) OR ({_REVIVE}) THEN NULL ELSE t.__DeletedDatetimeUTC END AS __DeletedDatetimeUTC
    FROM t FULL JOIN s ON t.orderkey = s.orderkey""",
)
def fact_resurrect(spark, sf):
    gone = F.when(F.col("total") < 200000, x.stamp("2023-01-15 00:00:00"))
    target = fact_target(spark, sf).withColumn(DELETED, gone)
    return fact_merge(target, x.order_delta(spark, sf), ["orderkey"], x.stamp(x.NOW_DELTA))


def _deleted_sql(gone: str, take: str | None) -> str:
    """Merge (or only the delete step, without ``take``) followed by the soft delete."""
    cols = [c for c in _F if c not in ("__ModifiedDatetimeUTC", "__DeletedDatetimeUTC")]
    body = pick(cols, take) if take else ", ".join(f"t.{c}" for c in cols)
    moved = f"CASE WHEN {take} THEN s.__ModifiedDatetimeUTC ELSE t.__ModifiedDatetimeUTC END" if take else "t.__ModifiedDatetimeUTC"
    return f"""
    SELECT {body},
      CASE WHEN {gone} THEN TIMESTAMP '{x.NOW_DELTA}' ELSE {moved} END AS __ModifiedDatetimeUTC,
      CASE WHEN {gone} THEN TIMESTAMP '{x.NOW_DELTA}' {"WHEN " + take + " THEN NULL" if take else ""}
           ELSE t.__DeletedDatetimeUTC END AS __DeletedDatetimeUTC
    FROM t {"FULL" if take else "LEFT"} JOIN s ON t.orderkey = s.orderkey"""


_GONE = "(s.orderkey IS NULL AND t.__DeletedDatetimeUTC IS NULL)"
_GONE_IN_SLICE = (
    "(s.orderkey IS NULL AND t.__DeletedDatetimeUTC IS NULL AND (t.yr, t.mon) IN (SELECT (yr, mon) FROM s))"
)


@query("fact_delete_full", with_ts(_T_FACT, _S_FACT) + _deleted_sql(_GONE, None))
def fact_delete_full(spark, sf):
    return fact_soft_delete(fact_target(spark, sf), x.order_delta(spark, sf), ["orderkey"], x.stamp(x.NOW_DELTA))


@query("fact_delete_filtered", with_ts(_T_FACT, _S_FACT) + _deleted_sql(_GONE_IN_SLICE, None))
def fact_delete_filtered(spark, sf):
    return fact_soft_delete(
        fact_target(spark, sf), x.order_delta(spark, sf), ["orderkey"], x.stamp(x.NOW_DELTA), ["yr", "mon"]
    )


@query("fact_load_filtered", with_ts(_T_FACT, _S_FACT) + _deleted_sql(_GONE_IN_SLICE, f"({TAKE})"))
def fact_load_filtered(spark, sf):
    """Merge and slice-wise soft delete in one join."""
    return fact_merge(
        fact_target(spark, sf),
        x.order_delta(spark, sf),
        ["orderkey"],
        x.stamp(x.NOW_DELTA),
        delete="filtered",
        filter_cols=["yr", "mon"],
    )


_FACT_LINE = ["orderkey", "linenumber", "price", "flag"]


def _lines(spark, sf, final: bool):
    """Lines by (order, number): as ordered without return flag, then as shipped."""
    lines = x.table(spark, sf, "lineitem")
    if final:
        lines = lines.where(F.col("l_linestatus") == "F")
    last = keep_last(
        lines.select(
            F.col("l_orderkey").alias("orderkey"),
            F.col("l_linenumber").alias("linenumber"),
            F.col("l_extendedprice").cast("decimal(15,2)").alias("price"),
            (F.col("l_returnflag") if final else F.lit("N")).alias("flag"),
            "l_shipdate",
        ),
        ["orderkey", "linenumber"],
        ["l_shipdate", "price", "flag"],
    ).drop("l_shipdate")
    hashed = row_hash(last, mode="concat")
    return x.delta_lineage(hashed, "line") if final else x.base_lineage(hashed, "line")


def _lines_sql(final: bool) -> str:
    flag = "l_returnflag" if final else "'N'"
    return f"""
      SELECT {", ".join(_FACT_LINE)}, {x.hash_sql(_FACT_LINE)}, {x.lineage_sql("line", 2 if final else 1)}, {_NOT_DELETED}
      FROM (SELECT l_orderkey AS orderkey, l_linenumber AS linenumber,
                   CAST(l_extendedprice AS DECIMAL(15,2)) AS price, {flag} AS flag,
                   row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
                     CAST(l_extendedprice AS DECIMAL(15,2)) DESC, {flag} DESC) AS rn
            FROM lineitem {"WHERE l_linestatus = 'F'" if final else ""}) WHERE rn = 1"""


@query(
    "fact_two_part_key",
    f"""{with_ts(_lines_sql(False), _lines_sql(True))}
    SELECT {pick([*_FACT_LINE, "__HashDiff", *x.LINEAGE_COLS, "__DeletedDatetimeUTC"])}
    FROM t FULL JOIN s ON t.orderkey = s.orderkey AND t.linenumber = s.linenumber""",
)
def fact_two_part_key(spark, sf):
    target = _lines(spark, sf, False).withColumn(DELETED, F.lit(None).cast("timestamp_ntz"))
    return fact_merge(target, _lines(spark, sf, True), ["orderkey", "linenumber"], x.stamp(x.NOW_DELTA))


@query(
    "fact_fold",
    f"""WITH {x.NUMBERED_YEARS_SQL},
    c AS (SELECT *, lag(__HashDiff) OVER w AS ph, lag(seq) OVER w AS ps, max(seq) OVER (PARTITION BY custkey) AS hi,
                 (SELECT max(seq) FROM n) AS final FROM n WINDOW w AS (PARTITION BY custkey ORDER BY seq)),
    r AS (SELECT *, row_number() OVER (PARTITION BY custkey ORDER BY seq DESC) AS rn FROM c
          WHERE ps IS NULL OR ps <> seq - 1 OR ph <> __HashDiff)
    SELECT {", ".join(c for c in CUSTOMER if c != "__ModifiedDatetimeUTC")},
           CASE WHEN hi < final THEN TIMESTAMP '2023-03-01 00:00:00' ELSE __ModifiedDatetimeUTC END AS __ModifiedDatetimeUTC,
           CASE WHEN hi < final THEN TIMESTAMP '2023-03-01 00:00:00' END AS __DeletedDatetimeUTC
    FROM r WHERE rn = 1""",
)
def fact_fold_query(spark, sf):
    """All yearly extracts with soft delete and return of vanished customers, in one pass."""
    return fact_fold(
        None,
        x.customer_years(spark, sf),
        ["custkey"],
        x.stamp("2023-03-01 00:00:00"),
        snapshots=x.customer_files(spark, sf),
        **UNIQUE,
    )


# ---- union of drifting files ---------------------------------------------------------


@query(
    "union_drifting_files",
    """SELECT CAST(n_nationkey AS BIGINT) AS key, n_name AS name, n_regionkey AS region, NULL AS balance FROM nation
    UNION ALL SELECT CAST(r_regionkey AS BIGINT), r_name, NULL, NULL FROM region
    UNION ALL SELECT s_suppkey, s_name, NULL, CAST(s_acctbal AS DECIMAL(15,2)) FROM supplier""",
)
def union_drifting_files(spark, sf):
    return union_drifting(
        [
            x.table(spark, sf, "nation").toDF("key", "name", "region"),
            x.table(spark, sf, "region").toDF("key", "name"),
            x.table(spark, sf, "supplier").select(
                F.col("s_suppkey").alias("key"),
                F.col("s_name").alias("name"),
                F.col("s_acctbal").cast("decimal(15,2)").alias("balance"),
            ),
        ]
    )
