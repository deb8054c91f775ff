"""Row hashes and the way from raw rows to a merge source."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeload.functions import catalog_name, catalog_name_of, parse_columns, row_hash
from lakeload.operators import (
    complex_as_string,
    drop_null_keys,
    exclude,
    extract,
    prepare_source,
    underscore_names,
    with_lineage,
    with_partition_columns,
)
from registry import extracts as x
from registry import query

_C = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


@query("row_hash_concat", f"SELECT {', '.join(_C)}, {x.hash_sql(_C)} FROM customer")
def row_hash_concat(spark, sf):
    return row_hash(x.table(spark, sf, "customer").drop("c_acctbal"), mode="concat")


def safe_sql(cols: list[str]) -> str:
    parts = [
        f"coalesce('{len(c)}:{c}=' || length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '')" for c in sorted(cols)
    ]
    return f"sha256({' || '.join(parts)}) AS __HashDiff"


_D = ["doc_id", "lang", "source", "text", "quality"]


@query(
    "row_hash_safe",
    f"""SELECT {', '.join(_D)}, {safe_sql(_D)}
    FROM (SELECT d.doc_id, lang, source, text, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
)
def row_hash_safe(spark, sf):
    """Whole documents beside a label that is often NULL."""
    labels = x.table(spark, sf, "labels").select("doc_id", "quality")
    rows = x.table(spark, sf, "documents").select("doc_id", "lang", "source", "text").join(labels, "doc_id", "left")
    return row_hash(rows, mode="safe")


@query(
    "row_hash_json",
    """SELECT o_orderkey, o_custkey, o_orderstatus, sha256('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
    || CASE WHEN o_orderstatus = 'P' THEN '' ELSE ',"o_orderstatus":"' || o_orderstatus || '"' END || '}') AS __HashDiff
    FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus ELSE 'P' END AS o_orderstatus
          FROM orders)""",
)
def row_hash_json(spark, sf):
    """NULL fields are left out of the JSON text."""
    orders = x.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    blank = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    hashed = row_hash(orders.withColumn("o_orderstatus", blank), mode="json")
    return hashed.withColumn("o_orderstatus", F.coalesce("o_orderstatus", F.lit("P")))


@query(
    "extract_exclude",
    "SELECT o_orderkey AS id, upper(o_orderpriority) AS priority, year(o_orderdate) AS __year FROM orders",
)
def extract_exclude(spark, sf):
    text = "[o_orderkey] as id, [o_custkey], upper(concat(o_orderpriority, '')) as priority, o_totalprice, year(o_orderdate) as __year"
    picked = exclude(extract(x.table(spark, sf, "orders"), text), "[o_custkey], o_totalprice")
    return picked.withColumn("__year", F.col("__year").cast("long"))


@query(
    "partition_expr",
    """SELECT o_orderkey, o_orderdate, year(o_orderdate) AS __year, month(o_orderdate) AS __month,
    day(o_orderdate) AS __dayofmonth FROM orders""",
)
def partition_expr(spark, sf):
    orders = x.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    text = "year(o_orderdate) as __year, month(o_orderdate) as __month, dayofmonth(o_orderdate) as __dayofmonth"
    return with_partition_columns(orders, text)


@query(
    "bk_not_null",
    """SELECT * FROM (SELECT event_id, nullif(user_id, 3) AS user_id, nullif(event_type, 'error') AS event_type FROM events)
    WHERE user_id IS NOT NULL AND event_type IS NOT NULL""",
)
def bk_not_null(spark, sf):
    events = x.table(spark, sf, "events").select(
        "event_id",
        F.expr("nullif(user_id, 3L)").alias("user_id"),
        F.expr("nullif(event_type, 'error')").alias("event_type"),
    )
    return drop_null_keys(events, ["user_id", "event_type"])


@query("rename_spaces", "SELECT s_suppkey AS Supplier_Key, s_name AS Supplier_Name FROM supplier")
def rename_spaces(spark, sf):
    suppliers = x.table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return underscore_names(suppliers.toDF("Supplier Key", "Supplier Name"))


@query(
    "complex_as_string",
    """SELECT o_orderkey, '[' || o_orderkey || ', ' || o_custkey || ']' AS keys,
      '{' || o_custkey || ', ' || o_orderstatus || '}' AS span FROM orders""",
)
def complex_as_string_query(spark, sf):
    nested = x.table(spark, sf, "orders").select(
        "o_orderkey",
        F.array("o_orderkey", "o_custkey").alias("keys"),
        F.struct(F.col("o_custkey").alias("low"), F.col("o_orderstatus").alias("status")).alias("span"),
    )
    return complex_as_string(nested)


@query(
    "complex_as_json",
    """SELECT o_orderkey, '{"' || o_orderstatus || '":' || o_custkey || '}' AS by_status,
      '{"low":' || o_orderkey || '}' AS span FROM orders""",
)
def complex_as_json(spark, sf):
    nested = x.table(spark, sf, "orders").select(
        "o_orderkey",
        F.create_map("o_orderstatus", "o_custkey").alias("by_status"),
        F.struct(F.col("o_orderkey").alias("low")).alias("span"),
    )
    return complex_as_string(nested, "json")


@query(
    "embedding_as_string",
    "SELECT vec_id, label, len(embedding) AS dims FROM embeddings",
)
def embedding_as_string(spark, sf):
    """Vectors as text keep every element."""
    text = complex_as_string(x.table(spark, sf, "embeddings"))
    dims = F.size(F.split("embedding", ", ")).cast("long")
    return text.select("vec_id", "label", dims.alias("dims"))


@query(
    "attach_lineage_literals",
    f"""SELECT r_regionkey, r_name, {x.lineage_sql('region', 1)} FROM region""",
)
def attach_lineage_literals(spark, sf):
    return with_lineage(
        x.table(spark, sf, "region"),
        x.stamp(x.NOW_BASE),
        x.stamp(x.BASE_TS),
        "archive/region/1.parquet",
        "region1.parquet",
    )


_P = ["id", "order_date", "status", "yr"]


@query(
    "prepare_source",
    f"""SELECT {', '.join(_P)}, {x.hash_sql(['id', "strftime(order_date, '%Y-%m-%d')", 'status', 'yr'])}
    FROM (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS order_date,
                 nullif(o_orderstatus, 'P') AS status, CAST(year(o_orderdate) AS INTEGER) AS yr
          FROM orders) WHERE status IS NOT NULL""",
)
def prepare_source_query(spark, sf):
    """Select, exclude, rename, drop NULL keys and hash in one projection."""
    return prepare_source(
        x.table(spark, sf, "orders"),
        "o_orderkey as id, cast(o_orderdate as date) as `order date`, nullif(o_orderstatus, 'P') as status, o_custkey",
        parse_columns("[o_custkey]"),
        "year(`order date`) as yr",
        not_null_keys=["id", "status"],
        rename_spaces=True,
        hash_mode="concat",
    )


@query(
    "catalog_names",
    """SELECT url, 'archive_' || regexp_replace(trim(url, '/'), '[/\\\\-]', '_', 'g') AS name FROM pages""",
)
def catalog_names(spark, sf):
    """Catalog names of archive paths, as an expression over a column of paths."""
    expected = catalog_name("/source/data-set/")
    if expected != "archive_source_data_set":
        raise AssertionError(expected)
    return x.table(spark, sf, "pages").select("url", catalog_name_of(F.col("url")).alias("name"))
