"""Inputs of the registered queries: a catalogue and customer feeds derived from ``part``, and text copies of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CATALOGUE_SQL = """
SELECT p_partkey AS src_id,
 CAST(p_partkey + 6290000000000 AS STRING) AS barcode,
 upper(concat(replace(p_brand,'#',''),' ',p_name,' ',CAST(p_size AS STRING),'G')) AS material_name,
 upper(replace(p_brand,'#','')) AS brand, p_type AS category, CAST(p_size AS DOUBLE) AS weight
FROM part
"""

CUSTOMERS_SQL = """
SELECT p_partkey AS row_id,
 CASE p_partkey % 3 WHEN 0 THEN 'CUST_A' WHEN 1 THEN 'CUST_B' ELSE 'CUST_C' END AS source_customer,
 CASE WHEN p_partkey % 5 < 2 THEN concat('0', CAST(p_partkey + 6290000000000 AS STRING), '.0')
      WHEN p_partkey % 5 = 2 THEN 'nan' ELSE NULL END AS barcode,
 CASE WHEN p_partkey % 4 = 0 THEN upper(concat(p_name,' ',replace(p_brand,'#',''),' ',CAST(p_size AS STRING),' GM'))
      WHEN p_partkey % 4 = 1 THEN lower(concat(replace(p_brand,'#',''),'  ',p_name,' ',CAST(p_size AS STRING),'g'))
      ELSE upper(concat(replace(p_brand,'#',''),' ',p_name,' ',CAST(p_size + (p_partkey % 2) AS STRING),'G X 12')) END AS material_name,
 replace(p_brand,'#','') AS brand
FROM part WHERE p_partkey % 7 <> 0
"""

#: Orders as text, in the mixed formats that feeds have.
ORDERS_TEXT_SQL = """
SELECT o_orderkey,
 CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
   WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 3 THEN ' NULL ' ELSE strftime(o_orderdate, '%Y.%m.%d') END AS order_date,
 CASE o_orderkey % 4 WHEN 0 THEN concat('(', CAST(o_custkey AS VARCHAR), ')') WHEN 1 THEN concat(CAST(o_custkey AS VARCHAR), '-')
   WHEN 2 THEN concat(' 1,', lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0'), ' ') ELSE '' END AS amount,
 CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y%m') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') ELSE '1999-13' END AS month_text,
 concat(' 00', CAST(o_custkey AS VARCHAR), '.00 ') AS vendor
FROM orders
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_sql(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """A SQL text over the parquet tables, bound as parameters instead of global views."""
    return spark.sql(_bound(sql, tables), **{t: table(spark, sf_dir, t) for t in tables})


def _bound(sql: str, tables: tuple[str, ...]) -> str:
    for t in tables:
        sql = sql.replace(f"FROM {t}", "FROM {" + t + "}")
    return sql


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_sql(spark, sf_dir, CATALOGUE_SQL, "part")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_sql(spark, sf_dir, CUSTOMERS_SQL, "part")


def orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = ORDERS_TEXT_SQL.replace("VARCHAR", "STRING").replace("strftime(", "date_format(")
    for ours, theirs in (("%m", "MM"), ("%d", "dd"), ("%Y", "yyyy"), ("%H:", "HH:"), (":%M:", ":mm:"), ("%S", "ss")):
        sql = sql.replace(ours, theirs)
    return from_sql(spark, sf_dir, sql, "orders")
