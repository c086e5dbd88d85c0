"""Unions and differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom import operators as ops
from cohortloom.queries.registry import Tables, query


@query("""
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
""")
def union_all(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return ops.union_all(customers, suppliers)


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t: Tables) -> DataFrame:
    return ops.union_distinct(
        t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(F.col("s_nationkey").alias("nation"))
    )


@query("SELECT n_nationkey FROM nation EXCEPT SELECT CASE WHEN s_acctbal > 8000 THEN s_nationkey ELSE -1 END FROM supplier")
def set_difference(t: Tables) -> DataFrame:
    rich = t.supplier.select(F.when(F.col("s_acctbal") > 8000, F.col("s_nationkey")).otherwise(-1).alias("s_nationkey"))
    return ops.set_difference(t.nation.select("n_nationkey"), rich)
