"""The three source tables and a score table, derived from the driver's tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.config import Study, TimeSplit
from episodica.session import spread_by_size
from episodica.sources.tables import add_release_date

DRIVER_STUDY = Study(
    begin=date(1996, 1, 1),
    end=date(2001, 1, 1),
    horizon_days=60,
    splits=(
        TimeSplit(0, date(1996, 1, 1), date(1996, 12, 31), date(1998, 1, 1), date(1998, 12, 31)),
        TimeSplit(1, date(1997, 1, 1), date(1997, 12, 31), date(1999, 1, 1), date(1999, 12, 31)),
        TimeSplit(2, date(1998, 1, 1), date(1998, 12, 31), date(2000, 1, 1), date(2000, 12, 31)),
    ),
)


# Schemas of the tables read here, so that no job infers them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    spread_by_size(spark, path)
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def component(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item; keys repeat, so joins on them fan out."""
    lines, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    parts, suppliers = load(spark, sf_dir, "part"), load(spark, sf_dir, "supplier")
    joined = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
    )
    return joined.select(
        F.col("o_custkey").alias("person_id"),
        F.col("l_orderkey").alias("episode_id"),
        F.col("l_linenumber").alias("component_no"),
        F.when(F.col("l_returnflag") == "R", "FELON").otherwise("MISD").alias("severity"),
        F.col("o_orderdate").cast("date").alias("begin_date"),
        F.when(F.col("l_discount") >= 0.01, F.col("p_type")).alias("offense_code"),
        F.col("s_nationkey").cast("string").alias("county_code"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_felony"),
    )


def stay_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stay row per line item, with repeated keys."""
    lines, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    begin = F.col("o_orderdate").cast("date")
    days = F.col("l_quantity").cast("int")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("person_id"),
        F.col("l_orderkey").alias("episode_id"),
        F.col("l_linenumber").alias("component_no"),
        F.when(F.col("l_linestatus") == "F", F.date_add(begin, days)).alias("actual_end"),
        F.when(F.col("l_discount") >= 0.02, F.date_add(begin, days * 2)).alias("projected_end"),
    )


def stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stay row per (person, episode, component), with the release date.

    Line items are reduced per (order, line) before they meet their order, so
    an order with very many lines adds few rows to the join.
    """
    days = F.col("l_quantity").cast("int")
    lines = (
        load(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.max(F.when(F.col("l_linestatus") == "F", days)).alias("actual_days"),
            F.max(F.when(F.col("l_discount") >= 0.02, days * 2)).alias("projected_days"),
        )
    )
    orders = load(spark, sf_dir, "orders")
    begin = F.col("o_orderdate").cast("date")
    ended = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("person_id"),
        F.col("l_orderkey").alias("episode_id"),
        F.col("l_linenumber").alias("component_no"),
        F.date_add(begin, F.col("actual_days")).alias("actual_end"),
        F.date_add(begin, F.col("projected_days")).alias("projected_end"),
    )
    return add_release_date(ended)


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, nations = load(spark, sf_dir, "customer"), load(spark, sf_dir, "nation")
    regions = load(spark, sf_dir, "region")
    joined = customers.join(nations, customers.c_nationkey == nations.n_nationkey).join(
        regions, nations.n_regionkey == regions.r_regionkey
    )
    balance = F.col("c_acctbal")
    return joined.select(
        F.col("c_custkey").alias("person_id"),
        F.expr("date_add(date'1940-01-01', cast(c_custkey * 37 % 14000 as int))").alias("birth_date"),
        F.when(F.col("c_nationkey") % 9 == 0, "FEMALE").otherwise("MALE").alias("gender"),
        F.col("c_mktsegment").alias("race"),
        F.when(F.col("c_nationkey") % 5 != 4, F.col("r_name")).alias("ethnic"),
        F.when(balance >= 0, F.round(F.lit(60) + balance / 500, 2)).alias("height"),
        F.when(balance < 9000, F.round(F.lit(170) + balance / 50, 2)).alias("weight"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic score with many ties, a label and two group attributes."""
    orders, customers = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        F.col("o_orderkey").alias("key"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("label"),
        (F.floor(F.col("o_totalprice") / 1000) / 500).alias("score"),
        F.col("c_mktsegment").alias("race"),
        F.when(F.col("c_nationkey") % 9 == 0, "FEMALE").otherwise("MALE").alias("gender"),
    )
