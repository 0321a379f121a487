"""How the driver's tables stand for the operators' relations, in Spark and in SQL.

lineitem's even orders are the seed and its odd ones the synthetic table. The synthetic side has prices raised by 15 % and a
return flag of its own on seventh lines, so drift has something to find; both have a column with nulls and one that is mostly zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Unique in lineitem at every size.
KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
CATEGORICAL = ("flag", "l_linestatus")
NUMERIC = ("l_quantity", "price", "l_discount", "tax_n", "zi")
QI = ("c_nationkey", "o_orderstatus", "o_orderpriority", "c_mktsegment")

BASE_SQL = """
base AS (SELECT *, nullif(l_tax, 0.0) AS tax_n, CASE WHEN l_discount < 0.06 THEN 0.0::DOUBLE ELSE l_quantity END AS zi FROM lineitem),
seed AS (SELECT *, l_extendedprice AS price, l_returnflag AS flag FROM base WHERE l_orderkey % 2 = 0),
synth AS (SELECT *, l_extendedprice * 1.15::DOUBLE AS price, CASE WHEN l_linenumber = 7 THEN 'X' ELSE l_returnflag END AS flag FROM base WHERE l_orderkey % 2 = 1)"""

PEOPLE_SQL = """
people AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
pseed AS (SELECT * FROM people WHERE o_orderkey % 2 = 0),
psynth AS (SELECT * FROM people WHERE o_orderkey % 2 = 1)"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "lineitem")
    return df.withColumn("tax_n", F.when(F.col("l_tax") != 0.0, F.col("l_tax"))).withColumn("zi", F.when(F.col("l_discount") < 0.06, 0.0).otherwise(F.col("l_quantity")))


def seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir).where("l_orderkey % 2 = 0").withColumn("price", F.col("l_extendedprice")).withColumn("flag", F.col("l_returnflag"))


def synth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir).where("l_orderkey % 2 = 1").withColumn("price", F.col("l_extendedprice") * 1.15).withColumn("flag", F.when(F.col("l_linenumber") == 7, "X").otherwise(F.col("l_returnflag")))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to so many digits, as a comparison with another engine's sums needs."""
    return df.select(*((F.round(F.col(c), digits) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))
