"""How the given tables stand in for acquisition data.

Every adapter keeps all rows.  Volumes have a fixed number of traces, so a
volume stays bounded however large the table is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions import arrays
from lacuna.plans.registry import table

TRACES_PER_VOLUME = 64
NY = NZ = 8


def raw_traces(spark: SparkSession, folder: str) -> DataFrame:
    """One interleaved trace per embedding: 32 complex points."""
    return table(spark, folder, "embeddings").select(
        F.floor(F.col("vec_id") / TRACES_PER_VOLUME).cast("int").alias("volume"),
        (F.col("vec_id") % TRACES_PER_VOLUME).cast("int").alias("trace"),
        F.col("embedding").alias("samples"),
    )


def traces(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_traces(spark, folder)
    return raw.select("volume", "trace",
                      arrays.decode_interleaved(F.col("samples"), "re").alias("re"),
                      arrays.decode_interleaved(F.col("samples"), "im").alias("im"))


def slices(spark: SparkSession, folder: str) -> DataFrame:
    """One real 8 x 8 slice per embedding, column-major."""
    return table(spark, folder, "embeddings").select(
        F.col("label").alias("volume"), F.col("vec_id").alias("slice"),
        F.col("embedding").cast("array<double>").alias("re"))


def complex_slices(spark: SparkSession, folder: str) -> DataFrame:
    """The slice and its mirror as real and imaginary planes."""
    return slices(spark, folder).withColumn("im", F.reverse("re"))


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """One magnitude sample per line item on a 64 x 32 x 32 grid."""
    return table(spark, folder, "lineitem").select(
        F.col("l_linenumber").alias("volume"),
        (F.col("l_orderkey") % 64).cast("int").alias("slice"),
        (F.col("l_partkey") % 32).cast("int").alias("y"),
        (F.col("l_suppkey") % 32).cast("int").alias("z"),
        F.col("l_extendedprice").alias("magnitude"),
        (F.col("l_quantity") > 25).alias("acquired"),
    )


# The same adapters as SQL fragments for the twins.
TRACE_SQL = """(SELECT CAST(vec_id // 64 AS INTEGER) AS volume, CAST(vec_id % 64 AS INTEGER) AS trace,
  [CAST(embedding[2*i+1] AS DOUBLE) FOR i IN range(32)] AS re,
  [CAST(embedding[2*i+2] AS DOUBLE) FOR i IN range(32)] AS im FROM embeddings)"""
POINT_SQL = """(SELECT CAST(vec_id // 64 AS INTEGER) AS volume, CAST(vec_id % 64 AS INTEGER) AS trace, CAST(i AS INTEGER) AS x,
  CAST(embedding[2*i+1] AS DOUBLE) AS re, CAST(embedding[2*i+2] AS DOUBLE) AS im
  FROM embeddings, (SELECT unnest(range(32)) AS i))"""
VOXEL_SQL = """(SELECT label AS volume, vec_id AS slice, CAST(p % 8 AS INTEGER) AS y, CAST(p // 8 AS INTEGER) AS z,
  CAST(p AS INTEGER) AS pos, CAST(embedding[p+1] AS DOUBLE) AS re, CAST(embedding[64-p] AS DOUBLE) AS im
  FROM embeddings, (SELECT unnest(range(64)) AS p))"""
SAMPLE_SQL = """(SELECT l_linenumber AS volume, CAST(l_orderkey % 64 AS INTEGER) AS slice, CAST(l_partkey % 32 AS INTEGER) AS y,
  CAST(l_suppkey % 32 AS INTEGER) AS z, l_extendedprice AS magnitude, l_quantity > 25 AS acquired FROM lineitem)"""
