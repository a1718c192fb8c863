"""Queries that read block files: the traces are written as files first, then scanned."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.plans import adapters as ad
from lacuna.plans.registry import query
from lacuna.session import work_dir
from lacuna.sources import blocks as bf
from lacuna.sources.blocks import register
from lacuna.streaming.volumes import growing_blocks, process_volumes

FLOAT_READY = 0b1001  # data present, single precision


def write_block_files(spark: SparkSession, folder: str) -> str:
    """One block file per volume of the adapter, each written by the task that holds it."""
    target = work_dir(spark, "blocks")
    system, inner = bf.filesystem(target)
    system.create_dir(inner, recursive=True)

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("trace")
        pairs = np.stack(pdf["samples"].to_numpy()).astype(">f4")
        trace_bytes = pairs.shape[1] * 4
        block_bytes = bf.BLOCK_HEADER.size + len(pairs) * trace_bytes
        system, inner = bf.filesystem(f"{target}/v{int(pdf['volume'].iloc[0])}.fid")
        with system.open_output_stream(inner) as out:
            out.write(bf.FILE_HEADER.pack(1, len(pairs), pairs.shape[1], 4, trace_bytes, block_bytes, 0, FLOAT_READY, 1))
            out.write(bf.BLOCK_HEADER.pack(1, 1, 1, 0, 1, 0.0, 0.0, 0.0, 0.0))
            out.write(pairs.tobytes())
        return pdf.iloc[:1][["volume"]]

    # the adapter gives every volume at most 64 traces
    ad.raw_traces(spark, folder).groupBy("volume").applyInPandas(write, "volume int").write.format("noop").mode("overwrite").save()
    return target


def with_volume(rows: DataFrame) -> DataFrame:
    return rows.withColumn("volume", F.regexp_extract("path", r"/v([0-9]+)\.fid$", 1).cast("int"))


@query(f"SELECT volume, trace, x, re, im FROM {ad.POINT_SQL}")
def block_file_scan(spark: SparkSession, folder: str) -> DataFrame:
    register(spark)
    rows = with_volume(spark.read.format("lacuna_blocks").load(write_block_files(spark, folder)))
    return rows.select("volume", "trace", F.posexplode(F.arrays_zip("re", "im")).alias("x", "v")).select(
        "volume", "trace", "x", "v.re", "v.im")


@query(f"""SELECT volume, CAST(traces AS INTEGER) AS ntraces, 64 AS npoints, 32 + 28 + traces * 256 AS file_bytes, true AS has_data
  FROM (SELECT volume, count(*) AS traces FROM {ad.TRACE_SQL} GROUP BY volume)""")
def block_file_headers(spark: SparkSession, folder: str) -> DataFrame:
    register(spark)
    target = write_block_files(spark, folder)
    read = lambda table: spark.read.format("lacuna_blocks").option("table", table).load(target)
    blocks = read("block_header").select("path", "has_data")
    return with_volume(read("file_header").join(blocks, "path")).select("volume", "ntraces", "npoints", "file_bytes", "has_data")


@query(f"""SELECT volume, count(*) AS traces, sum(round(re[1] * 1000000)) AS first_points FROM {ad.TRACE_SQL} GROUP BY volume""")
def stream_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Ready blocks of a folder of files as a stream, each volume through one batch job."""
    source, out = write_block_files(spark, folder), work_dir(spark, "volumes")
    job = lambda rows: rows.groupBy("path", "block").agg(
        F.count(F.lit(1)).alias("traces"), F.sum(F.round(F.get("re", 0) * 1000000)).alias("first_points"))
    process_volumes(growing_blocks(spark, source), job, out, work_dir(spark, "checkpoint")).awaitTermination()
    return with_volume(spark.read.option("basePath", out).parquet(out)).select("volume", "traces", "first_points")
