"""Exports that stop half way, go on, and are read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.plans.registry import query
from lacuna.plans.transforms import dft3_sql, idft3_sql, stacked
from lacuna.session import work_dir
from lacuna.sources import exports as ex

SHAPE = (8, 8, 8)
REDUCTIONS = (ex.Reduction("half", 2.0), ex.Reduction("quarter", 4.0), ex.Reduction("most", 1.25))


def _twin(r: ex.Reduction) -> str:
    n = r.dims(SHAPE)[0]
    low, high = 4 - n // 2, 4 + n // 2 - 1
    inside = " AND ".join(f"{k} BETWEEN {low} AND {high}" for k in ("kx", "ky", "kz"))
    cropped = f"(SELECT volume, kx - {low} AS kx, ky - {low} AS ky, kz - {low} AS kz, re, im FROM {dft3_sql()} WHERE {inside})"
    return (f"SELECT '{r.name}' AS name, volume, x, CAST(y + {n} * z AS INTEGER) AS pos, round(sqrt(re * re + im * im), 7) AS magnitude "
            f"FROM {idft3_sql(cropped, n)}")


@query(" UNION ALL ".join(map(_twin, REDUCTIONS)))
def reduction_export(spark: SparkSession, folder: str) -> DataFrame:
    """The first run takes five volumes, the second dies before its markers, the third does the rest."""
    out = work_dir(spark, "exports")
    slices = stacked(spark, folder)
    ex.export_reductions(slices, SHAPE, REDUCTIONS, out, limit=5)
    ex.write_reduction(slices, SHAPE, out, REDUCTIONS[1])
    ex.export_reductions(slices, SHAPE, REDUCTIONS, out)
    parts = [ex.read_reduction(spark, out, r.name).select(F.lit(r.name).alias("name"), "volume", "x", "pos",
                                                           F.round("magnitude", 7).alias("magnitude")) for r in REDUCTIONS]
    return reduce(DataFrame.union, parts)


@query("""SELECT name, CAST(embed AS BIGINT) AS volume, name || '_m' || lpad(CAST(embed AS VARCHAR), CAST(greatest(2, length(CAST(embed AS VARCHAR))) AS INTEGER), '0') AS volume_id,
  factor, n AS nx, n AS ny, n AS nz, CAST(n * n * n AS BIGINT) AS samples FROM (SELECT DISTINCT vec_id // 8 AS embed FROM embeddings),
  (VALUES ('half', 2.0::DOUBLE, 4), ('quarter', 4.0::DOUBLE, 2)) f(name, factor, n)""")
def reduction_markers(spark: SparkSession, folder: str) -> DataFrame:
    """What a run that found all its outputs done leaves as it is."""
    out = work_dir(spark, "exports")
    slices = stacked(spark, folder)
    ex.export_reductions(slices, SHAPE, REDUCTIONS[:1], out)
    ex.export_reductions(slices, SHAPE, REDUCTIONS[:2], out)
    return ex.export_reductions(slices, SHAPE, REDUCTIONS[:2], out).drop("part")
