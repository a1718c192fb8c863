"""Queries on global scale, histograms, profiles and bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions import kernels
from lacuna.functions.arrays import map_arrays
from lacuna.functions.joins import measured_join, settle
from lacuna.operators import acquisition as acq
from lacuna.operators import scaling as sc
from lacuna.plans import adapters as ad
from lacuna.plans.registry import query

CENTS_SQL = (f"(SELECT volume, slice, y, z, acquired, CAST(round(magnitude * 100) AS BIGINT) AS magnitude FROM {ad.SAMPLE_SQL})")
LENGTHS = {"slice": 64, "y": 32, "z": 32}


def cents(spark: SparkSession, folder: str) -> DataFrame:
    """Magnitudes as whole cents, so that every sum is exact."""
    return ad.samples(spark, folder).withColumn("magnitude", F.round(F.col("magnitude") * 100).cast("bigint"))


# ---------------------------------------------------------------- flagship

IMAGE_SQL = f"""(SELECT volume, trace, k AS x, round(sqrt(sre * sre + sim * sim), 6) AS magnitude FROM (
  SELECT volume, trace, CAST(k AS INTEGER) AS k,
    sum(re * cos(2 * pi() * (k - 16) * (x - 16) / 32) - im * sin(2 * pi() * (k - 16) * (x - 16) / 32)) / 32 AS sre,
    sum(re * sin(2 * pi() * (k - 16) * (x - 16) / 32) + im * cos(2 * pi() * (k - 16) * (x - 16) / 32)) / 32 AS sim
  FROM {ad.POINT_SQL}, (SELECT unnest(range(32)) AS k) GROUP BY volume, trace, k))"""


def readout_image(traces: DataFrame) -> DataFrame:
    """Magnitude after the inverse FFT along the sampled axis, one row per point."""

    def invert(block):
        out = kernels.readout_ifft(block["re"] + 1j * block["im"])
        return {"magnitude": abs(out)}

    images = map_arrays(traces, invert, ("re", "im"), "magnitude array<double>", ("volume", "trace"))
    return (images.select("volume", "trace", F.posexplode("magnitude").alias("x", "magnitude"))
            .withColumn("magnitude", F.round("magnitude", 6)))


@query(f"""WITH img AS (SELECT * FROM {IMAGE_SQL}),
  first AS (SELECT * FROM img WHERE volume = (SELECT min(volume) FROM img)),
  top AS (SELECT max(magnitude) AS s FROM first),
  hist AS (SELECT least(floor(magnitude / (s / 255)), 254) AS bin, count(*) AS n FROM first, top GROUP BY 1),
  cum AS (SELECT bin, sum(n) OVER (ORDER BY bin) AS c, sum(n) OVER () AS total FROM hist),
  cut AS (SELECT 65535.0::DOUBLE / ((min(bin) + 0.5) * (SELECT s / 255 FROM top)) AS scale FROM cum WHERE c > 0.9995::DOUBLE * total)
SELECT volume, trace, x, CAST(least(floor(magnitude * scale + 0.5), 65535) AS INTEGER) AS value FROM img, cut""")
def output_scale(spark: SparkSession, folder: str) -> DataFrame:
    """16-bit output of all volumes, scaled by the first volume's histogram cut-off."""
    traces = ad.traces(spark, folder)
    first = readout_image(traces.where(F.col("volume") == traces.agg(F.min("volume")).scalar()))
    topped = first.withColumn("top", first.agg(F.max("magnitude")).scalar())
    cut = sc.histogram_cutoff(sc.histogram(topped, [], "magnitude", "top"), [], "top")
    return readout_image(traces).select("volume", "trace", "x",
                        sc.scaled(F.col("magnitude"), cut.select("scale").scalar()).alias("value"))


# ---------------------------------------------------------------- maxima, quantiles, scale


@query(f"SELECT volume, slice, max(magnitude) AS slice_max FROM {ad.SAMPLE_SQL} GROUP BY volume, slice")
def magnitude_max(spark: SparkSession, folder: str) -> DataFrame:
    return sc.slice_max(ad.samples(spark, folder))


@query(f"SELECT volume, max(magnitude) AS volume_max FROM {ad.SAMPLE_SQL} GROUP BY volume")
def volume_max(spark: SparkSession, folder: str) -> DataFrame:
    return ad.samples(spark, folder).groupBy("volume").agg(F.max("magnitude").alias("volume_max"))


QUANTILE_SQL = """WITH m AS (SELECT volume, slice, CAST(max(magnitude) AS DOUBLE) AS v FROM {src} GROUP BY 1, 2),
  r AS (SELECT volume, v, row_number() OVER (PARTITION BY volume ORDER BY v) AS r, count(*) OVER (PARTITION BY volume) AS n FROM m),
  q AS (SELECT *, least(greatest({p}::DOUBLE * n + 0.5::DOUBLE, 1.0::DOUBLE), CAST(n AS DOUBLE)) AS q FROM r),
  e AS (SELECT volume, max(v) FILTER (WHERE r = floor(q)) AS lo, max(v) FILTER (WHERE r = ceil(q)) AS hi, max(q) AS q FROM q GROUP BY volume),
  out AS (SELECT volume, lo + (q - floor(q)) * (hi - lo) AS quantile FROM e)"""


@query(QUANTILE_SQL.format(src=CENTS_SQL, p=0.9) + " SELECT volume, quantile, 65535.0::DOUBLE / quantile AS scaling FROM out")
def matlab_quantile(spark: SparkSession, folder: str) -> DataFrame:
    maxima = sc.slice_max(cents(spark, folder))
    q = sc.midpoint_quantile(maxima, ["volume"], "slice_max", 0.9)
    return q.withColumn("scaling", sc.scale_from_quantile(F.col("quantile")))


@query(QUANTILE_SQL.format(src=CENTS_SQL, p=0.9995) + f""",
  first AS (SELECT 65535.0::DOUBLE / quantile AS scaling FROM out WHERE volume = 1),
  peak AS (SELECT volume, max(v) AS peak FROM m GROUP BY volume)
SELECT volume, peak, CASE WHEN volume = 1 THEN 32.0::DOUBLE * 65535 / (SELECT scaling FROM first) ELSE 32.0::DOUBLE * peak END AS volume_scale FROM peak""")
def volume_scales(spark: SparkSession, folder: str) -> DataFrame:
    maxima = sc.slice_max(cents(spark, folder))
    quantile = sc.midpoint_quantile(maxima, ["volume"], "slice_max", sc.KEEP_SHARE).where("volume = 1")
    study = quantile.select(sc.scale_from_quantile(F.col("quantile"))).scalar()
    peaks = maxima.groupBy("volume").agg(F.max("slice_max").cast("double").alias("peak"))
    return peaks.withColumn("volume_scale", sc.volume_scale(F.col("peak"), 32, 32, F.col("volume") == 1, study))


# ---------------------------------------------------------------- profiles and bounds

PROFILE_SQL = f"""(SELECT volume, CASE WHEN slice IS NOT NULL THEN 'slice' WHEN y IS NOT NULL THEN 'y' ELSE 'z' END AS axis,
  coalesce(slice, y, z) AS i, CAST(sum(magnitude) AS DOUBLE) / count(*) AS mean_value
  FROM {CENTS_SQL} GROUP BY GROUPING SETS ((volume, slice), (volume, y), (volume, z)))"""


@query(f"SELECT * FROM {PROFILE_SQL}")
def axis_projections(spark: SparkSession, folder: str) -> DataFrame:
    return sc.axis_profiles(cents(spark, folder))


@query(f"SELECT volume, axis, arg_min(i, [mean_value, i]) AS arg_min, min(mean_value) AS min_value FROM {PROFILE_SQL} GROUP BY volume, axis")
def profile_argmin(spark: SparkSession, folder: str) -> DataFrame:
    return sc.profile_argmin(sc.axis_profiles(cents(spark, folder)))


@query(f"""WITH p AS (SELECT volume, axis, i, mean_value AS m, CASE axis WHEN 'slice' THEN 64 ELSE 32 END AS n FROM {PROFILE_SQL}),
  r AS (SELECT *, n // 2 AS h, CASE WHEN axis = 'slice' THEN i ELSE (i + n // 2) % n END + 1 AS p FROM p),
  f AS (SELECT volume, axis, arg_min(p, [m, p]) AS f, min(m) AS lowest FROM r GROUP BY 1, 2),
  s AS (SELECT r.*, lowest, h - CASE WHEN f + h - 1 > n THEN f + h - 1 - n ELSE f + h - 1 END AS s0 FROM r JOIN f ON r.volume = f.volume AND r.axis = f.axis),
  j AS (SELECT *, (p - 1 + s0 + n) % n + 1 AS j FROM s),
  e AS (SELECT volume, axis, max(n) AS n, max(h) AS h, max(s0) AS s0,
    coalesce(max(j) FILTER (WHERE m < 1.2::DOUBLE * lowest AND j <= floor(n / 3.0 + 0.5)), 1) AS lo,
    coalesce(min(j) FILTER (WHERE m < 1.2::DOUBLE * lowest AND j >= floor(2 * n / 3.0 + 0.5) + 1), max(n)) AS hi FROM j GROUP BY 1, 2),
  c AS (SELECT *, floor((hi - lo) / 2.0 + lo + 0.5) - s0 AS c0 FROM e),
  d AS (SELECT *, CAST(CASE WHEN c0 > n THEN c0 - n ELSE c0 END AS BIGINT) AS centre FROM c)
SELECT volume, axis, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi, centre, h - centre AS roll,
  CASE WHEN centre + 1 - h < 0 THEN centre + 1 - h + n ELSE centre + 1 - h END AS corner FROM d""")
def object_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return sc.object_bounds(sc.axis_profiles(cents(spark, folder)), LENGTHS)


# ---------------------------------------------------------------- histograms and cut-offs

TOP_SQL = f"(SELECT c.*, t.top FROM {CENTS_SQL} c JOIN (SELECT volume, CAST(max(magnitude) * 9 // 10 AS BIGINT) AS top FROM {CENTS_SQL} GROUP BY volume) t ON c.volume = t.volume)"
HIST_SQL = f"""(SELECT volume, top, CAST(least(floor(magnitude / (top / 255.0::DOUBLE)), 254) AS BIGINT) AS bin, count(*) AS voxels
  FROM {TOP_SQL} WHERE magnitude <= top GROUP BY 1, 2, 3)"""


def _topped(spark: SparkSession, folder: str) -> DataFrame:
    """A scale under the volume maximum, so that some voxels are out of range."""
    voxels = cents(spark, folder)
    tops = settle(voxels.groupBy("volume").agg(F.floor(F.max("magnitude") * 9 / 10).alias("top")))
    return measured_join(voxels, tops, ["volume"])


@query(f"SELECT * FROM {HIST_SQL}")
def hist255(spark: SparkSession, folder: str) -> DataFrame:
    return sc.histogram(_topped(spark, folder), ["volume"], "magnitude", "top")


@query(f"""WITH c AS (SELECT volume, top, bin, sum(voxels) OVER (PARTITION BY volume ORDER BY bin) AS cum, sum(voxels) OVER (PARTITION BY volume) AS total FROM {HIST_SQL}),
  b AS (SELECT volume, top, min(bin) AS cut_bin FROM c WHERE cum > 0.9995::DOUBLE * total GROUP BY 1, 2)
SELECT volume, cut_bin, (cut_bin + 0.5::DOUBLE) * (top / 255.0::DOUBLE) AS cut_value, 65535.0::DOUBLE / ((cut_bin + 0.5::DOUBLE) * (top / 255.0::DOUBLE)) AS scale FROM b""")
def hist_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    return sc.histogram_cutoff(sc.histogram(_topped(spark, folder), ["volume"], "magnitude", "top"), ["volume"], "top")


RANK_SQL = f"""(SELECT volume, magnitude AS cut_value, 65535.0::DOUBLE / magnitude AS scale FROM (SELECT volume, magnitude,
  row_number() OVER (PARTITION BY volume ORDER BY magnitude) AS r, count(*) OVER (PARTITION BY volume) AS n FROM {ad.SAMPLE_SQL})
  WHERE r = floor(n * 0.9995::DOUBLE + 0.5::DOUBLE))"""


@query(f"SELECT * FROM {RANK_SQL}")
def rank_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    return sc.rank_cutoff(ad.samples(spark, folder), ["volume"], "magnitude")


@query(f"""SELECT volume, slice, y, z, count(*) AS parts, CAST(sum(least(floor(magnitude * (SELECT scale FROM {RANK_SQL} WHERE volume = 1) + 0.5::DOUBLE), 65535)) AS BIGINT) AS value,
  CAST(max(least(floor(magnitude * (SELECT scale FROM {RANK_SQL} WHERE volume = 1) + 0.5::DOUBLE), 65535)) AS INTEGER) AS peak FROM {ad.SAMPLE_SQL} GROUP BY 1, 2, 3, 4""")
def scaled_output(spark: SparkSession, folder: str) -> DataFrame:
    """The first volume's factor on all volumes, clipped to 16 bits."""
    voxels = ad.samples(spark, folder)
    factor = sc.rank_cutoff(voxels.where("volume = 1"), [], "magnitude").select("scale").scalar()
    out = voxels.withColumn("value", sc.scaled(F.col("magnitude"), factor))
    return out.groupBy("volume", "slice", "y", "z").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("value").alias("value"), F.max("value").alias("peak"))


@query(f"""WITH b AS (SELECT volume, least(floor((magnitude - 500) / 500.0::DOUBLE), 999) AS bin, count(*) AS n FROM {ad.SAMPLE_SQL}
   WHERE magnitude BETWEEN 500 AND 500000 GROUP BY 1, 2),
  m AS (SELECT volume, bin, n, row_number() OVER (PARTITION BY volume ORDER BY n DESC, bin) AS r FROM b)
SELECT volume, CAST(bin AS BIGINT) AS mode_bin, n AS voxels, bin * 500.0::DOUBLE + 500.0::DOUBLE AS mode_value FROM m WHERE r = 1""")
def histogram_mode(spark: SparkSession, folder: str) -> DataFrame:
    return sc.histogram_mode(ad.samples(spark, folder), ["volume"], "magnitude", 500.0, 500.0, 1000)


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY volume ORDER BY magnitude DESC) AS r, count(*) OVER (PARTITION BY volume) AS n FROM {CENTS_SQL}),
  t AS (SELECT volume, max(magnitude) FILTER (WHERE r = floor(n * 0.05::DOUBLE)) AS t FROM r GROUP BY volume)
SELECT r.volume, slice, CAST(sum(CASE WHEN magnitude < t THEN 0 ELSE magnitude END) AS DOUBLE) AS kept_sum, count(*) FILTER (WHERE magnitude >= t) AS kept
FROM r JOIN t ON r.volume = t.volume GROUP BY r.volume, slice""")
def largest_fraction(spark: SparkSession, folder: str) -> DataFrame:
    kept = sc.keep_largest(cents(spark, folder), ["volume"], "magnitude", 0.05)
    return kept.groupBy("volume", "slice").agg(
        F.sum("magnitude").alias("kept_sum"), F.count_if(F.col("magnitude") > 0).alias("kept"))


@query(f"""WITH r AS (SELECT slice, pos, re, row_number() OVER (PARTITION BY slice ORDER BY abs(re) DESC) AS r FROM {ad.VOXEL_SQL}),
  t AS (SELECT slice, max(abs(re)) FILTER (WHERE r = 19) AS t FROM r GROUP BY slice)
SELECT r.slice, pos, CASE WHEN abs(re) < t THEN 0 ELSE re END AS value FROM r JOIN t ON r.slice = t.slice""")
def largest_fraction_slices(spark: SparkSession, folder: str) -> DataFrame:
    kept = sc.keep_largest_in(ad.slices(spark, folder), "re", 0.3, ("slice",))
    return kept.select("slice", F.posexplode("re").alias("pos", "value"))


@query(f"""WITH a AS (SELECT volume, slice, y + 32 * z AS pos, CAST(sum(magnitude) AS DOUBLE) AS v FROM {CENTS_SQL} WHERE acquired GROUP BY 1, 2, 3),
  g AS (SELECT volume, slice, p AS pos FROM (SELECT DISTINCT volume, slice FROM a), (SELECT unnest(range(1024)) AS p))
SELECT g.volume, g.slice, count(*) AS cells, count(*) FILTER (WHERE a.v IS NULL) AS zeros, sum(coalesce(a.v, 0)) AS total, sum(coalesce(a.v, 0) * g.pos) AS moment
FROM g LEFT JOIN a ON g.volume = a.volume AND g.slice = a.slice AND g.pos = a.pos GROUP BY 1, 2""")
def grid_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Acquired samples on the full grid, zeros restored, one row per slice."""
    acquired = (cents(spark, folder).where("acquired")
                .select("volume", "slice", (F.col("y") + 32 * F.col("z")).alias("pos"), F.col("magnitude").cast("double").alias("v")))
    grid = acq.merge_samples(acquired, ("volume", "slice"), "pos", ("v",), 1024)
    add = lambda f: F.aggregate(F.transform("v", f), F.lit(0.0), lambda a, x: a + x)
    return grid.select("volume", "slice", F.size("v").cast("bigint").alias("cells"),
                       F.size(F.filter("v", lambda x: x == 0)).cast("bigint").alias("zeros"),
                       add(lambda x: x).alias("total"), add(lambda x, i: x * i).alias("moment"))
