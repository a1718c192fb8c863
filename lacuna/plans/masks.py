"""Queries on sampling masks, densities and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions import arrays
from lacuna.operators import masks as mk
from lacuna.plans import adapters as ad
from lacuna.plans.registry import query, table
from lacuna.plans.scaling import CENTS_SQL, cents

# mask text per embedding: exact, one short, or with trailing blanks
TEXT_SQL = """(SELECT vec_id AS mask_id, CASE vec_id % 3 WHEN 0 THEN t WHEN 1 THEN substr(t, 1, 63) ELSE t || '  ' END AS text
  FROM (SELECT vec_id, array_to_string([CASE WHEN v > 0 THEN '1' ELSE '0' END FOR v IN embedding], '') AS t FROM embeddings))"""
MARK_SQL = f"""(SELECT mask_id, pos, substr(text || repeat('0', 64), pos + 1, 1) = '1' AS acquired FROM {TEXT_SQL},
  (SELECT CAST(unnest(range(64)) AS INTEGER) AS pos))"""


def mask_texts(spark: SparkSession, folder: str) -> DataFrame:
    marks = F.array_join(F.transform("embedding", lambda v: F.when(v > 0, "1").otherwise("0")), "")
    emb = table(spark, folder, "embeddings").select(F.col("vec_id").alias("mask_id"), marks.alias("t"))
    kind = F.col("mask_id") % 3
    return emb.select("mask_id", F.when(kind == 0, F.col("t")).when(kind == 1, F.substring("t", 1, 63))
                      .otherwise(F.concat("t", F.lit("  "))).alias("text"))


@query(f"SELECT mask_id, pos, pos % 8 AS y, pos // 8 AS z, acquired FROM {MARK_SQL}")
def mask_parse(spark: SparkSession, folder: str) -> DataFrame:
    fixed = mask_texts(spark, folder).select("mask_id", mk.repair(F.col("text"), F.lit(8), F.lit(8)).alias("mask"))
    cells = fixed.select("mask_id", F.posexplode(F.split("mask", "")).alias("pos", "mark"))
    return cells.select("mask_id", "pos", (F.col("pos") % 8).alias("y"), F.floor(F.col("pos") / 8).cast("int").alias("z"),
                        (F.col("mark") == "1").alias("acquired"))


@query(f"""SELECT mask_id, CAST(row_number() OVER (PARTITION BY mask_id ORDER BY pos) - 1 AS INTEGER) AS rank, pos, pos % 8 AS y, pos // 8 AS z
  FROM {MARK_SQL} WHERE acquired""")
def mask_rank(spark: SparkSession, folder: str) -> DataFrame:
    fixed = mask_texts(spark, folder).select(
        "mask_id", mk.repair(F.col("text"), F.lit(8), F.lit(8)).alias("mask"), F.lit(8).alias("ny"))
    return mk.acquired_cells(fixed, ["mask_id"])


@query(f"""SELECT mask_id, length(text) - length(replace(text, '0', '')) AS zeros, length(text) - length(replace(text, '1', '')) AS ones,
  2 * length(text) - length(replace(text, '0', '')) - length(replace(text, '1', '')) AS marks, length(text) AS total,
  CASE WHEN contains(text, ' ') THEN 'unexpected characters' ELSE 'ok' END AS warning FROM {TEXT_SQL}""")
def mask_quality(spark: SparkSession, folder: str) -> DataFrame:
    return mask_texts(spark, folder).select("mask_id", *[
        c.cast("bigint").alias(n) if n != "warning" else c
        for n, c in zip(("zeros", "ones", "marks", "total", "warning"), mk.mask_report(F.col("text")))])


NAME_SQL = """(SELECT o_orderkey, concat(CASE o_orderkey % 4 WHEN 0 THEN 'CS' WHEN 1 THEN 'CSa' WHEN 2 THEN 'CStable' ELSE 'XX' END,
  64 * (1 + o_custkey % 4), CASE WHEN o_orderkey % 3 = 0 THEN concat('x', 32 * (1 + o_custkey % 3)) ELSE '' END, '_', 2 + 2 * (o_orderkey % 5),
  CASE WHEN o_orderkey % 7 = 0 THEN '.5' ELSE '' END, 'x_pa', 10 + o_custkey % 9, '_pb', 50 + o_orderkey % 6) AS name FROM orders)"""
NAME_PART = "regexp_extract(name, '" + mk.text.MASK_NAME + "', {})"
DECODED_SQL = f"""(SELECT o_orderkey, name, TRY_CAST({NAME_PART.format(1)} AS INTEGER) AS ny,
  coalesce(TRY_CAST(substr({NAME_PART.format(2)}, 2) AS INTEGER), TRY_CAST({NAME_PART.format(1)} AS INTEGER)) AS nz,
  TRY_CAST({NAME_PART.format(3)} AS DOUBLE) AS acceleration, TRY_CAST({NAME_PART.format(4)} AS DOUBLE) / 10 AS pa,
  TRY_CAST({NAME_PART.format(5)} AS DOUBLE) / 10 AS pb FROM {NAME_SQL})"""


def mask_names(spark: SparkSession, folder: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    prefix = F.element_at(F.array(*[F.lit(p) for p in ("CS", "CSa", "CStable", "XX")]), (k % 4 + 1).cast("int"))
    return table(spark, folder, "orders").select("o_orderkey", F.concat(
        prefix, 64 * (1 + c % 4), F.when(k % 3 == 0, F.concat(F.lit("x"), 32 * (1 + c % 3))).otherwise(""), F.lit("_"),
        2 + 2 * (k % 5), F.when(k % 7 == 0, ".5").otherwise(""), F.lit("x_pa"), 10 + c % 9, F.lit("_pb"), 50 + k % 6).alias("name"))


@query(f"SELECT * FROM {DECODED_SQL}")
def mask_name(spark: SparkSession, folder: str) -> DataFrame:
    return mk.decode_names(mask_names(spark, folder))


@query(f"""SELECT *, row_number() OVER (ORDER BY is_default, name) AS place FROM (SELECT DISTINCT name, ny, nz, acceleration, pa, pb, pa = 1.8::DOUBLE AND pb = 5.4::DOUBLE AS is_default FROM {DECODED_SQL}
  WHERE ny IS NOT NULL AND ny * nz / acceleration = 4096)""")
def mask_candidates(spark: SparkSession, folder: str) -> DataFrame:
    names = mask_names(spark, folder).select("name").distinct()
    return mk.candidate_masks(names, F.lit(4096), 1.8, 5.4)


# ---------------------------------------------------------------- scatter, gather, density

# one fixed mask for all volumes: every second diagonal of an 8 x 16 grid
SCATTER_SQL = "(SELECT CAST(row_number() OVER (ORDER BY pos) - 1 AS INTEGER) AS rank, pos, pos % 8 AS y, pos // 8 AS z FROM (SELECT CAST(unnest(range(128)) AS INTEGER) AS pos) WHERE (pos % 8 + pos // 8) % 2 = 0)"


def diagonal_mask(spark: SparkSession) -> DataFrame:
    text = spark.range(1).select(F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(127)), lambda p: F.when((p % 8 + F.floor(p / 8)) % 2 == 0, "1").otherwise("0")), "").alias("mask"),
        F.lit(8).alias("ny"))
    return mk.acquired_cells(text, [])


@query(f"""WITH t AS (SELECT volume, x, pos, re, im FROM {ad.POINT_SQL} p JOIN {SCATTER_SQL} m ON p.trace = m.rank),
  g AS (SELECT volume, x, pos FROM (SELECT DISTINCT volume, x FROM t), (SELECT CAST(unnest(range(128)) AS INTEGER) AS pos))
SELECT g.volume, g.x, g.pos, coalesce(t.re, 0) AS re, coalesce(t.im, 0) AS im FROM g LEFT JOIN t ON g.volume = t.volume AND g.x = t.x AND g.pos = t.pos""")
def mask_scatter(spark: SparkSession, folder: str) -> DataFrame:
    """Trace numbers are mask ranks: slices on the full grid with zeros restored."""
    from lacuna.operators.acquisition import explode_points, merge_samples

    points = explode_points(ad.traces(spark, folder)).withColumnRenamed("trace", "rank")
    placed = mk.scatter(points, diagonal_mask(spark), ["volume", "x"], 128)
    full = merge_samples(placed, ["volume", "x"], "pos", ("re", "im"), 128)
    return (full.select("volume", "x", F.posexplode(F.arrays_zip("re", "im")).alias("pos", "v"))
            .select("volume", "x", "pos", "v.re", "v.im"))


@query(f"""SELECT volume, slice, y, z, count(*) AS parts, CAST(sum(magnitude) AS BIGINT) AS total FROM {CENTS_SQL}
  WHERE (y + z) IN (SELECT s_suppkey % 32 FROM supplier WHERE s_acctbal > 0) GROUP BY 1, 2, 3, 4""")
def mask_gather(spark: SparkSession, folder: str) -> DataFrame:
    diagonals = table(spark, folder, "supplier").where("s_acctbal > 0").select((F.col("s_suppkey") % 32).cast("int").alias("d"))
    cells = mk.grid(diagonals.distinct().withColumn("n", F.lit(32)), F.col("n"), F.col("n")).where("y + z = d")
    kept = mk.gather(cents(spark, folder), cells, grid_cells=1024)
    return kept.groupBy("volume", "slice", "y", "z").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("magnitude").alias("total"))


@query(f"""SELECT volume, slice, count(*) AS cells, sum(round(magnitude / ((1 + y % 4) * (1 + z % 4) / 16.0::DOUBLE))) AS weighted
  FROM {CENTS_SQL} WHERE acquired GROUP BY 1, 2""")
def density_weight(spark: SparkSession, folder: str) -> DataFrame:
    density = mk.grid(spark.range(1).select(F.lit(32).alias("n")), F.col("n"), F.col("n")).select(
        "y", "z", ((1 + F.col("y") % 4) * (1 + F.col("z") % 4) / 16.0).alias("p"))
    weighted = mk.weight_by_density(cents(spark, folder).where("acquired"), density, ("magnitude",), 1024)
    return weighted.groupBy("volume", "slice").agg(
        F.count(F.lit(1)).alias("cells"), F.sum(F.round("magnitude_weighted")).alias("weighted"))


@query(f"""SELECT volume, slice, CAST(sum(CAST(acquired AS INTEGER)) AS BIGINT) AS sampled, CAST(sum(CAST(acquired AS INTEGER)) AS DOUBLE) / count(*) AS fraction,
  1 / nullif(CAST(sum(CAST(acquired AS INTEGER)) AS DOUBLE) / count(*), 0) AS acceleration FROM {ad.SAMPLE_SQL} GROUP BY 1, 2""")
def sampling_fraction(spark: SparkSession, folder: str) -> DataFrame:
    return mk.sampling_fraction(ad.samples(spark, folder), ["volume", "slice"])


# one 12 x 16 mask per supplier with its own exponents and target
DESIGN_SQL = """(SELECT s_suppkey AS mask_id, 12 AS ny, 16 AS nz, (10 + s_suppkey % 9) / 10.0::DOUBLE AS pa, (40 + s_suppkey % 50) / 10.0::DOUBLE AS pb,
  24.0::DOUBLE + s_suppkey % 60 AS target FROM supplier)"""
WEIGHT_SQL = f"""(SELECT d.*, CAST(p % 12 AS INTEGER) AS y, CAST(p // 12 AS INTEGER) AS z, p AS pos,
  exp(-(pow(pb * sqrt(pow(p % 12 - 6, 2) + pow(p // 12 - 8, 2)) / 12, pa) + pow(pb * sqrt(pow(p % 12 - 6, 2) + pow(p // 12 - 8, 2)) / 16, pa)) / 2) AS f
  FROM {DESIGN_SQL} d, (SELECT unnest(range(192)) AS p))"""
CALIBRATED_SQL = f"""(WITH r AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY mask_id) AS n,
    sum(f) OVER (PARTITION BY mask_id) AS total, sum(f) OVER (w ROWS UNBOUNDED PRECEDING) AS head FROM {WEIGHT_SQL}
    WINDOW w AS (PARTITION BY mask_id ORDER BY f DESC, pos)),
  s AS (SELECT mask_id, k, (target - k - (total - head)) / (n - k) AS c FROM r WHERE k < n
    UNION ALL SELECT mask_id, 0, (target - total) / n FROM r WHERE k = 1),
  ok AS (SELECT s.mask_id, max(s.c) AS c FROM s WHERE (s.k = 0 OR (SELECT f FROM r WHERE r.mask_id = s.mask_id AND r.k = s.k) + s.c >= 1)
    AND (SELECT f FROM r WHERE r.mask_id = s.mask_id AND r.k = s.k + 1) + s.c < 1 GROUP BY s.mask_id)
  SELECT r.mask_id, r.y, r.z, r.pos, CASE WHEN floor(r.total) <= floor(r.target) THEN ok.c END AS c,
    least(r.f + CASE WHEN floor(r.total) <= floor(r.target) THEN ok.c END, CASE WHEN floor(r.total) <= floor(r.target) THEN 1.0 END) AS p
  FROM r LEFT JOIN ok ON r.mask_id = ok.mask_id)"""


def mask_density(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("s_suppkey")
    designs = table(spark, folder, "supplier").select(
        k.alias("mask_id"), F.lit(12).alias("ny"), F.lit(16).alias("nz"), ((10 + k % 9) / 10.0).alias("pa"),
        ((40 + k % 50) / 10.0).alias("pb"), (24.0 + k % 60).alias("target"))
    cells = mk.grid(designs, F.col("ny"), F.col("nz"))
    weighted = cells.withColumn("f", mk.radial_profile(*[F.col(c) for c in ("y", "z", "ny", "nz", "pa", "pb")]))
    return mk.calibrate(weighted, ["mask_id"], "f", "target", ["pos"])


@query(f"SELECT mask_id, y, z, round(c, 8) AS c, round(p, 8) AS p FROM {CALIBRATED_SQL}")
def calibrate_prob(spark: SparkSession, folder: str) -> DataFrame:
    d = mask_density(spark, folder)
    p = F.when(F.col("c").isNotNull(), F.col("p"))
    return d.select("mask_id", "y", "z", F.round("c", 8).alias("c"), F.round(p, 8).alias("p"))


@query("""WITH g AS (SELECT s_suppkey AS mask_id, p AS pos, 20.0::DOUBLE + s_suppkey % 40 AS target, greatest(abs(-1 + 2 * (p % 10) / 9.0::DOUBLE), abs(-1 + 2 * (p // 10) / 9.0::DOUBLE)) AS r FROM supplier, (SELECT unnest(range(100)) AS p)),
  f AS (SELECT *, CASE WHEN r < 0.2 THEN 1.0 ELSE pow(greatest(1 - r, 0), 3) END AS f FROM g),
  t AS (SELECT mask_id, sum(f) AS total, max(target) AS target FROM f GROUP BY 1),
  c AS (SELECT f.mask_id, f.f AS lim, sum(least(o.f + 1 - f.f, 1)) AS at_lim FROM (SELECT DISTINCT mask_id, f FROM f) f JOIN f o ON o.mask_id = f.mask_id GROUP BY 1, 2),
  k AS (SELECT c.mask_id, max(lim) FILTER (WHERE at_lim > target) AS open_top FROM c JOIN t ON t.mask_id = c.mask_id GROUP BY 1),
  s AS (SELECT f.mask_id, (max(target) - count(*) FILTER (WHERE f.f > open_top) - sum(CASE WHEN f.f <= open_top THEN f.f ELSE 0 END)) / count(*) FILTER (WHERE f.f <= open_top) AS c FROM f JOIN k ON f.mask_id = k.mask_id GROUP BY 1)
SELECT f.mask_id, CAST(pos AS BIGINT) AS pos, round(least(f.f + s.c, 1.0), 8) AS p FROM f JOIN s ON s.mask_id = f.mask_id JOIN t ON t.mask_id = f.mask_id WHERE floor(total) <= floor(t.target)""")
def calibrate_polynomial(spark: SparkSession, folder: str) -> DataFrame:
    """Polynomial profile with a full centre, calibrated; the twin searches the saturation limit."""
    k = F.col("s_suppkey")
    designs = table(spark, folder, "supplier").select(k.alias("mask_id"), F.lit(10).alias("n"), (20.0 + k % 40).alias("target"))
    cells = mk.grid(designs, F.col("n"), F.col("n"))
    r = mk.unit_radius(F.col("y"), F.col("z"), 10, 10, "max")
    weighted = cells.withColumn("f", mk.polynomial_profile(r, F.lit(3), 0.2))
    solved = mk.calibrate(weighted, ["mask_id"], "f", "target", ["pos"]).where("c IS NOT NULL")
    return solved.select("mask_id", "pos", F.round("p", 8).alias("p"))


TRIES = 6


@query(f"""WITH d AS (SELECT mask_id, y, z, pos, p, t FROM {CALIBRATED_SQL}, (SELECT CAST(unnest(range({TRIES})) AS INTEGER) AS t) WHERE c IS NOT NULL),
  x AS (SELECT *, (CAST(('0x' || substr(md5(concat_ws('|', 7, mask_id, t)), 1, 8)) AS BIGINT) + r * 2654435769 + pos * 2246822519) & 4294967295 AS x FROM d, (SELECT unnest(range(200)) AS r)),
  x1 AS (SELECT mask_id, t, r, y, z, pos, p, (xor(x, x >> 16) * 73244475) & 4294967295 AS x FROM x),
  x2 AS (SELECT mask_id, t, r, y, z, pos, p, (xor(x, x >> 16) * 73244475) & 4294967295 AS x FROM x1),
  all_h AS (SELECT mask_id, t, r, y, z, pos, p, xor(x, x >> 16) / 4294967296.0::DOUBLE < p AS hit FROM x2),
  near AS (SELECT mask_id, t, r FROM all_h GROUP BY 1, 2, 3 HAVING abs(sum(CAST(hit AS INTEGER)) - round(sum(p), 6)) <= 1),
  h AS (SELECT a.* FROM all_h a JOIN (SELECT mask_id, t, min(r) AS r FROM near GROUP BY 1, 2) n ON a.mask_id = n.mask_id AND a.t = n.t AND a.r = n.r),
  c AS (SELECT mask_id, t, CAST(sum(CAST(hit AS INTEGER)) AS BIGINT) AS count, string_agg(CASE WHEN hit THEN '1' ELSE '0' END, '' ORDER BY pos) AS mask FROM h GROUP BY 1, 2),
  w AS (SELECT h.mask_id, h.t, y, z, 1 / p AS w FROM h JOIN c ON h.mask_id = c.mask_id AND h.t = c.t WHERE hit),
  u AS (SELECT mask_id, t, z, ky, sum(w * cos(2 * pi() * ky * y / 12)) AS a, sum(w * sin(2 * pi() * ky * y / 12)) AS b FROM w, (SELECT unnest(range(12)) AS ky) GROUP BY 1, 2, 3, 4),
  v AS (SELECT mask_id, t, ky, kz, sum(a * cos(2 * pi() * kz * z / 16) - b * sin(2 * pi() * kz * z / 16)) AS a,
    sum(a * sin(2 * pi() * kz * z / 16) + b * cos(2 * pi() * kz * z / 16)) AS b FROM u, (SELECT unnest(range(16)) AS kz) GROUP BY 1, 2, 3, 4),
  l AS (SELECT mask_id, t, round(max(sqrt(a * a + b * b)) / 192, 9) AS side_lobe FROM v WHERE ky + kz > 0 GROUP BY 1, 2),
  r AS (SELECT l.mask_id, l.side_lobe, l.t AS try, mask, count, row_number() OVER (PARTITION BY l.mask_id ORDER BY side_lobe, l.t) AS r FROM l JOIN c ON l.mask_id = c.mask_id AND l.t = c.t)
SELECT mask_id, side_lobe, try, mask, count FROM r WHERE r = 1""")
def mask_draw(spark: SparkSession, folder: str) -> DataFrame:
    density = mask_density(spark, folder).where(F.col("c").isNotNull()).select("mask_id", "pos", "p")
    draws = mk.draw_masks(density, ["mask_id"], 12, 16, TRIES, seed=7, tolerance=1.0)
    return mk.best_mask(draws, ["mask_id"])


# ---------------------------------------------------------------- windows and index arithmetic


def _voxels(spark: SparkSession, folder: str) -> DataFrame:
    exploded = ad.slices(spark, folder).select("volume", "slice", F.posexplode("re").alias("pos", "re"))
    return exploded.withColumns({"y": F.col("pos") % 8, "z": F.floor(F.col("pos") / 8).cast("int")})


@query(f"""SELECT slice, pos, round(re * CASE WHEN y BETWEEN 1 AND 6 AND z BETWEEN 1 AND 6 THEN
  (0.54 - 0.46 * cos(2 * pi() * (y - 1) / 5)) * (0.54 - 0.46 * cos(2 * pi() * (z - 1) / 5)) / pow(0.54 - 0.46 * cos(2 * pi() * 2 / 5), 2) ELSE 0 END, 9) + 0.0 AS value FROM {ad.VOXEL_SQL}""")
def lowfreq_window(spark: SparkSession, folder: str) -> DataFrame:
    w = mk.low_frequency_window(F.col("y"), F.col("z"), 8, 8, 6)
    return _voxels(spark, folder).select("slice", "pos", (F.round(F.col("re") * w, 9) + 0.0).alias("value"))


@query(f"""SELECT slice, pos, round(re / (1 + exp((sqrt(pow((y - 4) / 4.0, 2) + pow((z - 4) / 4.0, 2)) - 0.75) / 0.15)), 9) + 0.0 AS value FROM {ad.VOXEL_SQL}""")
def fermi_window(spark: SparkSession, folder: str) -> DataFrame:
    w = mk.fermi_window(F.col("y"), F.col("z"), 8, 8)
    return _voxels(spark, folder).select("slice", "pos", (F.round(F.col("re") * w, 9) + 0.0).alias("value"))


@query(f"""SELECT slice, count(*) AS cells, sum(CASE WHEN r2 < 0.5 THEN 1 ELSE 0 END)::BIGINT AS disc, sum(CASE WHEN r1 < 0.5 THEN 1 ELSE 0 END)::BIGINT AS square,
  max(CASE WHEN r2 < 0.5 THEN re END) AS disc_max FROM (SELECT slice, re, sqrt(pow(-1 + 2 * y / 7.0::DOUBLE, 2) + pow(-1 + 2 * z / 7.0::DOUBLE, 2)) / sqrt(2) AS r2,
  greatest(abs(-1 + 2 * y / 7.0::DOUBLE), abs(-1 + 2 * z / 7.0::DOUBLE)) AS r1 FROM {ad.VOXEL_SQL}) GROUP BY slice""")
def radius_mask(spark: SparkSession, folder: str) -> DataFrame:
    r2 = mk.unit_radius(F.col("y"), F.col("z"), 8, 8)
    r1 = mk.unit_radius(F.col("y"), F.col("z"), 8, 8, "max")
    return _voxels(spark, folder).groupBy("slice").agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(r2 < 0.5).alias("disc"), F.count_if(r1 < 0.5).alias("square"),
        F.max(F.when(r2 < 0.5, F.col("re"))).alias("disc_max"))


@query(f"""SELECT slice, pos, re FROM (SELECT *, row_number() OVER (PARTITION BY slice ORDER BY round(sqrt(pow(-1 + 2 * y / 7.0::DOUBLE, 2) + pow(-1 + 2 * z / 7.0::DOUBLE, 2)), 9), pos) AS r
  FROM {ad.VOXEL_SQL}) WHERE r <= 19""")
def lowest_radius(spark: SparkSession, folder: str) -> DataFrame:
    r = F.round(mk.unit_radius(F.col("y"), F.col("z"), 8, 8) * 2 ** 0.5, 9)
    return mk.lowest_radius(_voxels(spark, folder).withColumn("r", r), ["slice"], "r", 0.3).where("acquired").select("slice", "pos", "re")


@query(f"""SELECT slice, CAST(my AS INTEGER) AS y, CAST(mz AS INTEGER) AS z, coalesce(re, 0) AS re FROM (SELECT vec_id AS slice, my, mz FROM embeddings, (SELECT unnest(range(12)) AS my), (SELECT unnest(range(16)) AS mz)) g
  LEFT JOIN (SELECT slice AS s, y + 2 AS ay, z + 4 AS az, re FROM {ad.VOXEL_SQL}) v ON slice = s AND my = ay AND mz = az""")
def zero_pad(spark: SparkSession, folder: str) -> DataFrame:
    padded = arrays.pad_planes(ad.slices(spark, folder), "re", (8, 8), (12, 16), ("slice",))
    return padded.select("slice", F.posexplode("re").alias("p", "re")).select(
        "slice", (F.col("p") % 12).alias("y"), F.floor(F.col("p") / 12).cast("int").alias("z"), "re")


@query(f"SELECT slice, CAST(y - 2 + 4 * (z - 1) AS INTEGER) AS pos, re FROM {ad.VOXEL_SQL} WHERE y BETWEEN 2 AND 5 AND z BETWEEN 1 AND 6")
def centre_crop(spark: SparkSession, folder: str) -> DataFrame:
    cropped = ad.slices(spark, folder).select("slice", arrays.crop_plane(F.col("re"), 8, 8, 4, 6).alias("v"))
    return cropped.select("slice", F.posexplode("v").alias("pos", "re"))


@query("SELECT o_orderkey, CAST(pow(2, greatest(ceil(log2(greatest(o_orderkey % 300 + 1, o_custkey % 700 + 1))), 1)) AS INTEGER) AS padded FROM orders")
def dyadic_size(spark: SparkSession, folder: str) -> DataFrame:
    n = F.greatest(F.col("o_orderkey") % 300 + 1, F.col("o_custkey") % 700 + 1)
    return table(spark, folder, "orders").select("o_orderkey", arrays.dyadic(n).alias("padded"))


@query(f"""SELECT volume, trace, CAST((x + 16) % 32 AS INTEGER) AS shifted, CAST((x + 5) % 32 AS INTEGER) AS rolled, re FROM {ad.POINT_SQL}""")
def index_shifts(spark: SparkSession, folder: str) -> DataFrame:
    """Array roll and centre shift, checked against index arithmetic in the twin."""
    t = ad.traces(spark, folder)
    tagged = t.select("volume", "trace", "re", F.sequence(F.lit(0), F.lit(31)).alias("i"))
    place = lambda arr, v: (F.array_position(arr, v) - 1).cast("int")
    moved = tagged.select("volume", "trace", arrays.centre_shift(F.col("i")).alias("s"), arrays.roll(F.col("i"), 5).alias("r"),
                          F.posexplode("re").alias("x", "re"))
    return moved.select("volume", "trace", place(F.col("s"), F.col("x")).alias("shifted"),
                        place(F.col("r"), F.col("x")).alias("rolled"), "re")
