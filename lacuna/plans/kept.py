"""Queries on what runs keep: work state, published values and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.plans.registry import query, table
from lacuna.session import work_dir
from lacuna.sources import commits, sinks, tags
from lacuna.sources import state as st

ATTEMPTS = 12


@query(f"""WITH a AS (SELECT CAST(o_orderkey % {ATTEMPTS} AS INTEGER) + 1 AS attempt, CAST(o_custkey % 40 AS INTEGER) AS volume, o_orderkey % 250 AS slice,
    CAST(max(o_orderkey % 97) AS INTEGER) AS iterations, max(o_totalprice) AS re, min(o_totalprice) AS im FROM orders GROUP BY ALL)
SELECT volume, slice, iterations, re, im FROM a QUALIFY attempt = max(attempt) OVER (PARTITION BY volume, slice)""")
def state_table(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts in any order, one of them twice, folded as they come; the newest state of every slice."""
    path = work_dir(spark, "state")
    orders = table(spark, folder, "orders")
    for i in (*range(2, ATTEMPTS + 1), 1, 1):
        rows = orders.where(F.col("o_orderkey") % ATTEMPTS + 1 == i).groupBy(
            (F.col("o_custkey") % 40).alias("volume"), (F.col("o_orderkey") % 250).alias("slice")).agg(
            F.max(F.col("o_orderkey") % 97).alias("iterations"), F.array(F.max("o_totalprice")).alias("re"),
            F.array(F.min("o_totalprice")).alias("im"))
        st.append_attempt(rows, path, i, most=4)
    return st.read_state(spark, path).select("volume", "slice", "iterations", F.col("re")[0].alias("re"), F.col("im")[0].alias("im"))


@query("""WITH s AS (SELECT max(l_extendedprice) AS top FROM lineitem WHERE l_linenumber = 1)
SELECT l_linenumber AS volume, sum(round(l_extendedprice * 65535 / top)) AS total FROM lineitem, s GROUP BY l_linenumber""")
def published_scale(spark: SparkSession, folder: str) -> DataFrame:
    """The scale of the first volume is published; the other volumes' writers come later and use it too."""
    path = work_dir(spark, "scale")
    lines = table(spark, folder, "lineitem")
    for volume in (1, 2, 3):
        commits.publish_once(lines.where(F.col("l_linenumber") == volume).agg(F.max("l_extendedprice").alias("top")), path)
    top = commits.published(spark, path).agg(F.first("top")).scalar()
    return lines.groupBy(F.col("l_linenumber").alias("volume")).agg(F.sum(F.round(F.col("l_extendedprice") * 65535 / top)).alias("total"))


@query("""WITH p AS (SELECT regexp_extract(url, '://([^/]+)', 1) AS run, page_id AS volume, length(html) % 5 <> 0 AS ready, starts_with(url, 'http:') AS early,
    left(hex(encode(html)), 200) AS tag FROM pages),
  a AS (SELECT run, min(volume) AS tag_volume, arg_min(tag, volume) AS tag FROM p WHERE early GROUP BY run HAVING arg_min(ready, volume)),
  b AS (SELECT run, min(volume) AS tag_volume, arg_min(tag, volume) AS tag FROM p WHERE run NOT IN (SELECT run FROM a) GROUP BY run HAVING arg_min(ready, volume)),
  k AS (SELECT *, false AS new FROM a UNION ALL SELECT *, true FROM b)
SELECT p.run, volume, tag_volume, CASE WHEN NOT ready THEN 'not_ready' WHEN k.run IS NULL THEN 'no_tag' WHEN new AND volume = tag_volume THEN 'written'
  WHEN left(p.tag, 52) || substr(p.tag, 57) = left(k.tag, 52) || substr(k.tag, 57) THEN 'match' ELSE 'mismatch' END AS tag_status
FROM p LEFT JOIN k ON p.run = k.run""")
def tag_check(spark: SparkSession, folder: str) -> DataFrame:
    """The first 100 bytes of every page against what its host's first page left behind, in two arrivals."""
    path = work_dir(spark, "tags")
    pages = table(spark, folder, "pages")
    volumes = pages.select(F.regexp_extract("url", "://([^/]+)", 1).alias("run"), F.col("page_id").alias("volume"),
                           (F.length("html") % 5 != 0).alias("ready"), F.substring(F.encode("html", "utf-8"), 1, 100).alias("tag"))
    early = pages.where(F.startswith("url", F.lit("http:"))).select("page_id")
    tags.check_tags(volumes.join(early, volumes["volume"] == early["page_id"], "left_semi"), path).select("tag_status").write.format(
        "noop").mode("overwrite").save()
    return tags.check_tags(volumes, path).select("run", "volume", "tag_volume", "tag_status")


@query("""SELECT label AS volume, vec_id AS slice, CAST(list_sum([CAST(floor(abs(v) * 1000) AS BIGINT) * CASE WHEN label % 2 = 0 THEN 2 ELSE 1 END FOR v IN embedding]) AS BIGINT) AS total
  FROM embeddings""")
def image_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Images by volume, read back; the even volumes were written twice and have their second value."""
    path = work_dir(spark, "images")
    value = lambda times: F.transform("embedding", lambda v: (F.floor(F.abs(v.cast("double")) * 1000) * times).cast("int"))
    rows = table(spark, folder, "embeddings")
    sinks.write_images(rows.select(F.col("label").alias("volume"), F.col("vec_id").alias("slice"), value(1).alias("value")), path)
    even = rows.where("label % 2 = 0")
    sinks.write_images(even.select(F.col("label").alias("volume"), F.col("vec_id").alias("slice"), value(2).alias("value")), path)
    return spark.read.parquet(path).select("volume", "slice", F.aggregate("value", F.lit(0).cast("bigint"), lambda a, v: a + v).alias("total"))


@query("""SELECT CAST(label AS INTEGER) AS volume, count(*) AS slices, sum(list_sum([round(CAST(v AS DOUBLE) * 1000000) FOR v IN embedding])) AS re,
  sum(list_sum([round(CAST(embedding[i] AS DOUBLE) * 1000000) * i FOR i IN range(1, 65)])) AS moment FROM embeddings GROUP BY 1""")
def complex_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Complex volumes in single precision, read back as doubles."""
    path = work_dir(spark, "complex")
    rows = table(spark, folder, "embeddings")
    double = F.transform("embedding", lambda v: v.cast("double"))
    sinks.write_complex(rows.select(F.col("label").alias("volume"), F.col("vec_id").alias("slice"), double.alias("re"), double.alias("im")), path)
    add = lambda c, f: F.sum(F.aggregate(F.transform(c, f), F.lit(0.0), lambda a, v: a + v))
    return sinks.read_complex(spark, path).groupBy("volume").agg(
        F.count("*").alias("slices"), add("re", lambda v: F.round(v * 1000000)).alias("re"),
        add("im", lambda v, i: F.round(v * 1000000) * (i + 1)).alias("moment"))


@query("""SELECT user_id AS slice, round(sum(value) FILTER (WHERE event_type = 'view'), 2) AS load, round(sum(value) FILTER (WHERE event_type = 'purchase' AND value > 95), 2) AS recon
  FROM events GROUP BY 1""")
def timing_sink(spark: SparkSession, folder: str) -> DataFrame:
    """The timing report as tab separated text, missing values empty, read back."""
    path = work_dir(spark, "timing")
    total = lambda test: F.round(F.sum(F.when(F.expr(test), F.col("value"))), 2)
    sinks.write_timing(table(spark, folder, "events").groupBy(F.col("user_id").alias("slice")).agg(
        total("event_type = 'view'").alias("load"), total("event_type = 'purchase' and value > 95").alias("recon")), path)
    return spark.read.schema("slice bigint, load double, recon double").option("sep", "\t").option("header", "true").csv(path)


@query("""SELECT CAST(o_custkey % 20 AS INTEGER) AS project, CAST(count(*) AS BIGINT) AS lines, md5(string_agg(concat(o_orderkey, ',', o_orderstatus), '/' ORDER BY o_orderkey)) AS digest
  FROM orders GROUP BY 1""")
def manifest_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest lines, a folder a project, read back in order."""
    path = work_dir(spark, "manifest")
    lines = table(spark, folder, "orders").select((F.col("o_custkey") % 20).alias("project"), F.col("o_orderkey").alias("line_no"),
                                                  F.concat_ws(",", "o_orderkey", "o_orderstatus").alias("line"))
    sinks.write_manifest(lines, path, "project")
    number = F.substring_index("value", ",", 1).cast("bigint")
    rows = F.transform(F.array_sort(F.collect_list(F.struct(number.alias("n"), "value"))), lambda r: r["value"])
    return spark.read.option("basePath", path).text(path).groupBy("project").agg(
        F.count("*").alias("lines"), F.md5(F.array_join(rows, "/")).alias("digest"))
