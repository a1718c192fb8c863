"""Queries on ids, ranges, options, parameter files and other text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions import options, tables, text
from lacuna.plans.monitoring import log_lines
from lacuna.plans.registry import query, table
from lacuna.sources import params as pr


PAD = "lpad(CAST({0} AS VARCHAR), CAST(greatest({1}, length(CAST({0} AS VARCHAR))) AS INTEGER), '0')"


@query(f"""SELECT o_orderkey, concat('S', {PAD.format("o_custkey", 5)}, '_m', {PAD.format("o_orderkey", 3)}) AS volume_id,
  o_orderkey + 1 AS volume_number, regexp_matches(concat(CASE WHEN o_orderkey % 3 = 0 THEN 's' ELSE 'S' END, {PAD.format("o_custkey", "CASE WHEN o_orderkey % 5 = 0 THEN 4 ELSE 5 END")}), '^[A-Z][0-9]{{5,6}}') AS valid FROM orders""")
def volume_ids(spark: SparkSession, folder: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    vid = text.volume_id(F.concat(F.lit("S"), text.padded(c, 5)), k)
    run = F.concat(F.when(k % 3 == 0, "s").otherwise("S"), F.when(k % 5 == 0, text.padded(c, 4)).otherwise(text.padded(c, 5)))
    return table(spark, folder, "orders").select(
        "o_orderkey", vid.alias("volume_id"), text.volume_number(vid).alias("volume_number"), text.is_run_id(run).alias("valid"))


@query("""SELECT o_orderkey, CAST(unnest(list_sort(list_distinct(list_concat(range(o_orderkey % 50, o_orderkey % 50 + o_custkey % 5 + 1), [o_orderkey % 50 + 3], range(60, 63))))) AS BIGINT) AS slice FROM orders""")
def range_expand(spark: SparkSession, folder: str) -> DataFrame:
    a = F.col("o_orderkey") % 50
    spec = F.concat_ws("_", a, F.lit("to"), a + F.col("o_custkey") % 5, a + 3, F.lit("60"), F.lit("to"), F.lit("62"))
    return table(spark, folder, "orders").select("o_orderkey", F.explode(text.expand_ranges(spec)).alias("slice"))


@query("""WITH s AS (SELECT DISTINCT l_suppkey % 100 AS owner, l_partkey % 400 AS n FROM lineitem),
  g AS (SELECT *, n - row_number() OVER (PARTITION BY owner ORDER BY n) AS island FROM s), i AS (SELECT owner, island, min(n) AS a, max(n) AS b FROM g GROUP BY 1, 2)
SELECT owner, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE concat(a, '_to_', b) END, '_' ORDER BY a) AS range_text FROM i GROUP BY owner""")
def range_compact(spark: SparkSession, folder: str) -> DataFrame:
    numbers = table(spark, folder, "lineitem").select(
        (F.col("l_suppkey") % 100).alias("owner"), (F.col("l_partkey") % 400).alias("n"))
    return numbers.groupBy("owner").agg(text.compact_ranges(F.array_sort(F.collect_set("n"))).alias("range_text"))


@query("""SELECT o_orderkey, CAST(5 + o_custkey % 20 AS INTEGER) AS per_block, CAST(1 + o_orderkey % 5 AS INTEGER) AS blocks,
  CAST((5 + o_custkey % 20) * (1 + o_orderkey % 5) AS INTEGER) AS total, concat(5 + o_custkey % 20, 'x', 1 + o_orderkey % 5) AS plan, CAST(1 + o_orderkey % 5 AS INTEGER) AS weights FROM orders""")
def iteration_plan(spark: SparkSession, folder: str) -> DataFrame:
    plan = F.concat(5 + F.col("o_custkey") % 20, F.lit("x"), 1 + F.col("o_orderkey") % 5)
    per, blocks, total = text.plan_total(plan)
    return table(spark, folder, "orders").select(
        "o_orderkey", per.alias("per_block"), blocks.alias("blocks"), total.alias("total"),
        text.plan_text(total, blocks - 1).alias("plan"), F.size(F.array_repeat(F.lit(0.0012), blocks)).alias("weights"))


@query("""SELECT o_orderkey, trim(concat('run S', o_custkey, ' mask=CS256_8x_pa18_pb54', CASE WHEN o_orderkey % 2 = 0 THEN ' planned_ok' ELSE '' END)) AS template FROM orders""")
def command_template(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    command = F.concat(F.lit("run S"), F.col("o_custkey"), F.lit(" first_volume="), k, F.lit(" mask=CS256_8x_pa18_pb54 last_volume="), k + 2,
                       F.when(k % 2 == 0, "  planned_ok").otherwise(""))
    return table(spark, folder, "orders").select("o_orderkey", text.strip_arguments(command, "first_volume", "last_volume").alias("template"))


@query("""SELECT doc_id, length(t) AS kept, length(text) - length(t) AS removed, md5(t) AS digest FROM (SELECT doc_id, text, regexp_replace(text, '[^\\x20-\\x7E]', '', 'g') AS t FROM documents)""")
def printable_text(spark: SparkSession, folder: str) -> DataFrame:
    clean = text.printable(F.col("text"))
    docs = table(spark, folder, "documents").select("doc_id", "text", clean.alias("t"))
    return docs.select("doc_id", F.length("t").cast("bigint").alias("kept"), (F.length("text") - F.length("t")).cast("bigint").alias("removed"), F.md5("t").alias("digest"))


@query("""SELECT event_id, CASE WHEN user_id % 4 <> 0 THEN event_type END AS key, CASE WHEN user_id % 4 <> 0 THEN CAST(value AS VARCHAR) END AS val, user_id % 4 <> 0 AS well_formed FROM events""")
def key_value_lines(spark: SparkSession, folder: str) -> DataFrame:
    broken = F.when(F.col("user_id") % 4 == 0, ":::x").otherwise("")
    line = F.concat("event_type", F.lit(":::"), F.col("value").cast("string"), broken)
    key, value, good = text.key_value(line)
    return table(spark, folder, "events").select("event_id", key.alias("key"), value.alias("val"), good.alias("well_formed"))


@query("""SELECT event_id, CASE event_type WHEN 'view' THEN concat(value, '1% of slices') WHEN 'click' THEN concat('Stage ', user_id, ' begins') WHEN 'purchase' THEN concat('TOTAL ', value) END AS part FROM events""")
def progress_lines(spark: SparkSession, folder: str) -> DataFrame:
    v, kind = F.col("value").cast("string"), F.col("event_type")
    line = (F.when(kind == "view", F.concat(F.lit("[x] "), v, F.lit("1% of slices")))
            .when(kind == "click", F.concat(F.lit("now Stage "), F.col("user_id"), F.lit(" begins")))
            .when(kind == "purchase", F.concat(F.lit(">> TOTAL "), v)).otherwise("waiting"))
    return table(spark, folder, "events").select("event_id", text.progress_line(line).alias("part"))


@query("""SELECT o_orderkey, concat(lpad(CAST(ms // 3600000 AS VARCHAR), CAST(greatest(2, length(CAST(ms // 3600000 AS VARCHAR))) AS INTEGER), '0'), ':', lpad(CAST(ms // 60000 % 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(ms // 1000 % 60 AS VARCHAR), 2, '0'), '.', lpad(CAST(ms % 1000 AS VARCHAR), 3, '0')) AS elapsed
  FROM (SELECT o_orderkey, CAST(floor(o_totalprice * 1000 + 0.5) AS BIGINT) AS ms FROM orders)""")
def duration_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", text.duration(F.col("o_totalprice")).alias("elapsed"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d_%H:%M:%S') AS logged, date_trunc('second', ts) AS parsed, date_trunc('second', ts) < TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 1 MINUTE AS stale FROM events""")
def log_times(spark: SparkSession, folder: str) -> DataFrame:
    logged = F.date_format("ts", text.LOG_TIME)
    rows = table(spark, folder, "events").select("event_id", logged.alias("logged"))
    parsed = F.to_timestamp("logged", text.LOG_TIME)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp") - F.expr("INTERVAL 1 MINUTE")
    return rows.withColumn("parsed", parsed.cast("timestamp_ntz")).withColumn("stale", F.col("parsed") < cut.cast("timestamp_ntz"))


@query("""SELECT o_orderkey, CAST(10 + o_custkey % 90 AS INTEGER) AS chunk_size, CASE WHEN o_orderkey % 2 = 0 THEN 0.002::DOUBLE ELSE 0.0012::DOUBLE END AS tv_weight,
  CASE WHEN o_orderkey % 7 = 0 THEN 'CS256_8x_pa18_pb54' END AS mask, o_orderkey % 3 = 0 AS keep_work, CAST(CASE WHEN o_orderkey % 5 = 0 THEN 50 ELSE 100 END AS INTEGER) AS iterations FROM orders""")
def option_scan(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    flag = lambda test, token: F.when(test, F.lit(token)).otherwise("")
    tokens = F.array(F.lit("chunk_size=1"), F.concat(F.lit("chunk_size="), 10 + F.col("o_custkey") % 90), flag(k % 2 == 0, "tv_weight=0.002"),
                     flag(k % 3 == 0, "keep_work"), flag(k % 5 == 0, "50"), flag(k % 7 == 0, "CS256_8x_pa18_pb54"))
    o, d = F.col("o"), text.OPTION_DEFAULTS
    found = table(spark, folder, "orders").select("o_orderkey", tokens.alias("t"), text.options(tokens).alias("o"))
    loose = lambda rule: F.get(F.filter("t", lambda x: x.rlike(rule)), 0)
    option = lambda name: F.try_element_at("o", F.lit(name))
    return found.select(
        "o_orderkey", F.coalesce(option("chunk_size").try_cast("int"), F.lit(d["chunk_size"])).alias("chunk_size"),
        F.coalesce(option("tv_weight").try_cast("double"), F.lit(d["tv_weight"])).alias("tv_weight"),
        F.coalesce(option("mask"), loose(f"^{text.MASK_NAME}$")).alias("mask"),
        F.coalesce(option("keep_work") == "true", F.lit(False)).alias("keep_work"),
        F.coalesce(option("iterations").try_cast("int"), loose("^[0-9]+$").try_cast("int"), F.lit(d["iterations"])).alias("iterations"))


# ---------------------------------------------------------------- parameter files


def parameter_files(spark: SparkSession, folder: str) -> DataFrame:
    """One small parameter file per part."""
    k, size = F.col("p_partkey"), F.col("p_size")
    body = F.concat(
        F.lit("te 7 1 0\n3 "), F.concat_ws(" ", size, size + 1, k % 10), F.lit("\n0\nname 2\n2 \""), F.col("p_brand"), F.lit("\"\n\""), F.col("p_type"),
        F.lit("\"\npetable\n1 \"epi132alt"), 1 + k % 8, F.lit("k"), F.when(k % 3 == 0, "2r").otherwise(""), F.lit("\"\nshort\n4 1 2\n"),
        F.when(k % 4 == 0, "nseg\n1 6\n").otherwise(""))
    return table(spark, folder, "part").select(k.alias("run"), body.alias("text"))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS run, key, CAST(declared AS INTEGER) AS declared, numbers, first_text, complete FROM (
  SELECT p_partkey, 'te' AS key, 3 AS declared, CAST(p_size + p_size + 1 + p_partkey % 10 AS DOUBLE) AS numbers, NULL AS first_text, true AS complete FROM part
  UNION ALL SELECT p_partkey, 'name', 2, 0, concat(p_brand, '|', p_type), true FROM part UNION ALL SELECT p_partkey, 'short', 4, 3, NULL, false FROM part
  UNION ALL SELECT p_partkey, 'petable', 1, 0, concat('epi132alt', 1 + p_partkey % 8, 'k', CASE WHEN p_partkey % 3 = 0 THEN '2r' ELSE '' END), true FROM part
  UNION ALL SELECT p_partkey, 'nseg', 1, 6, NULL, true FROM part WHERE p_partkey % 4 = 0)""")
def parameter_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = pr.parse_params(parameter_files(spark, folder))
    return rows.select("run", "key", "declared", F.aggregate("nums", F.lit(0.0), lambda a, v: a + v).alias("numbers"),
                       F.when(F.size("strs") > 0, F.array_join("strs", "|")).alias("first_text"), "complete")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS run, key, CAST(declared AS INTEGER) AS declared, numbers, texts, complete FROM (
  SELECT p_partkey, 'bad' AS key, 3 AS declared, p_size::DOUBLE AS numbers, NULL AS texts, false AS complete FROM part
  UNION ALL SELECT p_partkey, 'exact', 2, p_size - 0.5, NULL, true FROM part
  UNION ALL SELECT p_partkey, 'open', 1, 0, concat('no end of ', p_brand), true FROM part
  UNION ALL SELECT p_partkey, 'said', 2, 0, concat('"', p_type, '"|7 up'), true FROM part
  UNION ALL SELECT p_partkey, 'many', 1, 0, 'one', true FROM part
  UNION ALL SELECT p_partkey, 'few', 1 + p_partkey % 3, 0, 'only', p_partkey % 3 = 0 FROM part
  UNION ALL SELECT p_partkey, 'uncounted', 0, 0, NULL, true FROM part
  UNION ALL SELECT p_partkey, 'last', 4, 0, NULL, false FROM part)""")
def parameter_faults(spark: SparkSession, folder: str) -> DataFrame:
    """What is kept of records with bad numbers, open quotes, and too many or too few values."""
    k = F.col("p_partkey")
    body = F.concat(
        F.lit("7 stray 1\n\"stray\"\nbad 1 2\n3 "), F.col("p_size"), F.lit(" 1x 5\nexact\n2 -.5 "), F.col("p_size"), F.lit("e0\nopen\r\n1 \"no end of "),
        F.col("p_brand"), F.lit("\r\n0\n\nsaid\n2 \"'"), F.col("p_type"), F.lit("'\"\n  \"7 up\" 0\nmany\n1 \"one\"\n\"two\"\nfew\n"), 1 + k % 3,
        F.lit(" \"only\"\nuncounted\n\n  last 9\n4"))
    rows = pr.parse_params(table(spark, folder, "part").select(k.alias("run"), body.alias("text")))
    return rows.select("run", "key", "declared", F.aggregate("nums", F.lit(0.0), lambda a, v: a + v).alias("numbers"),
                       F.when(F.size("strs") > 0, F.array_join("strs", "|")).alias("texts"), "complete")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS run, CASE WHEN p_partkey % 4 = 0 THEN 6.0::DOUBLE ELSE 1.0::DOUBLE + p_partkey % 8 END AS numshots, CASE WHEN p_partkey % 3 = 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS accfactor,
  (CASE WHEN p_partkey % 4 = 0 THEN 6.0::DOUBLE ELSE 1.0::DOUBLE + p_partkey % 8 END) / (CASE WHEN p_partkey % 3 = 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END) AS navechoes FROM part""")
def parameter_defaults(spark: SparkSession, folder: str) -> DataFrame:
    out = pr.derive(pr.parse_params(parameter_files(spark, folder)))
    return out.select("run", "numshots", "accfactor", "navechoes")


@query("""SELECT p_partkey, p_size * 10.0::DOUBLE / 128 AS vx, (p_size + 2) * 10.0::DOUBLE / 100 AS vy, CASE WHEN p_brand LIKE '%1' THEN 9.4::DOUBLE WHEN p_brand LIKE '%2' THEN 7.0::DOUBLE END AS field FROM part""")
def voxel_size(spark: SparkSession, folder: str) -> DataFrame:
    extent = F.array(F.col("p_size").cast("double"), (F.col("p_size") + 2).cast("double"))
    size = F.zip_with(extent, F.array(F.lit(128.0), F.lit(100.0)), lambda e, n: e * 10 / n)
    return table(spark, folder, "part").select(
        "p_partkey", F.get(size, 0).alias("vx"), F.get(size, 1).alias("vy"),
        F.when(F.endswith("p_brand", F.lit("1")), 9.4).when(F.endswith("p_brand", F.lit("2")), 7.0).alias("field"))


@query("""SELECT user_id, count(*) AS lines, count(*) FILTER (WHERE event_type = 'error') AS errors, sum(CASE event_type WHEN 'view' THEN length(concat('Slice ', user_id, ': Time to load sparse data:  ', value, ' seconds.'))
  WHEN 'click' THEN length(concat('Slice ', user_id, ' : Time to set up recon:  ', value, ' seconds.')) WHEN 'purchase' THEN length(concat('slice ', user_id, ': Time to reconstruct data (With 1 iteration blocks):  ', value, ' seconds. '))
  WHEN 'signup' THEN length(concat('Slice ', user_id, ': Reconstruction flag ("', value, '") written.')) ELSE length(concat('ERROR: Slice ', user_id, ' could not be read')) END)::BIGINT AS characters FROM events GROUP BY 1""")
def log_volume(spark: SparkSession, folder: str) -> DataFrame:
    """Lines, error lines and characters per slice mentioned in the log."""
    n = F.regexp_extract("line", r"(?i)slice\s+([0-9]+)", 1).cast("bigint")
    return log_lines(spark, folder).groupBy(n.alias("user_id")).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.startswith("line", F.lit("ERROR"))).alias("errors"),
        F.sum(F.length("line").cast("bigint")).alias("characters"))


@query("""SELECT o_orderkey, CAST(unnest(list_sort(list_distinct(list_concat(range(o_orderkey % 50, o_orderkey % 50 + o_custkey % 5 + 1), [o_orderkey % 50 + 3], range(60, 63))))) AS BIGINT) AS value
  FROM orders WHERE o_orderstatus <> 'P'""")
def lateral_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Range texts expanded by a table function in SQL."""
    tables.register(spark)
    return spark.sql("""SELECT o_orderkey, r.value FROM {orders} o, LATERAL expand_ranges(concat(o_orderkey % 50, '_to_', o_orderkey % 50 + o_custkey % 5, '_',
        o_orderkey % 50 + 3, '_60_to_62')) r WHERE o_orderstatus <> 'P'""", orders=table(spark, folder, "orders"))


@query("""WITH k AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderkey % 4 = 0 AS planned, o_orderkey % 6 = 0 AS kept, o_orderkey % 5 = 0 AS listed, o_orderkey % 7 = 0 AS loose,
    o_orderkey % 9 = 0 AS odd FROM orders),
  b AS (SELECT *, CASE WHEN planned THEN 5 ELSE 1 + c % 3 END AS blocks, CASE WHEN planned THEN 10.0 WHEN loose THEN 60.0 / (1 + c % 3) ELSE 100.0 / (1 + c % 3) END AS per_block FROM k)
SELECT k AS o_orderkey, CAST(blocks AS INTEGER) AS blocks, CAST(CASE WHEN planned THEN 50 WHEN loose THEN 60 ELSE 100 END AS INTEGER) AS limit_, CASE WHEN loose THEN 'CS256_8x_pa18_pb54' END AS mask,
  CASE WHEN listed THEN 3 ELSE blocks END::INTEGER AS tv_n, CASE WHEN listed THEN 0.002::DOUBLE ELSE 0.0012::DOUBLE END AS tv_first, 0.006::DOUBLE AS l1_last, k % 3 <> 0 AS fermi_filter,
  CAST(CASE WHEN odd THEN 30 ELSE c % 50 END AS INTEGER) AS chunk_size, CASE WHEN k % 8 = 0 THEN 'slice' WHEN k % 8 = 1 THEN 'volume' END AS preview,
  CASE WHEN k % 10 = 1 THEN 'Haar' ELSE 'Daubechies' END AS wavelet, CASE WHEN k % 2 = 0 THEN 4.0::DOUBLE ELSE 12.0::DOUBLE END AS filter,
  concat_ws('|', CASE WHEN odd THEN 'unknown colour' END, CASE WHEN odd THEN 'bad chunk_size' END, CASE WHEN k % 10 = 2 THEN 'bad wavelet_type' END,
    CASE WHEN planned AND kept THEN 'keep_work with iteration_strategy' END, CASE WHEN NOT planned AND per_block <> floor(per_block) THEN 'Itnlim not divisible' END,
    CASE WHEN listed AND blocks <> 3 THEN 'weights do not match the blocks' END) AS problems FROM b""")
def option_grammar(spark: SparkSession, folder: str) -> DataFrame:
    """Every kind of option, loose tokens, plans and weights, and what cannot be run."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    flag = lambda test, token: F.when(test, F.lit(token) if isinstance(token, str) else token).otherwise("")
    tokens = F.array(
        flag(k % 7 == 0, "60"), flag(k % 7 == 0, "CS256_8x_pa18_pb54"), F.concat(F.lit("re_init_count="), c % 3), F.concat(F.lit("chunk_size="), c % 50),
        flag(k % 4 == 0, "iteration_strategy=10x5"), flag(k % 6 == 0, "keep_work"), flag(k % 5 == 0, "TVWeight=[0.002, 0.001,0.0005]"), flag(k % 3 == 0, "skip_fermi_filter"),
        flag(k % 9 == 0, "chunk_size=many"), flag(k % 9 == 0, "colour=blue"), flag(k % 8 == 0, "CS_preview_data"), flag(k % 8 == 1, "CS_preview_data=volume"),
        flag(k % 10 == 1, "wavelet_type=Haar"), flag(k % 10 == 2, "wavelet_type=Best"), F.when(k % 2 == 0, "wavelet_dims=4,8").otherwise("wavelet_dims=7"), F.lit("xfmWeight"))
    found = options.parse_options(table(spark, folder, "orders").select("o_orderkey", tokens.alias("tokens")), "tokens")
    return found.select(
        "o_orderkey", "blocks", F.col("Itnlim").alias("limit_"), F.col("CS_table").alias("mask"), F.size("TVWeight").alias("tv_n"), F.col("TVWeight")[0].alias("tv_first"),
        F.element_at("xfmWeight", -1).alias("l1_last"), "fermi_filter", "chunk_size", F.col("CS_preview_data").alias("preview"), F.col("wavelet_type").alias("wavelet"),
        F.col("wavelet_dims")[0].alias("filter"), F.array_join("problems", "|").alias("problems"))
