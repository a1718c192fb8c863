"""Queries on traces, status words, headers and input checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions import bits
from lacuna.operators import acquisition as acq
from lacuna.plans import adapters as ad
from lacuna.plans.registry import query, table

ECHOES = 2


@query(f"SELECT volume, trace, x, re, im FROM {ad.POINT_SQL}")
def trace_decode(spark: SparkSession, folder: str) -> DataFrame:
    return acq.explode_points(ad.traces(spark, folder))


@query(f"""SELECT volume, trace, list_sum(re) AS sum_re, list_sum(im) AS sum_im FROM
  (SELECT volume, trace, [round(v * 1000000) FOR v IN re] AS re, [round(v * 1000000) FOR v IN im] AS im FROM {ad.TRACE_SQL})
  WHERE volume IN (SELECT s_suppkey FROM supplier)""")
def block_extract(spark: SparkSession, folder: str) -> DataFrame:
    wanted = table(spark, folder, "supplier").select(F.col("s_suppkey").cast("int").alias("volume"))
    picked = acq.extract_blocks(ad.traces(spark, folder), wanted)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + F.round(v * 1000000))
    return picked.select("volume", "trace", total("re").alias("sum_re"), total("im").alias("sum_im"))


@query(f"""SELECT volume, CAST(trace % {ECHOES} AS INTEGER) AS echo, CAST(trace // {ECHOES} AS INTEGER) AS echo_trace,
  x, re, im FROM {ad.POINT_SQL}""")
def trace_echo_split(spark: SparkSession, folder: str) -> DataFrame:
    split = acq.split_echoes(ad.traces(spark, folder), ECHOES)
    return acq.explode_points(split, ("volume", "echo", "echo_trace"))


@query("SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"(l_partkey >> {i}) & 1 = 1 AS {n}" for i, n in enumerate(bits.FILE_STATUS)) + " FROM lineitem")
def status_flags(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem")
    return items.select("l_orderkey", "l_linenumber", *bits.flag_columns(F.col("l_partkey")))


STATUS_RULES = {
    "l_quantity > 25": 0, "l_discount > 0.05": 2, "l_tax > 0.04": 3, "l_returnflag = 'R'": 4,
    "l_linestatus = 'F'": 7, "l_extendedprice > 50000": 12, "l_linenumber > 3": 15,
}


@query("SELECT l_orderkey, CAST(bit_or(word) AS BIGINT) AS any_flag, CAST(bit_and(word) AS BIGINT) AS all_flags, CAST(sum(word) AS BIGINT) AS word_sum"
       " FROM (SELECT l_orderkey, " + " + ".join(f"CAST({r} AS INTEGER) * {1 << b}" for r, b in STATUS_RULES.items())
       + " AS word FROM lineitem) GROUP BY l_orderkey")
def status_pack(spark: SparkSession, folder: str) -> DataFrame:
    flags = [F.lit(False)] * 16
    for rule, bit in STATUS_RULES.items():
        flags[bit] = F.expr(rule)
    words = table(spark, folder, "lineitem").select("l_orderkey", bits.pack_flags(flags).cast("bigint").alias("word"))
    return words.groupBy("l_orderkey").agg(
        F.bit_or("word").alias("any_flag"), F.bit_and("word").alias("all_flags"), F.sum("word").alias("word_sum"))


@query("""SELECT sample_type, count(*) AS files, CAST(sum(bytes * l_linenumber) AS BIGINT) AS total_bytes FROM (
  SELECT l_linenumber, CASE WHEN (l_partkey >> 3) & 1 = 1 THEN 'float32' WHEN (l_partkey >> 2) & 1 = 1 THEN 'int32' ELSE 'int16' END AS sample_type,
    CASE WHEN (l_partkey >> 3) & 1 = 1 OR (l_partkey >> 2) & 1 = 1 THEN 4 ELSE 2 END AS bytes FROM lineitem) GROUP BY sample_type""")
def sample_types(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select(
        "l_linenumber", bits.sample_type(F.col("l_partkey")).alias("sample_type"),
        bits.sample_bytes(F.col("l_partkey")).alias("bytes"))
    return items.groupBy("sample_type").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum((F.col("bytes") * F.col("l_linenumber")).cast("bigint")).alias("total_bytes"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """An order as a block file: lines are blocks, quantities are traces."""
    return table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("file")).agg(
        F.count(F.lit(1)).alias("nblocks"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("ntraces"),
        F.max(F.col("l_quantity").cast("bigint")).alias("sampled_lines"))


FILE_SQL = """(SELECT l_orderkey AS file, count(*) AS nblocks, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS ntraces,
  max(CAST(l_quantity AS BIGINT)) AS sampled_lines FROM lineitem GROUP BY l_orderkey)"""


@query(f"""SELECT file, nblocks, 28 + ntraces * 4 AS bytes_per_block, 32 + nblocks * (28 + ntraces * 4) - (file % 3) + 1 AS file_bytes,
  32 + nblocks * (28 + ntraces * 4) AS expected_bytes,
  CASE file % 3 WHEN 1 THEN 'ok' WHEN 2 THEN 'short' ELSE 'long' END AS verdict FROM {FILE_SQL}""")
def size_check(spark: SparkSession, folder: str) -> DataFrame:
    block = F.lit(28) + F.col("ntraces") * 4
    files = _files(spark, folder).select(
        "file", "nblocks", block.alias("bytes_per_block"),
        (F.lit(32) + F.col("nblocks") * block - F.col("file") % 3 + 1).alias("file_bytes"))
    return acq.check_sizes(files)


@query(f"""SELECT file, CASE WHEN nblocks = 1 THEN CAST(round(ntraces / sampled_lines) AS BIGINT) ELSE nblocks END AS volumes FROM {FILE_SQL}""")
def volume_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _files(spark, folder).select("file", acq.volume_count(
        F.col("nblocks"), F.col("ntraces"), F.col("sampled_lines")).alias("volumes"))


@query(f"""SELECT file, CAST(CASE WHEN nblocks = 1 AND round(ntraces / sampled_lines) > 1 THEN round(ntraces / sampled_lines) ELSE 1 END AS INTEGER) AS echoes
  FROM {FILE_SQL}""")
def echo_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Echoes in a block of every file, which is what a run splits its traces by."""
    return _files(spark, folder).select("file", acq.echo_count(
        F.col("nblocks"), F.col("ntraces"), F.col("sampled_lines")).alias("echoes"))


@query("""SELECT location, count(*) AS runs, min(o_orderkey) AS first_run FROM (SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'O' AND o_totalprice > 1000 * 60 THEN 1 WHEN o_orderstatus <> 'P' THEN 3 ELSE 2 END AS location
  FROM orders) GROUP BY location""")
def input_location(spark: SparkSession, folder: str) -> DataFrame:
    runs = table(spark, folder, "orders").select("o_orderkey", acq.input_class(
        F.col("o_orderstatus") == "O", F.col("o_totalprice") / 1000,
        F.when(F.col("o_orderstatus") != "P", 1).otherwise(0)).alias("location"))
    return runs.groupBy("location").agg(F.count(F.lit(1)).alias("runs"), F.min("o_orderkey").alias("first_run"))


@query("""SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS INTEGER) AS nblocks, CAST(l_partkey AS INTEGER) AS ntraces,
  CAST(-l_suppkey AS INTEGER) AS npoints, 4 AS bytes_per_element, CAST(l_quantity * 8 AS INTEGER) AS bytes_per_trace,
  CAST(l_extendedprice * 100 AS BIGINT) + 2147483648 AS bytes_per_block, -7 AS version,
  CAST(l_partkey % 30000 AS INTEGER) AS status, 1 AS nblock_headers FROM lineitem""")
def file_header_decode(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    fields = [(c("l_linenumber"), 4), (c("l_partkey"), 4), (-c("l_suppkey"), 4), (F.lit(4), 4),
              ((c("l_quantity") * 8).cast("int"), 4),
              (F.round(c("l_extendedprice") * 100).cast("bigint") + 2147483648, 4),
              (F.lit(-7), 2), (c("l_partkey") % 30000, 2), (F.lit(1), 4)]
    raw = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(*[bits.to_bytes(v, n) for v, n in fields]).alias("data"))
    return raw.select("l_orderkey", "l_linenumber", *acq.file_header(c("data")))


@query("""SELECT l_orderkey, l_linenumber, 1 AS scale, CAST(l_partkey % 256 AS INTEGER) AS status, CAST(l_linenumber AS INTEGER) AS block_index,
  0 AS mode, CAST(l_quantity AS INTEGER) AS ctcount, 1.0::DOUBLE AS lpval, -2.5::DOUBLE AS rpval, 0.15625::DOUBLE AS lvl, 0.0::DOUBLE AS tlt,
  l_partkey % 2 = 1 AS has_data FROM lineitem""")
def block_header_decode(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    shorts = [F.lit(1), c("l_partkey") % 256, c("l_linenumber"), F.lit(0)]
    singles = [0x3F800000, 0xC0200000, 0x3E200000, 0]
    raw = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.concat(
        *[bits.to_bytes(v, 2) for v in shorts], bits.to_bytes(c("l_quantity"), 4),
        *[bits.to_bytes(F.lit(v), 4) for v in singles]).alias("data"))
    return raw.select("l_orderkey", "l_linenumber", *acq.block_header(c("data"))).withColumn(
        "has_data", bits.get_bit(c("status"), bits.DATA_BIT))


@query("""WITH v AS (SELECT o_custkey AS run, o_orderkey AS volume, o_orderstatus <> 'P' AS ready,
    sha256(concat(o_custkey, '|', o_orderpriority)) AS digest FROM orders),
  s AS (SELECT run, min(volume) AS tag_volume, arg_min(digest, volume) AS tag, arg_min(ready, volume) AS tag_ready FROM v GROUP BY run)
SELECT v.run, volume, tag_volume, CASE WHEN volume = tag_volume AND ready THEN 'written' WHEN volume = tag_volume THEN 'not_ready'
  WHEN NOT tag_ready THEN 'no_tag' WHEN digest = tag THEN 'match' ELSE 'mismatch' END AS tag_status FROM v JOIN s ON v.run = s.run""")
def fingerprint_check(spark: SparkSession, folder: str) -> DataFrame:
    volumes = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("volume"),
        (F.col("o_orderstatus") != "P").alias("ready"),
        F.sha2(F.concat(F.col("o_custkey"), F.lit("|"), F.col("o_orderpriority")), 256).alias("digest"))
    return acq.fingerprint_status(volumes).select("run", "volume", "tag_volume", "tag_status")


@query("""WITH base AS (SELECT c_custkey AS run, k AS key, CASE k WHEN 'name' THEN c_name WHEN 'segment' THEN c_mktsegment ELSE CAST(c_nationkey AS VARCHAR) END AS value
    FROM customer, (VALUES ('name'), ('segment'), ('nation')) t(k)),
  over AS (SELECT o_custkey AS run, k AS key, max(CASE k WHEN 'segment' THEN o_orderpriority ELSE o_orderstatus END) AS value
    FROM orders, (VALUES ('segment'), ('B_status')) t(k) GROUP BY o_custkey, k)
SELECT coalesce(b.run, o.run) AS run, coalesce(b.key, o.key) AS key, coalesce(o.value, b.value) AS value,
  CASE WHEN o.value IS NULL THEN 'base' WHEN b.value IS NULL THEN 'added' ELSE 'overridden' END AS origin
FROM base b FULL JOIN over o ON b.run = o.run AND b.key = o.key""")
def header_merge(spark: SparkSession, folder: str) -> DataFrame:
    base = table(spark, folder, "customer").select(F.col("c_custkey").alias("run"), F.explode(F.create_map(
        F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"),
        F.lit("nation"), F.col("c_nationkey").cast("string"))).alias("key", "value"))
    top = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("run")).agg(
        F.max("o_orderpriority").alias("p"), F.max("o_orderstatus").alias("s"))
    override = top.select("run", F.explode(F.create_map(
        F.lit("segment"), F.col("p"), F.lit("B_status"), F.col("s"))).alias("key", "value"))
    return acq.merge_header_rows(base, override, ("run", "key"))


@query("""SELECT p_partkey AS run, unnest(['A_brand=' || p_brand, 'size=' || greatest(p_size, 25), 'type=' || p_type]) AS header, 3 AS entries FROM part""")
def header_maps(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    first = F.create_map(F.lit("A_brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string"),
                         F.lit("stale"), F.lit("x"))
    second = F.create_map(F.lit("size"), F.greatest("p_size", F.lit(25)).cast("string"), F.lit("type"), F.col("p_type"))
    merged = F.map_filter(acq.merge_headers(first, second), lambda k, _: k != "stale")
    lines = F.transform(F.map_entries(merged), lambda e: F.concat_ws("=", e.key, e.value))
    return part.select(F.col("p_partkey").alias("run"), F.explode(lines).alias("header"), F.size(merged).alias("entries"))


@query("""WITH need AS (SELECT c_custkey AS run, p AS key FROM customer, (SELECT DISTINCT o_orderpriority AS p FROM orders)),
  have AS (SELECT DISTINCT o_custkey AS run, o_orderpriority AS key FROM orders)
SELECT n.run, CAST(count(*) FILTER (WHERE h.key IS NULL) AS BIGINT) AS missing FROM need n LEFT JOIN have h ON n.run = h.run AND n.key = h.key GROUP BY n.run""")
def required_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("run"), F.col("o_orderpriority").alias("key"))
    # The keys every header must hold (the five order priorities).
    names = F.array(*[F.lit(p) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    need = table(spark, folder, "customer").select(F.col("c_custkey").alias("run"), F.explode(names).alias("key"))
    return acq.missing_keys(need, orders, "run", "key")


@query("""WITH cur AS (SELECT o_custkey AS path, sha256(CAST(max(o_orderkey) AS VARCHAR)) AS digest FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
  old AS (SELECT o_custkey AS path, sha256(CAST(max(o_orderkey) AS VARCHAR)) AS digest FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1)
SELECT coalesce(cur.path, old.path) AS path, CASE WHEN old.digest IS NULL THEN 'new' WHEN cur.digest IS NULL THEN 'gone'
  WHEN cur.digest = old.digest THEN 'same' ELSE 'changed' END AS change FROM cur FULL JOIN old ON cur.path = old.path""")
def input_changes(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")

    def digests(status: str) -> DataFrame:
        return orders.where(F.col("o_orderstatus") != status).groupBy(F.col("o_custkey").alias("path")).agg(
            F.sha2(F.max("o_orderkey").cast("string"), 256).alias("digest"))

    return acq.changed_inputs(digests("O"), digests("P"))


@query("""WITH want AS (SELECT s_suppkey AS owner, unnest([s_suppkey, s_suppkey * 2, s_suppkey + 7]) AS path FROM supplier),
  w AS (SELECT DISTINCT owner, path FROM want), have AS (SELECT DISTINCT p_partkey AS path FROM part WHERE p_size > 5)
SELECT owner, bool_and(h.path IS NOT NULL) AS all_ready, count(*) FILTER (WHERE h.path IS NULL) AS absent
FROM w LEFT JOIN have h ON w.path = h.path GROUP BY owner""")
def file_set_ready(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    wanted = table(spark, folder, "supplier").select(
        key.alias("owner"), F.concat_ws(":", key, key * 2, key + 7).alias("paths"))
    listing = table(spark, folder, "part").where("p_size > 5").select(F.col("p_partkey").cast("string").alias("path"))
    return acq.files_ready(wanted, listing, "owner", "paths")


# ---------------------------------------------------------------- tags and prefixes

TAG = "concat(md5(CAST(o_orderkey AS VARCHAR)), md5(CAST(o_custkey AS VARCHAR)), md5(CAST(o_orderkey % 9 AS VARCHAR)), md5(o_orderstatus))"


@query(f"SELECT o_orderkey, sha256(concat(substr(t, 1, 26), substr(t, 29, 72))) AS loose, sha256(substr(t, 1, 100)) AS exact FROM (SELECT o_orderkey, {TAG} AS t FROM orders)")
def tag_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of the first 100 bytes of a file, with and without its two status bytes."""
    parts = [F.md5(c.cast("string").cast("binary")) for c in (F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderkey") % 9, F.col("o_orderstatus"))]
    tag = F.concat(*parts).cast("binary")
    return table(spark, folder, "orders").select("o_orderkey", acq.tag_digest(tag).alias("loose"), acq.tag_digest(F.substring(tag, 1, 100), False).alias("exact"))


@query("SELECT o_orderkey, 'z_' || k AS key, CAST(v AS VARCHAR) AS value FROM (SELECT o_orderkey, unnest(['cust', 'status']) AS k, unnest([CAST(o_custkey AS VARCHAR), o_orderstatus]) AS v FROM orders)")
def prefixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Header maps whose keys get the prefix of their source."""
    header = F.create_map(F.lit("cust"), F.col("o_custkey").cast("string"), F.lit("status"), F.col("o_orderstatus"))
    return table(spark, folder, "orders").select("o_orderkey", F.explode(acq.prefix_keys(header, "z_")).alias("key", "value"))
