"""One query per operator over its whole table, and SQL twins where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.llm import bpe, decontaminate, html, katz, langid, pii, ranked, repair, secrets, shards, simhash, sketch, substrings
from lacuna.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    found = html.main_text(pages.select("page_id", "url", "html"), with_row=True)
    return found.select(F.col("id").alias("page_id"), "row.url", "text", F.length("text").cast("bigint").alias("n_chars"))


def _listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def _number(spans: str, kind: str) -> Column:
    return F.expr(f"cast(size(filter({spans}, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}")


@query
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), *(_number("base", k) for k in pii.KINDS[:4]),
                        F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


@query
def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), *(_number("base", r.kind) for r in secrets.RULES if r.base),
                        F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


@query
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN).withColumnRenamed(
        "id", "doc_id")


@query
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    model = langid.learn(docs.where("not held_out"))
    return langid.predict(docs.select("doc_id", "text", "held_out"), model, with_row=True).select(
        F.col("id").alias("doc_id"), "row.held_out", F.col("lang").alias("lang_pred"), "score", "languages", "shares")


@query
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


@query
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    return found.select(
        F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


SQL["op6_decontaminate"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, win.n, item_id FROM dw JOIN win ON dw.s = win.s AND dw.n = win.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS l
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)"""


@query
def op8_katz(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return katz.score(docs, held_out).withColumnRenamed("id", "doc_id")


@query
def op9_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query
def op10_sketch(spark: SparkSession, folder: str) -> DataFrame:
    found = sketch.versions(table(spark, folder, "documents"))
    found = found.withColumns({f"{k}_cells": sketch.cells(k) for k in ("own", "changed", "following")})
    found = found.withColumns({
        "apart": sketch.difference("own", "changed", "own_cells", "changed_cells"),
        "apart_next": sketch.difference("own", "following", "own_cells", "following_cells")})
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        sketch.fingerprint("own_cells").alias("fingerprint"), sketch.fingerprint("changed_cells").alias("edited_fingerprint"),
        sketch.likeness("own", "changed", "apart").alias("near_edited"),
        sketch.likeness("own", "following", "apart_next").alias("near_next"))


@query
def op11_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.assign(table(spark, folder, "documents"), 16)
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


#: CRC-32 of a byte list in DuckDB: ``tab`` is the table of the polynomial, ``bytes`` the list.
CRC_TABLE = """(SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""
CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode({text})), '..'),
    lambda x: ('0x' || x)::BIGINT)), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295)"""

SQL["op11_shards"] = f"""
WITH r AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {CRC.format(text="coalesce(text, '')")} AS crc,
                  ('0x' || left(md5(coalesce(text, '')), 15))::BIGINT AS g,
                  ('0x' || left(md5(coalesce(doc_id::VARCHAR, '')), 15))::BIGINT AS m
           FROM documents, {CRC_TABLE} t),
o AS (SELECT *, sum(size) OVER (ORDER BY g, m ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM r),
ends AS (SELECT upto::BIGINT AS b, total, upto = max(upto) OVER (PARTITION BY g) AS whole FROM o
         UNION ALL SELECT 0, max(total), true FROM o),
near AS (SELECT j, total, whole, arg_min(b, (abs(16 * b - j * total), b)) AS b
         FROM (SELECT j, b, total, w AS whole FROM ends, range(1, 16) k(j), (VALUES (true), (false)) v(w) WHERE whole OR NOT w)
         GROUP BY ALL),
cuts AS (SELECT j, coalesce(max(b) FILTER (whole AND abs(16 * b - j * total) * 100 <= total),
                            max(b) FILTER (NOT whole)) AS cut FROM near GROUP BY j),
placed AS (SELECT o.*, (SELECT count(*) FROM cuts WHERE cut <= upto - size) AS shard FROM o)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY upto) - 1 AS slot, NULL::INT AS grown_shard
FROM placed"""


@query
def op12_ranked(spark: SparkSession, folder: str) -> DataFrame:
    found = ranked.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


SQL["op12_ranked"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
q AS (SELECT item_id, t, count(*) AS times FROM (
          SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
size AS (SELECT r, doc_id, count(*) AS n FROM d GROUP BY ALL),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
tf AS (SELECT r, t, count(*) AS tf FROM d WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY t),
m AS (SELECT r, doc_id, 25 + (75 * n * docs) // terms AS m FROM size, whole),
s AS (SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN tf USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10"""


@query
def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return repair.repair(repair.damage(rows), rows).withColumnRenamed("conv", "conv_id")


SQL["op13_conversations"] = rf"""
WITH RECURSIVE c AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {CRC.format(text="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS deal
    FROM conversations, {CRC_TABLE} t),
d AS (SELECT conv_id, turn, CASE deal WHEN 4 THEN 'user' ELSE role END AS role,
             CASE deal WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM c, range(2) k(again) WHERE deal <> 0 AND (again = 0 OR deal = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             left(role, 1) AS x, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM d),
f AS (SELECT *, CASE WHEN said = '' THEN 'b'
                     WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                     WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
             x IS NOT NULL AND lag(x) OVER w || x NOT IN ('su', 'ua', 'au') AS bad
      FROM o WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
ins(p, q, e, cost) AS (VALUES (0, 0, '', 0), (0, 2, 'I', 5), (0, 3, 'II', 10), (1, 1, '', 0), (1, 2, 'I', 5),
                       (1, 3, 'II', 10), (2, 2, '', 0), (2, 3, 'I', 5), (3, 3, '', 0), (3, 2, 'I', 5)),
op(p, q, e, x, cost) AS (VALUES (0, 0, 'D', '', 2), (1, 1, 'D', '', 2), (2, 2, 'D', '', 2), (3, 3, 'D', '', 2),
                         (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (3, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0),
                         (0, 2, 'R', '', 1), (1, 2, 'R', '', 1), (3, 2, 'R', '', 1), (2, 3, 'R', '', 1)),
step AS (SELECT ins.p, op.q, ins.e || op.e AS e, op.x, ins.cost + op.cost AS cost FROM ins JOIN op ON ins.q = op.p),
run(conv_id, i, p, cost, audit) AS (
    SELECT DISTINCT conv_id, 0::BIGINT, 0, 0, '' FROM conversations
    UNION ALL
    SELECT conv_id, i, q, cost, audit FROM (
        SELECT run.conv_id, f.i, step.q, run.cost + step.cost + CASE WHEN fault = 't' AND right(e, 1) <> 'D' THEN 5 ELSE 0 END AS cost,
               run.audit || step.e AS audit,
               row_number() OVER (PARTITION BY run.conv_id, step.q ORDER BY run.cost + step.cost
                   + CASE WHEN fault = 't' AND right(e, 1) <> 'D' THEN 5 ELSE 0 END, run.audit || step.e) AS place
        FROM run JOIN f ON f.conv_id IS NOT DISTINCT FROM run.conv_id AND f.i = run.i + 1
                 JOIN step ON step.p = run.p AND (step.x = '' OR step.x = f.x) AND (fault NOT IN ('b', 'd') OR right(e, 1) = 'D')
    ) WHERE place = 1),
ended AS (SELECT conv_id, run.cost + ins.cost AS cost, audit || e AS audit FROM run JOIN ins ON ins.p = run.p AND ins.q IN (0, 3)
          WHERE i = (SELECT count(*) FROM d WHERE d.conv_id IS NOT DISTINCT FROM run.conv_id)),
best AS (SELECT * FROM ended QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1),
edits AS (SELECT conv_id, k, audit[k] AS e, count(*) FILTER (audit[k] <> 'I') OVER w AS i, count(*) FILTER (audit[k] <> 'D') OVER w AS n
          FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS k FROM best)
          WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
made AS (SELECT edits.conv_id, n, e, f.role, CASE WHEN e = 'I' THEN '' ELSE f.text END AS text,
                coalesce(max((n = 1 AND e = 'K' AND x = 's')::INT) OVER (PARTITION BY edits.conv_id), 0) AS s
         FROM edits LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM edits.conv_id AND f.i = edits.i WHERE e <> 'D'),
hashed AS (SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (n - s) % 2 = 1 THEN 'user' ELSE 'assistant' END
                  || ':' || text, chr(10) ORDER BY n)) AS sha FROM made GROUP BY conv_id),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                   count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (bad) AS illegal FROM f GROUP BY conv_id)
SELECT best.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost::BIGINT AS cost, audit,
       coalesce(sha, sha256('')) AS repaired_sha256
FROM best LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM best.conv_id
          LEFT JOIN hashed ON hashed.conv_id IS NOT DISTINCT FROM best.conv_id"""
