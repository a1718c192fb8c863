"""Parameter files: a key line, then a count with numbers or quoted strings."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A line that starts with neither a digit nor a quote opens a record.
KEY_LINE = r"(?m)(?=^[ \t]*[^\s0-9\"])"
NUMBER = r"(?i)^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)$"

#: Keys whose first number ``derive`` uses.
NUMBER_KEYS = ("nseg", "accfactor", "tSenseAccfactor", "numshots", "navecho")

#: Files parsed by one task.
FILES_A_TASK = 1 << 13


def spread(files: DataFrame) -> DataFrame:
    """The same rows in tasks of about ``FILES_A_TASK``, dealt by a hash of all columns.

    Parsing costs far more than reading: small files come in a split or two, and a task
    would parse and sort the more of them the larger the table is.
    """
    if files.isStreaming:
        return files
    parts = math.ceil(files.count() / FILES_A_TASK)
    return files.repartition(parts, *files.columns) if parts > 1 else files


def parse_params(files: DataFrame, run: str = "run", text: str = "text") -> DataFrame:
    """(run, key, declared, nums, strs, complete): one row per key of each file.

    A file is split at its key lines, so every record is parsed on its own.  Its second
    line holds the count and the numbers or the first string; more strings stand on lines
    of their own, up to the count.  Numbers end at the first word that is none.  A string
    ends at its quote or its line, and single quotes in it become double ones.
    ``complete`` is false where the count is wrong or missing.  Empty and null texts have
    no keys.
    """
    given = spread(files.select(F.col(run).cast("string").alias("run"), F.col(text).alias("text")))
    records = given.select("run", F.explode(F.split("text", KEY_LINE)).alias("_r"))
    lines = records.select("run", F.split("_r", r"\r?\n").alias("_l")).withColumns({
        "key": F.regexp_extract(F.col("_l")[0], r"^\s*([^\s0-9\"]\S*)", 1),
        "_count": F.coalesce(F.get("_l", 1), F.lit(""))}).where("key <> ''")
    parts = lines.withColumns({
        "declared": F.coalesce(F.regexp_extract("_count", r"^\s*([0-9]+)(?=\s|$)", 1).try_cast("int"), F.lit(0)),
        "_rest": F.trim(F.regexp_replace("_count", r"^\s*\S+", ""))})
    quoted = F.filter(F.concat(F.array("_rest"), F.slice("_l", 3, F.greatest(F.size("_l"), F.lit(1)))),
                      lambda line: line.rlike(r'^\s*"'))
    words = F.transform(F.split("_rest", r"\s+"), lambda w: F.when(w.rlike(NUMBER), w.try_cast("double")))
    numeric = (F.col("_rest") != "") & ~F.startswith("_rest", F.lit('"'))
    bad = F.array_position(F.transform("_words", lambda v: v.isNull()), True)
    found = parts.withColumn("_words", words).select(
        "run", "key", "declared",
        F.when(numeric, F.when(bad > 0, F.slice("_words", 1, (bad - 1).cast("int"))).otherwise(F.col("_words")))
        .otherwise(F.array().cast("array<double>")).alias("nums"),
        F.when(numeric, F.array().cast("array<string>")).otherwise(F.transform(
            F.slice(quoted, 1, F.col("declared")), lambda line: F.translate(F.regexp_extract(line, r'^\s*"([^"]*)', 1), "'", '"')))
        .alias("strs"))
    return found.withColumn("complete", F.col("declared") == F.size("nums") + F.size("strs"))


def derive(params: DataFrame) -> DataFrame:
    """Wide derived values per run: shots, acceleration and navigator echoes.

    The table name ``epi<lines>alt<shots>k[<factor>r|t]`` supplies shots and the
    acceleration; ``nseg`` overrides the shots.
    Rows are cut to the first values of the keys in use before they are grouped, since
    Spark sorts them for that and would hold all values of all keys.
    """
    used = F.col("key").isin(*NUMBER_KEYS)
    first = params.select(
        "run", F.when(used, F.col("key")).alias("key"), F.when(used, F.get("nums", 0)).alias("num"),
        F.when(F.col("key") == "petable", F.get("strs", 0)).alias("petable"))
    number = lambda key: F.max(F.when(F.col("key") == key, F.col("num")))
    wide = first.groupBy("run").agg(
        F.max("petable").alias("petable"), number("nseg").alias("_nseg"), number("accfactor").alias("_acc"),
        number("tSenseAccfactor").alias("_tacc"), number("numshots").alias("_shots"), number("navecho").alias("_nav"))
    epi = r"^epi[^0-9]*[0-9]+[^0-9]+([0-9]+)(?:[^0-9]+([0-9]+)([rt])?)?"
    part = lambda i: F.regexp_extract(F.coalesce("petable", F.lit("")), epi, i)
    value = lambda c: F.when(c != "", c.cast("double"))
    is_epi = F.coalesce(F.startswith("petable", F.lit("epi")), F.lit(False))
    out = wide.select(
        "run", "petable",
        F.coalesce("_nseg", value(part(1)), "_shots", F.lit(1.0)).alias("numshots"),
        F.coalesce(F.when(part(3) == "r", value(part(2))), "_acc", F.lit(1.0)).alias("accfactor"),
        F.coalesce(F.when(part(3) == "t", value(part(2))), "_tacc", F.lit(1.0)).alias("tsense_accfactor"),
        F.coalesce("_nav", F.when(is_epi, 1.0), F.lit(0.0)).alias("navecho"))
    return out.withColumn("navechoes", F.try_divide(F.col("navecho") * F.col("numshots"), F.col("accfactor")))
