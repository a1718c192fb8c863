"""Traces, blocks, headers and input checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions import arrays, bits

FILE_HEADER_BYTES, BLOCK_HEADER_BYTES, TAG_BYTES = 32, 28, 100


def explode_points(traces: DataFrame, keys: Sequence[str] = ("volume", "trace"), axis: str = "x") -> DataFrame:
    """Array traces to one row per complex point."""
    return (traces.select(*keys, F.posexplode(F.arrays_zip("re", "im")).alias(axis, "_p"))
            .select(*keys, axis, "_p.re", "_p.im"))


def extract_blocks(traces: DataFrame, requests: DataFrame) -> DataFrame:
    """Traces of the volumes a request table names."""
    return traces.join(requests.select("volume"), "volume", "left_semi")


def split_echoes(traces: DataFrame, nechoes: int | Column) -> DataFrame:
    """Echo is the fast index of the trace number; each echo becomes a volume."""
    n = nechoes if isinstance(nechoes, Column) else F.lit(nechoes)
    return traces.withColumns({
        "echo": F.pmod(F.col("trace"), n).cast("int"),
        "echo_trace": F.floor(F.col("trace") / n).cast("int"),
    })


def volume_count(nblocks: Column, ntraces: Column, sampled_lines: Column) -> Column:
    """One block holds echoes of one volume; otherwise every block is a volume."""
    return F.when(nblocks == 1, F.round(F.try_divide(ntraces, sampled_lines))).otherwise(nblocks).cast("bigint")


def echo_count(nblocks: Column, ntraces: Column, sampled_lines: Column) -> Column:
    """Echoes in a block of a file: all volumes of a single block, else one; at least one."""
    return F.when(nblocks == 1, F.greatest(F.lit(1), volume_count(nblocks, ntraces, sampled_lines))).otherwise(1).cast("int")


def expected_bytes(nblocks: Column, bytes_per_block: Column) -> Column:
    return F.lit(FILE_HEADER_BYTES) + nblocks * bytes_per_block


def check_sizes(files: DataFrame) -> DataFrame:
    """Adds the expected size and a verdict; nothing is dropped."""
    want = expected_bytes(F.col("nblocks").cast("bigint"), F.col("bytes_per_block"))
    return files.withColumn("expected_bytes", want).withColumn(
        "verdict", F.when(F.col("file_bytes") == want, "ok")
        .when(F.col("file_bytes") < want, "short").otherwise("long"))


def input_class(has_local: Column, local_bytes: Column, finished_bytes: Column) -> Column:
    """1 local copy, 2 acquisition in progress, 3 finished acquisition."""
    return F.when(has_local & (local_bytes > 60), 1).when(finished_bytes > 0, 3).otherwise(2)


def file_header(data: Column) -> list[Column]:
    """Fields of the 32-byte big-endian file header."""
    layout = [("nblocks", 0, 4), ("ntraces", 4, 4), ("npoints", 8, 4), ("bytes_per_element", 12, 4),
              ("bytes_per_trace", 16, 4)]
    fields = [bits.signed(data, at, size).cast("int").alias(n) for n, at, size in layout]
    return fields + [
        bits.unsigned(data, 20, 4).alias("bytes_per_block"),
        bits.signed(data, 24, 2).cast("int").alias("version"),
        bits.signed(data, 26, 2).cast("int").alias("status"),
        bits.signed(data, 28, 4).cast("int").alias("nblock_headers"),
    ]


def block_header(data: Column, at: int = 0) -> list[Column]:
    """Fields of the 28-byte block header that starts at byte ``at``."""
    shorts = ("scale", "status", "block_index", "mode")
    floats = ("lpval", "rpval", "lvl", "tlt")
    return ([bits.signed(data, at + 2 * i, 2).cast("int").alias(n) for i, n in enumerate(shorts)]
            + [bits.signed(data, at + 8, 4).cast("int").alias("ctcount")]
            + [bits.float32(data, at + 12 + 4 * i).alias(n) for i, n in enumerate(floats)])


def tag_digest(tag: Column, ignore_status: bool = True) -> Column:
    """Digest of the first 100 bytes; the two file-status bytes can be left out."""
    if ignore_status:
        tag = F.concat(F.substring(tag, 1, 26), F.substring(tag, 29, TAG_BYTES - 28))
    return F.sha2(tag, 256)


def fingerprint_status(volumes: DataFrame, run: str = "run", volume: str = "volume",
                       digest: str = "digest", ready: str = "ready") -> DataFrame:
    """Each volume's tag against the tag its run's first volume left behind."""
    stored = volumes.groupBy(run).agg(
        F.min(volume).alias("tag_volume"), F.min_by(digest, volume).alias("_tag"),
        F.min_by(ready, volume).alias("_tag_ready"))
    first = F.col(volume) == F.col("tag_volume")
    return volumes.join(stored, run).withColumn(
        "tag_status",
        F.when(first & F.col(ready), "written").when(first, "not_ready")
        .when(~F.col("_tag_ready"), "no_tag")
        .when(F.col(digest) == F.col("_tag"), "match").otherwise("mismatch"),
    ).drop("_tag", "_tag_ready")


def prefix_keys(header: Column, prefix: str) -> Column:
    return F.transform_keys(header, lambda k, _: F.concat(F.lit(prefix), k))


def merge_headers(base: Column, override: Column) -> Column:
    """Key/value maps; the second argument wins on a shared key."""
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(override, k))
    return F.map_concat(kept, override)


def merge_header_rows(base: DataFrame, override: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """The same merge for headers kept as (keys, value) rows."""
    right = override.withColumnRenamed(value, "_new")
    joined = base.join(right, list(keys), "full_outer")
    return joined.select(*keys, F.coalesce("_new", value).alias(value),
                         F.when(F.col("_new").isNull(), "base").when(F.col(value).isNull(), "added")
                         .otherwise("overridden").alias("origin"))


def missing_keys(required: DataFrame, present: DataFrame, owner: str, key: str) -> DataFrame:
    """How many required keys each owner lacks (0 included)."""
    have = present.select(owner, key).distinct().withColumn("_have", F.lit(1))
    return (required.join(have, [owner, key], "left").groupBy(owner)
            .agg(F.count_if(F.col("_have").isNull()).alias("missing")))


def changed_inputs(cached: DataFrame, current: DataFrame, path: str = "path", digest: str = "digest") -> DataFrame:
    """Cached copies against current copies: new, same, changed or gone."""
    joined = current.select(path, F.col(digest).alias("_now")).join(
        cached.select(path, F.col(digest).alias("_then")), path, "full_outer")
    return joined.select(path, F.when(F.col("_then").isNull(), "new").when(F.col("_now").isNull(), "gone")
                         .when(F.col("_now") == F.col("_then"), "same").otherwise("changed").alias("change"))


def files_ready(wanted: DataFrame, listing: DataFrame, owner: str, paths: str) -> DataFrame:
    """Whether all files of a ':'-separated list are in the listing."""
    each = wanted.select(owner, F.explode(F.array_distinct(F.split(paths, ":"))).alias("path"))
    found = listing.select("path").distinct().withColumn("_found", F.lit(True))
    return (each.join(found, "path", "left").groupBy(owner)
            .agg(F.bool_and(F.coalesce("_found", F.lit(False))).alias("all_ready"),
                 F.count_if(F.col("_found").isNull()).alias("absent")))


def merge_samples(parts: DataFrame, keys: Sequence[str], axis: str, values: Sequence[str], length: int) -> DataFrame:
    """Long samples to one array row per key, zeros where nothing was acquired.

    Repeated samples of one position are added first, so a group never exceeds
    ``length`` entries.
    """
    keys = list(keys)
    unique = parts.groupBy(*keys, axis).agg(*[F.sum(v).alias(v) for v in values])
    grouped = unique.groupBy(*keys).agg(F.collect_list(F.struct(axis, *values)).alias("_c")).select(
        *keys, F.col(f"_c.{axis}").alias("_at"), *[F.col(f"_c.{v}").alias(v) for v in values])
    return arrays.dense_rows(grouped, "_at", values, length, keys)
