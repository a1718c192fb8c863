"""Text fields: ids, ranges, options, log lines and clean-up, all on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of names, ids and log lines.
MASK_NAME = r"CS(?:a|table)?([0-9]+)(x[0-9]+)?_([0-9]+(?:[.][0-9]+)?)x_pa([0-9]+)_pb([0-9]+)"
RUN_ID = r"^[A-Z][0-9]{5,6}"
VOLUME_SUFFIX = r"_m([0-9]+)$"
NUMBER = r"[0-9]+(?:[.][0-9]+)?"
LOG_PATTERNS = {
    "time_recon": rf"(?i)^Slice\s+([0-9]+)\s*:\s+time\sto\srec[a-z]+\sdata[^:]*:\s+({NUMBER})\sseconds[.]",
    "time_load": rf"(?i)^Slice\s+([0-9]+)\s*:\s+time\sto\sload\ssparse\sdata\s*:\s+({NUMBER})\sseconds[.]",
    "time_setup": rf"(?i)^Slice\s+([0-9]+)\s*:\s+time\sto\sset\sup\srecon\s*:\s+({NUMBER})\sseconds[.]",
    "iterations": rf"(?i)^Slice\s+([0-9]+)\s*:\s+recon[a-z]+\sflag[^\"]+\"({NUMBER})\"",
}
LOG_TIME = "yyyy-MM-dd_HH:mm:ss"
PROGRESS_LINE = r"(?i)((?:[0-9]+[.][0-9]+%|stage|total).*$)"


def padded(number: Column, width: int) -> Column:
    """Digits with leading zeros up to ``width``; a longer number is never cut."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def volume_id(run: Column, number: Column, width: int = 3) -> Column:
    """``<run>_m<000>`` from a 0-based volume number; numbers over the width keep all digits."""
    return F.concat(run, F.lit("_m"), padded(number, width))


def volume_number(volume: Column, one_based: bool = True) -> Column:
    digits = F.regexp_extract(volume, VOLUME_SUFFIX, 1)
    number = F.when(digits != "", digits.cast("bigint"))
    return number + 1 if one_based else number


def is_run_id(run: Column) -> Column:
    return run.rlike(RUN_ID)


def expand_ranges(text: Column) -> Column:
    """``3_to_5_9`` to the sorted distinct list [3, 4, 5, 9]."""
    tokens = F.split(F.replace(text, F.lit("_to_"), F.lit(":")), "_")

    def span(token: Column) -> Column:
        first = F.element_at(F.split(token, ":"), 1).cast("bigint")
        last = F.element_at(F.split(token, ":"), -1).cast("bigint")
        return F.sequence(first, last)

    return F.array_sort(F.array_distinct(F.flatten(F.transform(tokens, span))))


def compact_ranges(numbers: Column) -> Column:
    """Sorted distinct list to range text; only stride-1 runs are joined."""
    none = F.array(F.lit(None).cast("bigint"))
    before = F.concat(none, F.slice(numbers, F.lit(1), F.greatest(F.size(numbers) - 1, F.lit(0))))
    after = F.concat(F.slice(numbers, F.lit(2), F.size(numbers)), none)
    edge = lambda other, step: F.filter(
        F.zip_with(numbers, other, lambda v, o: F.when(o.isNull() | (o != v + step), v)), lambda v: v.isNotNull())
    starts, ends = edge(before, -1), edge(after, 1)
    text = lambda a, b: F.when(a == b, a.cast("string")).otherwise(
        F.concat(a.cast("string"), F.lit("_to_"), b.cast("string")))
    return F.array_join(F.zip_with(starts, ends, text), "_")


def plan_total(plan: Column) -> tuple[Column, Column, Column]:
    """``NxM`` iteration plan: iterations per block, blocks, total."""
    per = F.element_at(F.split(plan, "x"), 1).cast("int")
    blocks = F.element_at(F.split(plan, "x"), -1).cast("int")
    return per, blocks, per * blocks


def plan_text(total: Column, restarts: Column) -> Column:
    blocks = restarts + 1
    return F.concat((total / blocks).cast("bigint").cast("string"), F.lit("x"), blocks.cast("string"))


def strip_arguments(command: Column, *names: str) -> Column:
    """A command template without the given ``name=<number>`` arguments."""
    for name in names:
        command = F.regexp_replace(command, rf"{name}=[0-9]+", " ")
    return F.trim(F.regexp_replace(command, r"\s+", " "))


def printable(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x20-\x7E]", "")


def with_severity(message: Column, is_error: Column) -> Column:
    """Error messages get the prefix unless they have it."""
    return F.when(is_error & ~F.startswith(message, F.lit("ERROR")), F.concat(F.lit("ERROR: "), message)).otherwise(message)


def progress_line(line: Column) -> Column:
    """Percent, stage or total part of a status line, else NULL."""
    hit = F.regexp_extract(line, PROGRESS_LINE, 1)
    return F.when(hit != "", hit)


def key_value(line: Column, separator: str = ":::") -> tuple[Column, Column, Column]:
    """key, value and whether the line is well formed."""
    parts = F.split(line, separator)
    good = F.size(parts) == 2
    return F.when(good, F.get(parts, 0)), F.when(good, F.get(parts, 1)), good


def duration(seconds: Column) -> Column:
    """Seconds as ``HH:MM:SS.FFF``; hours may exceed 24."""
    millis = F.floor(seconds * 1000 + 0.5)
    whole = F.floor(millis / 1000)
    two = lambda c: F.lpad(c.cast("bigint").cast("string"), 2, "0")
    hours = F.floor(whole / 3600).cast("bigint")
    hour_text = F.when(hours < 100, two(hours)).otherwise(hours.cast("string"))
    return F.concat(hour_text, F.lit(":"), two(F.floor(whole / 60) % 60), F.lit(":"), two(whole % 60),
                    F.lit("."), F.lpad((millis % 1000).cast("bigint").cast("string"), 3, "0"))


def is_metric(line: Column) -> Column:
    """Whether a line fits one of the log patterns; a cheap test goes first."""
    return F.startswith(F.lower(line), F.lit("slice")) & line.rlike("|".join(f"(?:{p})" for p in LOG_PATTERNS.values()))


def metric_name(line: Column) -> Column:
    """Pattern name of a line that fits one of them."""
    low = F.lower(line)
    return (F.when(low.rlike(r"time\sto\sload\ssparse\sdata\s*:"), "time_load").when(low.rlike(r"time\sto\sset\sup\srecon\s*:"), "time_setup")
            .when(low.rlike(r"time\sto\srec[a-z]+\sdata[^:]*:"), "time_recon").otherwise("iterations"))


def metric_slice(line: Column) -> Column:
    return F.regexp_extract(line, r"^\S+\s+([0-9]+)", 1).cast("bigint")


def metric_value(line: Column) -> Column:
    quoted = F.regexp_extract(line, rf'"({NUMBER})"', 1)
    timed = F.regexp_extract(line, rf"(?i):\s+({NUMBER})\sseconds[.]", 1)
    return F.when(metric_name(line) == "iterations", quoted).otherwise(timed).cast("double")


def options(tokens: Column) -> Column:
    """``key=value`` tokens to a map; a bare token maps to 'true', the last one wins."""
    key = lambda t: F.substring_index(t, "=", 1)
    value = lambda t: F.when(F.contains(t, F.lit("=")), F.substring(t, F.locate("=", t) + 1, F.length(t))).otherwise(F.lit("true"))
    put = lambda m, t: F.map_concat(F.map_filter(m, lambda k, _: k != key(t)), F.create_map(key(t), value(t)))
    return F.aggregate(F.filter(tokens, lambda t: t != ""), F.create_map().cast("map<string,string>"), put)


# Defaults of the recovery options.
OPTION_DEFAULTS = {
    "target_machine": "local", "fermi_w1": 0.15, "fermi_w2": 0.75, "chunk_size": 30, "tv_weight": 0.0012,
    "l1_weight": 0.006, "hamming_window": 32, "iterations": 100, "restarts": 0, "wavelet": "Daubechies",
}
