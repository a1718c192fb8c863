"""Run options: a table of names, kinds and defaults, compiled to columns over ``key=value`` tokens."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions import text

FLAG, TEXT, NUMBER, WHOLE, NUMBERS, CHOICE = "flag", "text", "number", "whole", "numbers", "choice"
TYPES = {FLAG: "boolean", TEXT: "string", NUMBER: "double", WHOLE: "int", NUMBERS: "array<double>", CHOICE: "string"}


@dataclass(frozen=True)
class Option:
    """``loose`` is the form of a first or second token that names no key; ``bare`` is what a choice without a value means."""

    name: str
    kind: str
    default: object = None
    choices: tuple[str, ...] = ()
    bare: str | None = None
    loose: str | None = None


# Option names, kinds, defaults and loose forms.
OPTIONS = (
    Option("target_machine", TEXT, "local"), Option("CS_reservation", TEXT),
    Option("CS_table", TEXT, loose="(?i)^CS[0-9]+_[0-9]+x_.*$"),
    Option("first_volume", WHOLE), Option("last_volume", WHOLE), Option("chunk_size", WHOLE, 30),
    Option("CS_preview_data", CHOICE, choices=("slice", "volume"), bare="slice"), Option("roll_data", FLAG),
    Option("iteration_strategy", TEXT), Option("re_init_count", WHOLE, 0), Option("Itnlim", WHOLE, 100, loose="^[0-9]+$"),
    Option("TVWeight", NUMBERS, (0.0012,)), Option("xfmWeight", NUMBERS, (0.006,)), Option("hamming_window", WHOLE, 32),
    Option("skip_fermi_filter", FLAG), Option("fermi_w1", NUMBER, 0.15), Option("fermi_w2", NUMBER, 0.75),
    Option("fid_archive", FLAG), Option("wavelet_dims", NUMBERS, (12.0, 12.0)),
    Option("wavelet_type", CHOICE, "Daubechies", ("Haar", "Beylkin", "Coiflet", "Daubechies", "Symmlet", "Vaidyanathan", "Battle")),
    Option("process_headfiles_only", FLAG), Option("skip_target_machine_check", FLAG),
    Option("selected_scale_volume", WHOLE, 0), Option("slicewise_norm", FLAG), Option("convergence_threshold", NUMBER),
    Option("keep_work", FLAG), Option("email_addresses", TEXT), Option("verbosity", WHOLE, 0), Option("scanner_user", TEXT),
    Option("live_run", FLAG), Option("debug_mode", WHOLE, 0),
)


def _named(tokens: Column, options: tuple[Option, ...]) -> Column:
    """Loose first and second tokens with their key; a loose token whose key is also given becomes ``?key``."""

    def key(token: Column, at: Column) -> Column:
        out = token
        for o in (o for o in options if o.loose):
            given = F.exists(tokens, lambda t: F.startswith(t, F.lit(f"{o.name}=")))
            found = F.when(given, F.lit(f"?{o.name}")).otherwise(F.concat(F.lit(f"{o.name}="), token))
            out = F.when(token.rlike(o.loose), found).otherwise(out)
        early = ~F.exists(F.slice(tokens, F.lit(1), at + 1), lambda t: F.contains(t, F.lit("=")))
        return F.when(early, out).otherwise(token)

    return F.concat(F.transform(F.slice(tokens, 1, 2), key), F.slice(tokens, F.lit(3), F.greatest(F.size(tokens), F.lit(1))))


def _typed(o: Option) -> Column:
    """The option's value, or its default where it is unset, has no value, or does not fit."""
    raw = F.try_element_at("_o", F.lit(o.name))
    default = F.array(*map(F.lit, o.default)) if isinstance(o.default, tuple) else F.lit(o.default)
    if o.kind == FLAG:
        return F.coalesce(raw.isNotNull() & ~raw.isin("0", "false"), F.lit(False))
    if o.kind == CHOICE:
        known = F.when(raw.isin(*o.choices), raw).when(raw == "true", F.lit(o.bare))
        return F.coalesce(known, default.cast("string"))
    if o.kind == NUMBERS:
        words = F.split(F.regexp_replace(raw, r"^\[|\]$", ""), r"[, ]+")
        values = F.transform(words, lambda w: w.try_cast("double"))
        return F.coalesce(F.when(~F.exists(values, lambda v: v.isNull()), values), default)
    given = F.when(raw != "true", raw)
    return F.coalesce(given if o.kind == TEXT else given.try_cast(TYPES[o.kind]), default.cast(TYPES[o.kind]))


def _misfit(o: Option) -> Column:
    """What is wrong with the option's text, or null."""
    raw = F.try_element_at("_o", F.lit(o.name))
    given = raw.isNotNull() & (raw != "true")
    bad = F.lit(f"bad {o.name}")
    if o.kind == CHOICE:
        return F.when(given & ~raw.isin(*o.choices), bad)
    if o.kind == NUMBERS:
        words = F.split(F.regexp_replace(raw, r"^\[|\]$", ""), r"[, ]+")
        return F.when(given & F.exists(words, lambda w: w.try_cast("double").isNull()), bad)
    if o.kind in (NUMBER, WHOLE):
        return F.when(given & raw.try_cast(TYPES[o.kind]).isNull(), bad)
    return F.lit(None).cast("string")


def parse_options(df: DataFrame, tokens: str, options: tuple[Option, ...] = OPTIONS) -> DataFrame:
    """One typed column for each option, plus the plan, the weights of its blocks, and ``problems``.

    A token is ``key=value`` or a flag; the last one wins.  The first two tokens may be a loose
    number or mask name as long as none before has a ``=``.  ``iteration_strategy`` ``AxB`` is B
    blocks of A iterations; without it the plan comes from ``Itnlim`` and ``re_init_count``.  One
    weight serves all blocks, else there is one a block.  Nothing is dropped: a row that
    could not run says why in ``problems``.
    """
    known = F.array(*(F.lit(o.name) for o in options))
    read = df.withColumn("_t", _named(F.filter(tokens, lambda t: t != ""), options))
    read = read.withColumn("_o", text.options(F.filter("_t", lambda t: ~F.startswith(t, F.lit("?")))))
    out = read.withColumns({o.name: _typed(o) for o in options})
    plan = F.col("iteration_strategy")
    given = plan.isNotNull()
    good = plan.rlike("^[1-9][0-9]*x[1-9][0-9]*$")
    part = lambda i: F.split(plan, "x")[i].try_cast("int")
    blocks = F.when(given & good, part(1)).when(~given, F.col("re_init_count") + 1)
    each = F.when(given & good, part(0)).when(~given, F.try_divide(F.col("Itnlim"), F.col("re_init_count") + 1))
    out = out.withColumns({"blocks": blocks.cast("int"), "per_block": each.cast("double")})
    spread = lambda w: F.when(F.size(w) == 1, F.array_repeat(F.element_at(w, 1), F.col("blocks"))).otherwise(F.col(w))
    out = out.withColumns({
        "Itnlim": (F.col("per_block") * F.col("blocks")).cast("int"), "re_init_count": F.col("blocks") - 1,
        "TVWeight": spread("TVWeight"), "xfmWeight": spread("xfmWeight"), "fermi_filter": ~F.col("skip_fermi_filter"),
        "wavelet_dims": F.when(F.size("wavelet_dims") == 2, F.col("wavelet_dims")).otherwise(F.array(F.lit(12.0), F.lit(12.0)))})
    uneven = (F.size("TVWeight") != F.col("blocks")) | (F.size("xfmWeight") != F.col("blocks"))
    loose = F.transform(F.filter("_t", lambda t: F.startswith(t, F.lit("?"))),
                        lambda t: F.concat(F.substring(t, 2, 99), F.lit(" given twice")))
    unknown = F.transform(F.array_sort(F.array_except(F.map_keys("_o"), known)), lambda k: F.concat(F.lit("unknown "), k))
    wrong = F.array_compact(F.array(
        *map(_misfit, options), F.when(given & ~good, "bad iteration_strategy"),
        F.when(given & F.col("keep_work"), "keep_work with iteration_strategy"),
        F.when(~given & (F.col("per_block") != F.floor("per_block")), "Itnlim not divisible"),
        F.when(uneven, "weights do not match the blocks")))
    return out.withColumn("problems", F.concat(loose, unknown, wrong)).drop("_t", "_o")
