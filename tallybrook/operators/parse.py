"""Delimited text lines to typed columns (batch and streaming input)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.functions.text import is_not_blank, strip_controls

POLICIES = ("fail", "drop", "quarantine")


def _fields(line: Column, sep: str) -> Column:
    """Split a trimmed line; empty fields at its end do not count as fields."""
    if sep in ",;|":
        rest = F.rtrim(line, F.lit(sep))
        sep = re.escape(sep)
    else:
        rest = F.regexp_replace(line, f"(?:{sep})+$", "")
    return F.when(rest != "", F.split(rest, sep)).otherwise(F.array().cast("array<string>"))


def parse_records(
    df: DataFrame,
    sep: str,
    schema: T.StructType | str,
    *,
    value: str = "value",
    min_fields: int | None = None,
    max_fields: int | None = None,
    on_arity: str = "drop",
    on_bad: str = "fail",
) -> DataFrame:
    """Split each line of ``value`` at the regex ``sep`` and cast the leading fields to ``schema``.

    Blank and null lines are skipped. Lines are trimmed before the split and fields after it, of
    everything up to U+0020. ``min_fields`` defaults to the schema's length; ``max_fields=None``
    ignores surplus fields. ``on_arity`` and ``on_bad`` (a field that does not cast) each take:

    * ``"fail"``: the job fails when such a line is read;
    * ``"drop"``: the line is left out;
    * ``"quarantine"``: the line is kept with null fields, its text in ``bad_line`` and the cause in
      ``bad_reason``, which are null for good lines. Separate them with :func:`good` and :func:`bad`.

    All other columns of ``df`` are kept.
    """
    for policy in (on_arity, on_bad):
        if policy not in POLICIES:
            raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    least = len(fields) if min_fields is None else min_fields
    kept = [c for c in df.columns if c != value]

    line = strip_controls(F.col(value))
    # A generator with one row: the split is done once, and not again in every filter on its result
    # that the optimizer would otherwise push below it.
    split = df.where(is_not_blank(F.col(value))).select(
        *kept,
        F.inline(F.array(F.struct(line.alias("_line"), _fields(line, sep).alias("_fields")))),
    )
    size = F.size("_fields")
    arity_ok = size >= least if max_fields is None else size.between(least, max_fields)
    raw = [strip_controls(F.get("_fields", F.lit(i))) for i in range(len(fields))]
    cast = [
        r if isinstance(f.dataType, T.StringType) else r.try_cast(f.dataType)
        for r, f in zip(raw, fields)
    ]
    # A field that has to be there is unreadable when its cast is null, an optional one only if it
    # was there.
    readable = F.lit(True)
    for i, f in enumerate(fields):
        if not isinstance(f.dataType, T.StringType):
            readable = readable & (
                cast[i].isNotNull() if i < least else cast[i].isNotNull() | raw[i].isNull()
            )

    for is_ok, policy, cause in ((arity_ok, on_arity, "arity"), (readable, on_bad, "value")):
        if policy == "fail":
            message = F.concat(F.lit(f"record with bad {cause}: "), F.col("_line"))
            is_ok = F.when(is_ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        if policy != "quarantine":
            # A short line has nothing to cast, so it must not count as unreadable too.
            keep_arity = cause == "value" and on_arity == "quarantine"
            split = split.where(is_ok | ~arity_ok if keep_arity else is_ok)

    typed = [c.alias(f.name) for c, f in zip(cast, fields)]
    if "quarantine" not in (on_arity, on_bad):
        return split.select(*kept, *typed)
    reason = F.when(~arity_ok, "arity").when(~readable, "value").alias("bad_reason")
    tagged = split.select(*kept, "_line", *typed, reason)
    is_good = F.col("bad_reason").isNull()
    return tagged.select(
        *kept,
        *[F.when(is_good, F.col(f.name)).alias(f.name) for f in fields],
        F.when(~is_good, F.col("_line")).alias("bad_line"),
        "bad_reason",
    )


def good(parsed: DataFrame) -> DataFrame:
    """The well-formed rows of a quarantining parse."""
    return parsed.where(F.col("bad_reason").isNull()).drop("bad_line", "bad_reason")


def bad(parsed: DataFrame) -> DataFrame:
    """The quarantined lines of a quarantining parse."""
    return parsed.where(F.col("bad_reason").isNotNull())


def parse_pairs(df: DataFrame, schema: T.StructType | str, **options) -> DataFrame:
    """Whitespace-separated ``id number`` lines; a short line or a bad number fails the job."""
    return parse_records(df, r"\s+", schema, **{"on_arity": "fail", "on_bad": "fail", **options})


def parse_csv_records(
    df: DataFrame, schema: T.StructType | str, *, exact: bool = True, **options
) -> DataFrame:
    """Comma-separated lines; a wrong field count drops the line, a bad number fails the job."""
    width = len((T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields)
    bounds = {"min_fields": width, "max_fields": width if exact else None}
    return parse_records(df, ",", schema, **{**bounds, **options})
