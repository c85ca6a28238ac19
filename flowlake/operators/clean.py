"""Cleaning steps. All but the two dedups are plain projections, so they work on streams as well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.functions.columns import FLOATS, NUMBERS, columns_of, feature_columns, sanitize_columns
from flowlake.functions.safe import finite_or_null, is_infinite, quoted, scrub, try_int

# Columns without signal, dropped before analysis.
DROP_COLUMNS = [
    "arp.dst.proto_ipv4", "arp.opcode", "arp.hw.size", "arp.src.proto_ipv4",
    "icmp.checksum", "icmp.seq_le", "icmp.transmit_timestamp", "icmp.unused",
]


def _project(df: DataFrame, changed: dict) -> DataFrame:
    """Replace the columns in ``changed``, keep the rest and the order, in one projection."""
    return df.select(*[
        changed[c].alias(c) if c in changed else quoted(c) for c in df.columns
    ])


def drop_columns(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Drop the no-signal columns (dotted or underscored spelling) and ``extra``, where present."""
    unwanted = {*DROP_COLUMNS, *[c.replace(".", "_") for c in DROP_COLUMNS], *(extra or [])}
    return df.select(*[quoted(c) for c in df.columns if c not in unwanted])


def replace_infinity(df: DataFrame) -> DataFrame:
    """Positive and negative infinity become null in float columns."""
    return _project(df, {c: F.when(~is_infinite(quoted(c)), quoted(c)) for c in columns_of(df, FLOATS)})


def fill_missing(df: DataFrame, number: float = 0.0, text: str = "unknown") -> DataFrame:
    """Null (and NaN) numbers become ``number``, null strings become ``text``."""
    changed = {}
    for field in df.schema.fields:
        col = quoted(field.name)
        if isinstance(field.dataType, FLOATS):
            filler = F.lit(number).cast(field.dataType)
            changed[field.name] = F.coalesce(F.nanvl(col, filler), filler)
        elif isinstance(field.dataType, NUMBERS):
            changed[field.name] = F.coalesce(col, F.lit(int(number)).cast(field.dataType))
        elif isinstance(field.dataType, T.StringType):
            changed[field.name] = F.coalesce(col, F.lit(text))
    return _project(df, changed)


def fill_median(df: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Fill null and NaN numbers with the column's approximate median: one aggregate, inlined as scalars."""
    names = columns_of(df, FLOATS)
    medians = df.agg(*[
        F.percentile_approx(F.nanvl(quoted(c), F.lit(None).cast("double")), 0.5, accuracy).alias(f"m{i}")
        for i, c in enumerate(names)
    ])
    filled = {}
    for i, c in enumerate(names):
        median = medians.select(f"m{i}").scalar()
        filled[c] = F.coalesce(F.nanvl(quoted(c), median), median)
    return _project(df, filled)


def cast_types(df: DataFrame, label: str = "Attack_label") -> DataFrame:
    """Label and every ``*port*`` column become int; what is not a number becomes null."""
    targets = [c for c in df.columns if c == label or "port" in c.lower()]
    return _project(df, {c: try_int(quoted(c)) for c in targets})


def numeric_scrub(df: DataFrame, columns: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Only ``keep`` plus the given (default: feature) columns as doubles without null or NaN."""
    names = feature_columns(df) if columns is None else columns
    return df.select(*[quoted(c) for c in keep or []], *[scrub(quoted(c)).alias(c) for c in names])


def mask_outliers(df: DataFrame, columns: list[str], limit: float = 1e12) -> DataFrame:
    """NaN, infinities and magnitudes above ``limit`` become null."""
    return _project(df, {c: finite_or_null(quoted(c).cast("double"), limit) for c in columns})


def dedup(df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Distinct rows, or one row per key. Copies are folded map-side, so a hot row costs one per task.

    Rows of one key that differ are settled by ``order``: the one with the greatest values there stays, ties by the whole
    row, so the result does not depend on the layout. Without an order any of them may stay.
    """
    if not keys:
        return df.dropDuplicates()
    if not order:
        return df.dropDuplicates(keys)
    whole = F.struct(*[quoted(c) for c in df.columns])
    best = df.groupBy(*[quoted(k) for k in keys]).agg(
        F.max_by(whole, F.struct(*[quoted(c).alias(f"_{i}") for i, c in enumerate([*order, *df.columns])])).alias("_row"))
    return best.select(*[F.col("_row").getField(c).alias(c) for c in df.columns])


def clean(df: DataFrame, extra_drop: list[str] | None = None, keys: list[str] | None = None) -> DataFrame:
    """The chain: names, dropped columns, infinities, casts, fills, dedup.

    Casts come before fills so that text which is no port ends up as 0 rather than null.
    """
    return clean_rows(df, extra_drop).transform(dedup, keys)


def clean_rows(df: DataFrame, extra_drop: list[str] | None = None) -> DataFrame:
    """The stateless part of ``clean``, shared by batch and stream."""
    return (
        df.transform(sanitize_columns)
        .transform(drop_columns, extra_drop)
        .transform(replace_infinity)
        .transform(cast_types)
        .transform(fill_missing)
    )


def clean_log(df: DataFrame, extra_drop: list[str] | None = None) -> DataFrame:
    """Rows and columns before and after each step of ``clean``; a single shuffle, no step run twice."""
    steps = [
        ("drop_columns", lambda d: drop_columns(sanitize_columns(d), extra_drop)),
        ("replace_infinity", replace_infinity),
        ("cast_types", cast_types),
        ("fill_missing", fill_missing),
    ]
    widths, current = [len(df.columns)], df
    for _, step in steps:
        current = step(current)
        widths.append(len(current.columns))
    counts = (
        current.groupBy(*[quoted(c) for c in current.columns]).agg(F.count(F.lit(1)).alias("_copies"))
        .agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_in"), F.count(F.lit(1)).alias("rows_distinct"))
    )
    names = [name for name, _ in steps] + ["dedup"]
    widths.append(widths[-1])
    entries = [
        F.struct(
            F.lit(i).alias("step_no"),
            F.lit(name).alias("step"),
            F.col("rows_in").alias("rows_before"),
            F.col("rows_distinct" if name == "dedup" else "rows_in").alias("rows_after"),
            F.lit(widths[i]).alias("columns_before"),
            F.lit(widths[i + 1]).alias("columns_after"),
        )
        for i, name in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*entries)))

