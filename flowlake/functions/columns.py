"""Walks over a schema: which columns, under which names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowlake.functions.safe import quoted

FLOATS = (T.DoubleType, T.FloatType)
NUMBERS = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DecimalType)

# Columns that never serve as model inputs.
NON_FEATURES = [
    "Attack_label", "Attack_type", "attack_type",
    "ingestion_time", "timestamp", "flow_id",
    "source_ip", "dest_ip",
]


def columns_of(df: DataFrame, kinds: tuple) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def sanitize_columns(df: DataFrame, old: str = ".", new: str = "_") -> DataFrame:
    """Replace ``old`` by ``new`` in every column name, in one projection."""
    names = [c.replace(old, new) for c in df.columns]
    seen: dict[str, str] = {}
    for before, after in zip(df.columns, names):
        other = seen.setdefault(after.lower(), before)
        if other != before:
            raise ValueError(f"columns {other!r} and {before!r} both become {after!r}")
    return df.toDF(*names)


def feature_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Numeric columns that are neither labels nor identifiers."""
    skip = set(NON_FEATURES if exclude is None else exclude)
    return [c for c in columns_of(df, NUMBERS) if c not in skip]


def label_column(df: DataFrame, names: tuple[str, ...] = ("Attack_type", "attack_type")) -> str:
    """The first of ``names`` that the table has."""
    for name in names:
        if name in df.columns:
            return name
    raise ValueError(f"none of {names} among {df.columns}")


def prioritised(df: DataFrame, first: list[str], width: int) -> DataFrame:
    """At most ``width`` columns, the ones in ``first`` leading; unchanged if the table is narrower."""
    if len(df.columns) <= width:
        return df
    head = [c for c in first if c in df.columns]
    tail = [c for c in df.columns if c not in head]
    return df.select(*[quoted(c) for c in (head + tail)[:width]])
