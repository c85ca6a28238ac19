"""Derived traffic features: generic builders and the preset of five."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.safe import finite_or, quoted, try_ratio
from flowlake.operators.quality import long_stats

# Names of the derived columns, in output order.
FEATURE_NAMES = [
    "traffic_asymmetry_ratio", "pkt_size_cv", "flow_intensity", "iat_regularity", "conn_efficiency",
]

# The wire columns the preset reads.
WIRE = {
    "ack": "tcp_ack", "ack_raw": "tcp_ack_raw", "seq": "tcp_seq", "len": "tcp_len", "flags": "tcp_flags",
    "checksum": "tcp_checksum", "syn": "tcp_connection_syn", "fin": "tcp_connection_fin",
    "rst": "tcp_connection_rst",
}


class _Wire:
    """The wire columns a table has, under their short names."""

    def __init__(self, df: DataFrame, mapping: dict[str, str] | None):
        self.names = {**WIRE, **(mapping or {})}
        self.present = set(df.columns)

    def has(self, *keys: str) -> bool:
        return all(self.names[k] in self.present for k in keys)

    def __getitem__(self, key: str) -> Column:
        return quoted(self.names[key]).cast("double")


def _asymmetry(w: _Wire) -> Column:
    if w.has("ack", "seq"):
        return try_ratio(w["ack"], w["seq"], 1)
    ack = w["ack_raw"] if w.has("ack_raw") else w["ack"]
    return try_ratio(ack, w["checksum"], 1)


def _pkt_size(w: _Wire) -> Column:
    if w.has("len", "seq", "ack"):
        return try_ratio(w["len"], F.abs(w["seq"] - w["ack"]), 1)
    return w["len"] if w.has("len") else F.lit(0.0)


def _intensity(w: _Wire) -> Column:
    return w["len"] * w["flags"] if w.has("len", "flags") else F.lit(0.0)


def _regularity(w: _Wire) -> Column:
    if w.has("checksum", "len"):
        return try_ratio(w["checksum"], w["len"], 1)
    return w["checksum"] if w.has("checksum") else F.lit(0.0)


def _conn_eff(w: _Wire) -> Column:
    if w.has("syn", "fin", "rst"):
        return try_ratio(w["syn"], w["fin"] + w["rst"], 1)
    return try_ratio(w["syn"], w["fin"], 1) if w.has("syn", "fin") else F.lit(0.0)


FORMULAS = dict(zip(FEATURE_NAMES, [_asymmetry, _pkt_size, _intensity, _regularity, _conn_eff]))


def add_features(df: DataFrame, names: list[str] | None = None, mapping: dict[str, str] | None = None) -> DataFrame:
    """Append the derived columns (default: all five) in one projection; never null, NaN or infinite."""
    wire = _Wire(df, mapping)
    return df.withColumns({n: finite_or(FORMULAS[n](wire)) for n in names or FEATURE_NAMES})


def feature_summary(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """count, mean, stddev, min and max of the derived columns, one row each."""
    return long_stats(df, names or FEATURE_NAMES)
