"""Casts, guards, names and cleaning steps on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from flowlake.functions import safe
from flowlake.functions.columns import feature_columns, label_column, prioritised, sanitize_columns
from flowlake.functions.hashing import RESOLUTION, draw
from flowlake.operators import clean as C
from flowlake.operators import quality as Q
from flowlake.operators.features import FEATURE_NAMES, add_features

NAN, INF = float("nan"), float("inf")
VALUES = [1.0, -1.0, 0.0, NAN, INF, -INF, None]


@pytest.fixture
def values(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v double")


def column(df, col):
    return [r[0] for r in df.orderBy("i").select(col).collect()]


def test_finite_or(values):
    assert column(values, safe.finite_or(F.col("v"), 9.0)) == [1.0, -1.0, 0.0, 9.0, 9.0, 9.0, 9.0]


def test_finite_or_null_limit(values):
    assert column(values, safe.finite_or_null(F.col("v"), 0.5)) == [None, None, 0.0, None, None, None, None]


def test_try_ratio_zero_denominator(values):
    got = column(values, safe.try_ratio(F.lit(2.0), F.col("v"), 1))
    assert got[:3] == [1.0, None, 2.0] and math.isnan(got[3]) and got[4:] == [0.0, 0.0, None]


def test_numbers_from_text(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(["80", "80.9", "n/a", "", None, "-3.7"])], "i int, s string")
    assert column(df, safe.try_int(F.col("s"))) == [80, 80, None, None, None, -3]
    assert column(df, safe.scrub(F.col("s"))) == [80.0, 80.9, 0.0, 0.0, 0.0, -3.7]


def test_sanitize_collision(spark):
    with pytest.raises(ValueError, match="a.b"):
        sanitize_columns(spark.createDataFrame([(1, 2)], ["a.b", "a_b"]))
    assert sanitize_columns(spark.createDataFrame([(1, 2)], ["a.b", "c.d.e"])).columns == ["a_b", "c_d_e"]


def test_schema_walks(spark):
    df = spark.createDataFrame([(1, 1.0, "x", 0, "s")], "a int, b double, Attack_type string, Attack_label int, flow_id string")
    assert feature_columns(df) == ["a", "b"]
    assert label_column(df) == "Attack_type"
    with pytest.raises(ValueError):
        label_column(df.select("a"))
    assert prioritised(df, ["flow_id", "Attack_label"], 3).columns == ["flow_id", "Attack_label", "a"]


def test_clean_chain(spark):
    rows = [
        (1.0, None, "80.9", None, 1), (1.0, None, "80.9", None, 1), (INF, 2, "n/a", "x", None), (NAN, 3, None, "", 0),
    ]
    df = spark.createDataFrame(rows, "`tcp.ack` double, n long, `tcp.srcport` string, host string, Attack_label int")
    df = df.withColumn("arp.opcode", F.lit(1.0))
    got = {tuple(r) for r in C.clean(df).collect()}
    assert got == {(1.0, 0, 80, "unknown", 1), (0.0, 2, 0, "x", 0), (0.0, 3, 0, "", 0)}
    assert C.clean(df).columns == ["tcp_ack", "n", "tcp_srcport", "host", "Attack_label"]
    log = {r["step"]: r for r in C.clean_log(df).collect()}
    assert (log["dedup"]["rows_before"], log["dedup"]["rows_after"]) == (4, 3)
    assert (log["drop_columns"]["columns_before"], log["drop_columns"]["columns_after"]) == (6, 5)


def test_clean_empty(spark):
    df = spark.createDataFrame([], "a double, s string")
    assert C.clean(df).count() == 0
    assert C.clean_log(df).agg(F.max("rows_before")).first()[0] == 0


def test_fill_median(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,), (None,), (NAN,)], "v double")
    assert sorted(r[0] for r in C.fill_median(df).collect()) == [1.0, 3.0, 3.0, 3.0, 5.0]


def test_features_by_hand(spark):
    df = spark.createDataFrame(
        [(6.0, 2.0, 10.0, 3.0, 22.0, 1.0, 1.0, 0.0), (6.0, -1.0, -1.0, 3.0, 22.0, 1.0, -1.0, 0.0), (INF, 1.0, None, 1.0, NAN, 0.0, 0.0, 0.0)],
        "tcp_ack double, tcp_seq double, tcp_len double, tcp_flags double, tcp_checksum double, "
        "tcp_connection_syn double, tcp_connection_fin double, tcp_connection_rst double",
    )
    rows = [tuple(r) for r in add_features(df).select(*FEATURE_NAMES).collect()]
    assert rows == [(2.0, 2.0, 30.0, 2.0, 0.5), (0.0, -0.125, -3.0, 0.0, 0.0), (0.0, 0.0, 0.0, 0.0, 0.0)]


def test_feature_fallbacks(spark):
    df = spark.createDataFrame([(8.0, 3.0)], "tcp_ack_raw double, tcp_checksum double")
    assert tuple(add_features(df).select(*FEATURE_NAMES).first()) == (2.0, 0.0, 0.0, 3.0, 0.0)
    df = spark.createDataFrame([(8, 3, 4, 1)], "tcp_ack int, tcp_checksum int, tcp_len int, tcp_connection_syn int")
    assert tuple(add_features(df).select(*FEATURE_NAMES).first()) == (2.0, 4.0, 0.0, 0.6, 0.0)
    df = df.withColumn("tcp_connection_fin", F.lit(1))
    assert add_features(df, ["conn_efficiency"]).first()["conn_efficiency"] == 0.5


def test_missing_kinds(spark):
    df = spark.createDataFrame([(1.0, "a", 1), (NAN, "", 2), (None, "NaN", None), (2.0, None, 3)], "x double, s string, n int")
    got = {r["column_name"]: (r["missing_count"], r["missing_pct"]) for r in Q.missing_values(df).collect()}
    assert got == {"x": (2, 50.0), "s": (3, 75.0), "n": (1, 25.0)}
    assert [r["column_name"] for r in Q.missing_top(df, 2).collect()] == ["s", "x"]
    whole = Q.missing_values(df.filter("false")).collect()
    assert all(r["missing_count"] == 0 and r["missing_pct"] == 0.0 for r in whole)


def test_require(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert Q.require(df, ["a"]) is df
    with pytest.raises(ValueError, match=r"\['b', 'c'\]"):
        Q.require(df, ["a", "b", "c"])


def test_draw_is_stable_and_even(spark):
    df = spark.range(20000).select("id", draw([F.col("id")], 7).alias("d"))
    share = df.filter(F.col("d") < int(0.3 * RESOLUTION)).count() / 20000
    assert abs(share - 0.3) < 0.02
    again = df.repartition(13).orderBy("id").limit(5).collect()
    assert again == df.orderBy("id").limit(5).collect()
