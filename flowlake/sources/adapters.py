"""Adapters that give the supplied tables the shape of flow records.

They are projections over one scan, with every kind of dirty value the operators have to handle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Class of each line number; the rest are the last one.
CLASSES = ["Normal", "DDoS_UDP", "Port_Scanning", "Ransomware", "MITM"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flow_projection(lines: DataFrame) -> DataFrame:
    """Flow records from order lines; every 17th key occurs twice as an exact copy. Works on streams."""
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    null = F.lit(None)
    key = F.col("l_orderkey") * 10 + line
    # The class follows the line number, the return flag and the quantity in part, and is arbitrary for one row in eight.
    noise = F.conv(F.substring(F.md5(key.cast("string")), 1, 4), 16, 10).cast("int")
    kind = (
        F.when(noise % 8 == 0, noise.bitwiseAND(F.lit(1792)) / 256)
        .when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25), 7)
        .when(part % 5 == 0, F.least(line + 2, F.lit(7))).otherwise(line)
    )
    flows = lines.select(
        key.alias("flow_key"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        F.when(part % 61 == 0, F.lit("n/a"))
        .otherwise(((F.col("l_orderkey") * 37 + line * 3607) % 864000).cast("string")).alias("frame_time"),
        F.when(part % 53 == 0, null)
        .when(part % 89 == 0, F.lit(float("nan")))
        .when(part % 97 == 0, F.lit(float("inf")))
        .when(part % 101 == 0, F.lit(float("-inf")))
        .otherwise(F.col("l_extendedprice")).alias("tcp_ack"),
        F.when(F.col("l_quantity") == 50, F.lit(-1.0)).otherwise(F.col("l_quantity")).alias("tcp_seq"),
        F.when(part % 47 != 0, F.round(F.col("l_tax") * 1000)).alias("tcp_len"),
        line.cast("double").alias("tcp_flags"),
        supp.cast("double").alias("tcp_checksum"),
        (part % 2).cast("double").alias("tcp_connection_syn"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("tcp_connection_fin"),
        F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0).alias("tcp_connection_rst"),
        F.when(part % 59 == 0, F.lit("n/a")).otherwise((part % 60000 + 1024).cast("string")).alias("tcp_srcport"),
        F.when(supp % 13 != 0, F.concat(F.lit("10.0.0."), (supp % 256).cast("string"))).alias("source_ip"),
        F.concat(F.lit("10.0.1."), line.cast("string")).alias("dest_ip"),
        F.when(kind <= 3, CLASSES[0]).when(kind == 4, CLASSES[1]).when(kind == 5, CLASSES[2])
        .when(kind == 6, CLASSES[3]).otherwise(CLASSES[4]).alias("Attack_type"),
        F.when(kind <= 3, 0).otherwise(1).alias("Attack_label"),
    )
    copies = F.array_repeat(F.lit(1), F.when(F.col("flow_key") % 17 == 0, 2).otherwise(1))
    return flows.select("*", F.explode(copies).alias("_copy")).drop("_copy")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_projection(table(spark, sf_dir, "lineitem"))


# Underscored name -> name on the wire.
DOTTED = {
    "frame_time": "frame.time", "tcp_ack": "tcp.ack", "tcp_seq": "tcp.seq", "tcp_len": "tcp.len",
    "tcp_flags": "tcp.flags", "tcp_checksum": "tcp.checksum", "tcp_connection_syn": "tcp.connection.syn",
    "tcp_connection_fin": "tcp.connection.fin", "tcp_connection_rst": "tcp.connection.rst",
    "tcp_srcport": "tcp.srcport", "source_ip": "ip.src_host", "dest_ip": "ip.dst_host",
}


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow records under their dotted wire names, with some of the no-signal columns."""
    return raw_projection(flows(spark, sf_dir))


def raw_projection(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(c).alias(DOTTED.get(c, c)) for c in df.columns],
        (F.col("flow_key") % 3).cast("double").alias("arp.opcode"),
        F.when(F.col("source_ip").isNull(), F.concat(F.lit("192.168.0."), (F.col("flow_key") % 200).cast("string")))
        .alias("arp.src.proto_ipv4"),
        (F.col("flow_key") % 7).cast("double").alias("icmp.checksum"),
        F.when(F.col("flow_key") % 4 == 0, (F.col("flow_key") % 50000).cast("string")).alias("tcp.dstport"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored table: five classes, right in seven rows of ten, with a probability per class."""
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    label = F.greatest(line - 3, F.lit(0)).cast("double")
    guess = F.when(part % 10 < 7, label).otherwise((supp % 4).cast("double"))
    weights = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.when(i == guess, 0.6).otherwise(0.1))
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + line).alias("flow_key"),
        label.alias("label"), guess.alias("prediction"), weights.alias("probability"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A run log from orders: one run each, with a few tags and two steps of every metric."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    kinds = F.create_map(*[
        F.lit(x)
        for pair in zip(
            ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
            ["LogisticRegression", "Decision Tree", "random_forest", "GBT_OneVsRest", "Naive-Bayes"],
        )
        for x in pair
    ])
    start = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + key
    base = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("r"), key.cast("string")).alias("run_uuid"), key.alias("k"), cust.alias("c"),
        kinds[F.col("o_orderpriority")].alias("kind"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED").when(F.col("o_orderstatus") == "O", "RUNNING")
        .otherwise("FAILED").alias("status"),
        start.alias("start_time"),
        F.when(cust % 3 == 0, "binary").otherwise("multiclass").alias("task"),
    )
    k, c = F.col("k"), F.col("c")

    def tag(name, value):
        return F.struct(F.lit(name).alias("key"), value.alias("value"))

    names = ["accuracy", "f1_score", "precision", "recall", "log_loss", "auc_roc"]
    steps = F.array(*[
        F.struct(
            F.lit(name).alias("key"),
            (((k * 31 + c * 17 + i * 101 + s * 53) % 1000) / F.lit(1000.0)).alias("value"),
            F.lit(s).cast("long").alias("step"), (F.col("start_time") + s * 1000).alias("logged_at"),
        )
        for i, name in enumerate(names) for s in (0, 1)
    ])
    logged = (F.col("key") != "auc_roc") | (F.col("task") == "binary")
    logged = logged & ((F.col("key") != "f1_score") | (k % 13 != 0))
    return {
        "runs": base.select(
            "run_uuid", F.concat(F.lower("kind"), F.lit("_v"), (k % 7).cast("string")).alias("name"), "status",
            "start_time", (F.col("start_time") + (c % 977) * 1037 + 250).alias("end_time"),
            F.lit(1).cast("long").alias("experiment_id"),
        ),
        "tags": base.select("run_uuid", F.inline(F.array(
            tag("model_type", F.when(k % 11 != 0, F.col("kind"))),
            tag("classification_type", F.col("task")),
            tag("num_classes", F.when(F.col("task") == "binary", "2").otherwise("5")),
        ))).filter("value is not null"),
        "metrics": base.select("run_uuid", "k", "task", F.inline(steps)).filter(logged).drop("k", "task"),
    }


def event_records(df: DataFrame) -> DataFrame:
    """Feed messages from the event table, every tenth event sent twice. Works on streams."""
    copies = F.array_repeat(F.lit(1), F.when(F.col("event_id") % 10 == 0, 2).otherwise(1))
    return df.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
        F.concat(F.lit("10.1.0."), (F.col("user_id") % 250).cast("string")).alias("source_ip"),
        F.col("event_type").alias("attack_type"), "value", F.explode(copies).alias("_copy"),
    ).drop("_copy")
