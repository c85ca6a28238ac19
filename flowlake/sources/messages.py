"""Wire events: enrichment of flow records, JSON messages, and the streams that carry them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.functions.columns import FLOATS
from flowlake.functions.safe import is_infinite, quoted

# Envelope fields, and where each is taken from when a record lacks it.
ENVELOPE = ["flow_id", "source_ip", "dest_ip", "timestamp", "attack_type"]
SOURCE_FROM = ["source_ip", "ip.src_host", "arp.src.proto_ipv4"]
DEST_FROM = ["dest_ip", "ip.dst_host", "arp.dst.proto_ipv4"]
SOURCE_PORT_FROM = ["tcp.srcport", "udp.port"]
DEST_PORT_FROM = ["tcp.dstport"]
NO_ADDRESS = "0.0.0.0"
NO_PORT = "0"
NORMAL = "Normal"

# Formats whose stream needs a schema.
FILE_FORMATS = ["parquet", "orc", "json", "csv", "text"]


def _first(df: DataFrame, names: list[str], default: str) -> Column:
    """First non-empty of the columns that exist, as text."""
    found = [F.nullif(quoted(c).cast("string"), F.lit("")) for c in names if c in df.columns]
    return F.coalesce(*found, F.lit(default))


def enrich(df: DataFrame, timestamp: Column, id_from: list[str] | None = None) -> DataFrame:
    """Add the envelope fields a record lacks.

    ``timestamp`` is the event's own time, so that a replay yields the same ``flow_id``. By default the
    id is ``source:port-target:port-timestamp-digest``, readable and with a digest of all columns, so only exact
    copies share it; ``id_from`` names the columns to build it from instead.
    """
    every = df.columns
    # Names are compared without case: a table cannot hold both spellings of the label.
    label = next((c for c in df.columns if c.lower() == "attack_type"), "attack_type")
    df = df.withColumns({
        "timestamp": timestamp.cast("string"),
        "source_ip": _first(df, SOURCE_FROM, NO_ADDRESS),
        "dest_ip": _first(df, DEST_FROM, NO_ADDRESS),
        label: _first(df, [label], NORMAL),
    })
    if "flow_id" in df.columns:
        return df
    if id_from:
        return df.withColumn("flow_id", _row_digest(id_from))
    return df.withColumn("flow_id", F.concat(
        F.col("source_ip"), F.lit(":"), _first(df, SOURCE_PORT_FROM, NO_PORT), F.lit("-"),
        F.col("dest_ip"), F.lit(":"), _first(df, DEST_PORT_FROM, NO_PORT), F.lit("-"), F.col("timestamp"),
        F.lit("-"), _row_digest(every),
    ))


def _row_digest(names: list[str]) -> Column:
    """MD5 of the cells as JSON, where a null, an empty text and a separator inside a text all differ."""
    cells = F.struct(*[quoted(c).cast("string").alias(f"c{i}") for i, c in enumerate(names)])
    return F.md5(F.to_json(cells, {"ignoreNullFields": "false"}))


# What reads as a number.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _guess(text: Column) -> Column:
    """Text as a variant: a number if it reads as one (double with a dot, else integer) and is finite, else a string."""
    # The pattern comes first: a failed cast of an address is far dearer than a failed match.
    real = text.try_cast("double")
    number = F.when(text.rlike(NUMBER) & text.contains("."), F.when(~is_infinite(real), real))
    whole = F.when(text.rlike(NUMBER) & ~text.contains("."), text.try_cast("long"))
    return F.coalesce(whole.cast("variant"), number.cast("variant"), text.cast("variant"))


def _payload(df: DataFrame, guess: bool) -> Column:
    """JSON object of the non-empty fields."""
    def member(field: T.StructField) -> Column:
        col = quoted(field.name)
        if not guess:
            return col
        if isinstance(field.dataType, FLOATS):  # infinities and NaN are no JSON numbers and become text
            return F.when(F.isnan(col) | is_infinite(col), col.cast("string").cast("variant")).otherwise(col.cast("variant"))
        if isinstance(field.dataType, T.NumericType):
            return col
        return _guess(F.nullif(col.cast("string"), F.lit("")))

    return F.to_json(F.struct(*[member(f).alias(f.name) for f in df.schema.fields]))


def to_messages(df: DataFrame, key: str = "source_ip", guess: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``key`` and JSON ``value`` per row. ``guess`` types the text fields of an untyped source."""
    body = df.drop(*(keep or []))
    return df.select(
        quoted(key).cast("string").alias("key"), _payload(body, guess).alias("value"),
        *[quoted(c) for c in keep or []],
    )


def write_messages(messages: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Hand messages to a batch sink; for a broker pass ``topic`` and its address as options."""
    writer = messages.write.format(fmt).options(**options)
    (writer if fmt == "kafka" else writer.mode("append")).save()


def message_stream(spark: SparkSession, brokers: str, topic: str, fmt: str = "kafka", **options: str) -> DataFrame:
    """Messages of a topic from the beginning; gaps in retention do not stop the stream."""
    settings = {
        "kafka.bootstrap.servers": brokers, "subscribe": topic,
        "startingOffsets": "earliest", "failOnDataLoss": "false", **options,
    }
    return payloads(spark.readStream.format(fmt).options(**settings).load())


def payloads(messages: DataFrame) -> DataFrame:
    """Raw layer columns from broker records: the body as text and its arrival time."""
    return messages.select(
        F.col("value").cast("string").alias("json_payload"), F.col("timestamp").alias("ingestion_time")
    )


def table_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """Stream a table: the folder (or a glob) of a file format, or a table format that knows its own schema."""
    reader = spark.readStream.format(fmt)
    if fmt in FILE_FORMATS:
        reader = reader.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.load(path)


def envelope_schema(base: T.StructType, extra: list[str] | None = None) -> T.StructType:
    """The base fields plus the envelope fields not yet among them, compared without case."""
    fields = list(base.fields)
    taken = {f.name.lower() for f in fields}
    for name in ENVELOPE if extra is None else extra:
        if name.lower() not in taken:
            taken.add(name.lower())
            fields.append(T.StructField(name, T.StringType()))
    return T.StructType(fields)


def parse_payload(df: DataFrame, schema: T.StructType, column: str = "json_payload") -> DataFrame:
    """Replace the JSON text by its fields. A wrongly typed field is null; see ``unreadable``.

    The fields come out of a generator, so each text is parsed once: filters on the fields stay above
    it, where a projection would let them repeat the parse.
    """
    others = [c for c in df.columns if c != column]
    return df.select(F.inline(F.array(F.from_json(column, schema))), *others)


def unreadable(schema: T.StructType) -> Column:
    """True for a parsed row without a single field: text that is no object, or an empty one."""
    return F.coalesce(*[quoted(f.name).cast("string") for f in schema.fields]).isNull()
