"""Fields of messages that a schema does not know, or that come in another type.

Texts are read as variants, so no schema is needed to see all of a message. The ledger has one row per field and type, with how many
messages have it; counts of batches add up, so the ledger of a stream is the sum over its batches. A field that a message repeats
counts once, as the last one stands. Only top-level fields are listed; an object or array is one field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowlake.streaming.commits import committed, start_batches

LEDGER = "field string, type string, status string, n long"
WHOLE, REAL = "BIGINT", "DOUBLE"


def _expected(kind: T.DataType) -> list[str]:
    """Types of JSON values that a column of this type takes without loss; a null fits any."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return [WHOLE]
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return [WHOLE, REAL]
    if isinstance(kind, T.BooleanType):
        return ["BOOLEAN"]
    if isinstance(kind, T.ArrayType):
        return ["ARRAY"]
    return ["OBJECT"] if isinstance(kind, (T.StructType, T.MapType)) else ["STRING"]


def _kind(value: Column) -> Column:
    """Type of a variant without sizes and inner types."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.when(name.isin("DECIMAL", "FLOAT", "DOUBLE"), REAL).when(name.isin("TINYINT", "SMALLINT", "INT", "BIGINT"), WHOLE).otherwise(name)


def fields_of(df: DataFrame, column: str = "json_payload") -> DataFrame:
    """``field, type``: one row per top-level field of every message that is an object."""
    spark = df.sparkSession
    read = df.select(F.try_parse_json(F.col(column)).alias("_v")).filter(F.schema_of_variant("_v").startswith("OBJECT"))
    return read.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer())).select(F.col("key").alias("field"), _kind(F.col("value")).alias("type"))


def ledger(df: DataFrame, schema: T.StructType, column: str = "json_payload") -> DataFrame:
    """``field, type, status, n``; the status is ``known``, ``retyped`` or ``unknown`` against ``schema`` (names with their case)."""
    counts = fields_of(df, column).groupBy("field", "type").agg(F.count(F.lit(1)).alias("n"))
    status = F.lit("unknown")
    for f in schema.fields:
        fits = F.col("type").isin([*_expected(f.dataType), "VOID"])
        status = F.when(F.col("field") == f.name, F.when(fits, "known").otherwise("retyped")).otherwise(status)
    return counts.select("field", "type", status.alias("status"), "n")


def drifted(book: DataFrame) -> DataFrame:
    return book.filter("status <> 'known'")


def merged_schema(df: DataFrame, column: str = "json_payload") -> DataFrame:
    """One row: the type that holds all messages of ``df``, as text."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column))).alias("schema"))


def start_ledger(stream: DataFrame, schema: T.StructType, path: str, checkpoint: str, column: str = "json_payload",
                 every: str | None = None) -> StreamingQuery:
    """Keep the counts of every batch under ``path``, each batch once."""
    return start_batches(stream, lambda batch, _: ledger(batch, schema, column), path, checkpoint, every)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger of all batches, with the first and last batch that had the field so."""
    shape = f"{LEDGER}, batch long"
    rows = spark.read.schema(shape).option("basePath", path).parquet(f"{path}/batch=*") if committed(spark, path) else spark.createDataFrame([], shape)
    return rows.groupBy("field", "type", "status").agg(F.sum("n").alias("n"), F.min("batch").alias("first_batch"), F.max("batch").alias("last_batch"))
