"""Documents with every oddity, and the same with columns whose names clash with what operators add."""

LONG = " ".join(f"w{i % 997}" for i in range(60_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards box nearby and nobody minds at all today. "

ROWS = [
    (1, PROSE * 2, "en", "a"),
    (2, PROSE * 2, "en", "a"),  # an exact copy
    (3, PROSE * 2 + "indeed", "en", "b"),  # a near copy
    (4, None, "en", "b"),
    (5, "", None, None),
    (6, "   \n\t ", "de", None),
    (7, "Ein kurzer Text über Äpfel und Öl; password: hunter2x AKIA" + "Z" * 16, "de", "c"),
    (7, "Ein kurzer Text über Äpfel und Öl; password: hunter2x AKIA" + "Z" * 16, "de", "c"),  # a repeated row
    (8, LONG, "xx", "a"),
    (9, "😀 " * 30 + "0123456789abcdef" * 3, "en", "z"),
    (None, "no id at all, but words enough to be a text", "en", "a"),
    (11, "A b C", "en", "c"),
    (12, "a B c", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def documents(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)


def clashing(spark):
    """The odd documents with names that operators use themselves."""
    from pyspark.sql import functions as F
    names = ["n_chars", "size", "row", "spans", "kept", "_n", "_copies", "piece", "length", "target", "component_id", "text_hash", "_m", "a b", "x.y"]
    return documents(spark).select("*", *[F.lit(i).cast("long").alias(n) for i, n in enumerate(names)])


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
