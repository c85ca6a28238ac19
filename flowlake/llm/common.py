"""Small pieces shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlake.functions.safe import quoted
from flowlake.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

__all__ = ["WORD", "SPACE", "text_of", "words_of", "n_words_of", "packed", "unpacked", "materialise", "read_table",
           "components", "running_start", "shuffle_parts", "Memory", "text_blocks", "looked_up"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(col.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """All words of a text: maximal runs of anything but ASCII white space."""
    return F.regexp_extract_all(text_of(text), F.lit(WORD), F.lit(0))


def n_words_of(text: Column) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def packed(docs: DataFrame) -> DataFrame:
    """One struct column ``row`` holding the whole row, so that added columns cannot clash with its names."""
    return docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"))


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` again, taken from ``row``."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in like.columns])


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Memory:
    """Values made many at a time and kept in two generations of about ``limit`` keys; keys in use move to the younger one."""

    def __init__(self, make, limit: int = 300_000):
        self.make, self.limit, self.young, self.old = make, limit, {}, {}

    def known(self, keys: set) -> dict:
        """A dictionary that has all of ``keys``, and others."""
        missing = keys.difference(self.young)  # asks for each key, where ``-`` would walk all that is kept
        if missing and len(self.young) + len(missing) > self.limit:
            self.old, self.young, missing = self.young, {}, keys
        if missing:
            old = self.old
            again = missing & old.keys()
            self.young.update(zip(again, map(old.__getitem__, again)))
            ask = list(missing - again)
            if ask:
                self.young.update(zip(ask, self.make(ask)))
        return self.young


def text_blocks(ids, texts, size: int = 1 << 20):
    """(ids, texts) of an Arrow batch in blocks of about ``size`` characters, so what is held as Python objects is bounded; null is empty."""
    numbers, block, held = [], [], 0
    for number, text in zip(ids, texts):
        text = text.as_py() or ""
        if block and held + len(text) > size:
            yield numbers, block
            numbers, block, held = [], [], 0
        numbers.append(number.as_py())
        block.append(text)
        held += len(text)
    if block:
        yield numbers, block


HOT_KEYS = 20_000
HOT_ROWS = 10_000


def looked_up(big: DataFrame, keys: list[str], small: DataFrame) -> DataFrame:
    """Left join on ``keys``, unique in ``small`` and never null. ``big`` should be stored, it is read twice.

    A key with 1/``HOT_KEYS`` of the rows of ``big`` (and ``HOT_ROWS`` of them) is hot; so there are at most ``HOT_KEYS`` of these, and their
    rows of ``small`` are broadcast. The other keys are joined by exchange.
    """
    limit = max(HOT_ROWS, -(-big.count() // HOT_KEYS))
    hot = materialise(big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= limit).select(*keys), "hot")
    if hot.isEmpty():
        return big.join(small, keys, "left")
    few = F.broadcast(materialise(small.join(F.broadcast(hot), keys).withColumn("_hot", F.lit(True)), "hot-rows"))
    found = [c for c in small.columns if c not in keys]
    tried = big.join(few, keys, "left")
    rest = tried.filter("_hot is null").select(*big.columns).join(small, keys, "left")
    return tried.filter("_hot").select(*big.columns, *found).unionByName(rest.select(*big.columns, *found))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (``a``, ``b``): one row (``node``, ``root``) per node, root = smallest node.

    Each round every remaining root points to its smallest neighbour if that is smaller, the pointers are followed to
    their ends by doubling, and the edges are contracted. Only grouped minima and joins on keys run, each round is
    written to the shared scratch folder, and nothing but one row count per round reaches the driver.
    """
    links = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    links = materialise(links.union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    while not links.isEmpty():
        parent = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
        parent = materialise(parent.select("node", F.least("node", "up").alias("up")), "parents")
        while True:  # follow the pointers, twice as far each time
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("higher"))
            moved = materialise(
                parent.join(above, "up", "left")
                .select("node", F.coalesce("higher", "up").alias("up"), (F.col("higher") < F.col("up")).alias("moved")),
                "parents",
            )
            parent = moved.drop("moved")
            if moved.filter("moved").isEmpty():
                break
        to = parent.withColumnRenamed("node", "root")
        roots = materialise(
            roots.join(to, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots"
        )
        one = parent.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        two = parent.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        links = materialise(
            links.join(one, "a").join(two, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
            .filter("a <> b").distinct(),
            "links",
        )
    return roots


def running_start(df: DataFrame, group: list[str], order: list[Column], size: str, name: str, rows_per_part: int = 50_000,
                  total: str | None = None) -> DataFrame:
    """Add ``name``: the sum of ``size`` over the earlier rows of the group, in a random order fixed by ``order[0]``.

    ``order[0]`` must be a uniform 63-bit hash; the others break its ties. Rows of a group are dealt over buckets by the
    hash's top bits (as many as the whole table needs to hold about ``rows_per_part`` rows each), summed per bucket,
    and the buckets' sums are added up; so no task holds a whole group. ``total`` adds the group's sum.
    """
    bits = max(0, (df.count() // rows_per_part).bit_length())
    dealt = df.withColumn("_h", order[0]).withColumn("_bucket", F.shiftright("_h", 63 - bits) if bits else F.lit(0).cast("long"))
    keys = [*group, "_bucket"]
    sums = dealt.groupBy(*keys).agg(F.sum(size).alias("_s"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(k).alias(f"_o{k}") for k in keys], F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"),
                          F.sum("_s").over(whole).alias("_all"))
    local = Window.partitionBy(*keys).orderBy("_h", *order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    walked = dealt.withColumn("_local", F.coalesce(F.sum(size).over(local), F.lit(0)))
    joined = walked.join(offsets, [F.col(k).eqNullSafe(F.col(f"_o{k}")) for k in keys])
    extra = {name: F.col("_before") + F.col("_local")} | ({total: F.col("_all")} if total else {})
    return joined.withColumns(extra).drop("_h", "_bucket", "_local", "_before", "_all", *[f"_o{k}" for k in keys])
