"""Scoring a stream with models that are replaced while it runs.

Models lie in a folder of versions, ``v=<number>``, each put there whole by one rename. A batch is scored by one version, the
newest when the batch first began; the choice is noted before any row is scored, so a batch that runs again after a loss is scored
by the same version, and a version put there meanwhile is used from the next batch on. Scored batches are committed once and
name their version.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlake.operators.models import save_model, score
from flowlake.streaming.commits import STAGING, committed, move, start_batches

VERSION = "v="


def versions(spark: SparkSession, root: str) -> list[int]:
    return committed(spark, root, VERSION)


def publish(spark: SparkSession, model, root: str) -> int:
    """Save a fitted model as the next version. Of two writers at a time one takes the number after."""
    staged = f"{root}/{STAGING}/{uuid.uuid4().hex}"
    save_model(model, staged)
    while True:
        number = max(versions(spark, root), default=0) + 1
        if move(spark, staged, f"{root}/{VERSION}{number}"):
            return number


@functools.lru_cache(maxsize=4)
def _loaded(path: str) -> PipelineModel:
    return PipelineModel.load(path)  # a version never changes


def load_version(root: str, number: int) -> PipelineModel:
    return _loaded(f"{root}/{VERSION}{number}")


def chosen(spark: SparkSession, root: str, notes: str, number: int) -> int:
    """The version of a batch: the one noted for it, else the newest, which is noted."""
    if not committed(spark, notes, f"{number}-"):
        found = versions(spark, root)
        if not found:
            raise FileNotFoundError(f"no model version under {root}")
        files = spark._jvm.org.apache.hadoop.fs.Path(f"{notes}/{number}-{max(found)}")
        files.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(files)
    return min(committed(spark, notes, f"{number}-"))  # of two notes, which only two runs at a time can leave, the older version


def start_scoring(stream: DataFrame, root: str, path: str, checkpoint: str, labels: list[str] | None = None, keep: list[str] | None = None,
                  every: str | None = None) -> StreamingQuery:
    """Append ``keep`` (default: the columns of the stream), ``prediction``, the class name if ``labels`` are given, and ``model_version``."""
    spark = stream.sparkSession

    def make(batch: DataFrame, number: int) -> DataFrame:
        version = chosen(spark, root, f"{path}/_versions", number)
        names = [*(keep or batch.columns), "prediction", *(["predicted_class"] if labels else [])]
        return score(batch, load_version(root, version), labels).select(*names, F.lit(version).alias("model_version"))

    return start_batches(stream, make, path, checkpoint, every)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """Scored rows of all committed batches, with their ``batch``."""
    if not committed(spark, path):
        raise FileNotFoundError(f"no batch has been scored under {path}")
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*")
