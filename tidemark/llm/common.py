"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import scratch_dir

#: Of five parts of the labelled rows, this one is never learned from.
FOLDS, HELD_OUT_FOLD = 5, 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, with its partitions kept and its lineage cut.

    The copy lies in the folder that the cluster names in ``spark.checkpoint.dir``, so
    it outlives any executor; a scratch folder is set only where none is named.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def held_out(doc_id: Column) -> Column:
    """True in the fold that is kept for testing; a row without an id is held out too."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(True))


def unit_hash(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / F.lit(float(1 << 40))
