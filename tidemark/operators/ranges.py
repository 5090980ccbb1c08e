"""As-of joins over sorted ranges, for keys of any size.

Facts and versions are laid out together, sorted by key and time into ranges. Ranges are cut
by size alone, so a key that holds a third of all rows is spread over many of them, and so
is a key with very many versions. Within a range each fact takes the version ahead of it by a
window; what a range inherits from those before it follows from one row a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import scratch_dir


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's shared folder, with its partitions as they are."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def as_of_join(
    facts: DataFrame,
    dimension: DataFrame,
    on: tuple[str, str],
    ts: str,
    take: Sequence[str],
    *,
    inclusive_end: bool = False,
    how: str = "inner",
    ranges: int | None = None,
) -> DataFrame:
    """Give each fact the columns ``take`` of the dimension version valid at its ``ts``.

    The version that began last by then is the one, if it has not ended: versions of a key give
    way to each other as the next begins, so they may overlap. Of versions that began at one instant the one with the
    latest end counts. ``how`` is ``inner``, ``left`` or ``left_anti``, as in
    ``point_in_time_join``. Facts without key or time match nothing. Any size of key takes the same
    way: one range sort of both sides, of which a version is narrow.
    """
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"unknown how: {how}")
    fact_key, dim_key = on
    known = F.col(fact_key).isNotNull() & F.col(ts).isNotNull()
    row = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    version = F.struct(F.col("validTo").alias("__stop"), *[F.col(c) for c in take])
    key_type = facts.schema[fact_key].dataType
    ours = facts.where(known).select(
        F.col(fact_key).alias("key"), F.col(ts).alias("at"), F.lit(1).alias("kind"),
        F.lit(None).cast("bigint").alias("stop"), row.alias("fact"),
        F.lit(None).cast(dimension.select(version.alias("v")).schema["v"].dataType).alias("version"))
    theirs = dimension.where(F.col(dim_key).isNotNull()).select(
        F.col(dim_key).cast(key_type).alias("key"), F.col("validFrom").alias("at"), F.lit(0).alias("kind"),
        F.col("validTo").alias("stop"), F.lit(None).cast(ours.schema["fact"].dataType).alias("fact"),
        version.alias("version"))
    order = ["key", "at", "kind", "stop"]
    both = ours.unionByName(theirs)
    laid = both.repartitionByRange(ranges, *order) if ranges else both.repartitionByRange(*order)
    laid = checkpointed(laid.sortWithinPartitions(*order)).withColumn("range", F.spark_partition_id())
    inherited = _inherited(laid)
    before = Window.partitionBy("range", "key").orderBy("at", "kind", "stop").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    met = laid.select("range", "key", "at", "kind", "fact",
                      F.last("version", ignorenulls=True).over(before).alias("version"))
    met = met.where("kind = 1")
    if inherited is not None:
        # One row a range at most.
        met = met.join(F.broadcast(inherited), ["range", "key"], "left").withColumn(
            "version", F.coalesce("version", "carried"))
    stop = F.col("version.__stop")
    valid = F.coalesce(F.col("at") <= stop if inclusive_end else F.col("at") < stop, F.lit(False))
    if how == "left_anti":
        joined = met.where(~valid).select("fact.*")
    else:
        joined = (met.where(valid) if how == "inner" else met).select(
            "fact.*", *[F.when(valid, F.col(f"version.{c}")).alias(c) for c in take])
    if how == "inner":
        return joined
    return joined.unionByName(facts.where(~known), allowMissingColumns=True)


def _inherited(laid: DataFrame) -> DataFrame | None:
    """``range, key, carried``: the version that a range's first key brings from earlier ranges."""
    by_range = laid.groupBy("range").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    last = F.max(_ordered(F.col("version").isNotNull(), "at", "stop")).alias("latest")
    of_last = (laid.select("range", "key", "at", "stop", "version")
               .join(F.broadcast(by_range.select("range", F.col("last").alias("key"))), ["range", "key"])
               .groupBy("range").agg(last))
    # One row a range comes to the driver, whatever the size of the tables.
    latest = {r["range"]: r["latest"] for r in of_last.collect()}
    carried, key, held = [], None, None
    for r in sorted(by_range.collect(), key=lambda r: r["range"]):
        if held is not None and r["first"] == key:
            carried.append((r["range"], key, held))
        own = latest.get(r["range"])
        if own is not None:
            held = own["version"]
        elif r["last"] != key:
            held = None
        key = r["last"]
    if not carried:
        return None
    schema = laid.select("range", "key", F.col("version").alias("carried")).schema
    return laid.sparkSession.createDataFrame(carried, schema)


def _ordered(wanted: Column, *by: str) -> Column:
    return F.when(wanted, F.struct(*by, "version"))
