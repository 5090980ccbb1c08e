"""Merge operators for targets without in-place updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_versions(target: DataFrame, changes: DataFrame, sk: str) -> DataFrame:
    """Insert versions by surrogate key; an existing version only gets its new end.

    ``changes`` may hold the open and the closing row of a version, the closing
    one wins. A hash aggregate reduces it before it meets the target.
    """
    latest = changes.groupBy(*[c for c in target.columns if c != "validTo"]).agg(
        F.min("validTo").alias("validTo"))
    incoming = latest.select(*[F.col(c).alias(f"__new_{c}") for c in target.columns])
    merged = target.join(incoming, F.col(sk) == F.col(f"__new_{sk}"), "full")
    exists = F.col(sk).isNotNull()

    def value(c: str):
        if c == "validTo":
            return F.coalesce(F.col("__new_validTo"), F.col(c))
        return F.when(exists, F.col(c)).otherwise(F.col(f"__new_{c}"))

    return merged.select(*[value(c).alias(c) for c in target.columns])


def new_rows(existing: DataFrame, incoming: DataFrame, sk: str) -> DataFrame:
    """Insert-or-ignore: the incoming rows whose key is not there yet, once each."""
    return incoming.dropDuplicates([sk]).join(existing.select(sk), sk, "left_anti")
