"""Settings shared by batch and streaming runs."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Fixed value: open versions end at 9999-12-31T23:59:59Z, in epoch milliseconds.
END_OF_TIME = 253402300799000
# Changes of other times than 1678 to 2261 are implausible, and beyond what pandas can hold.
FIRST_MS, LAST_MS = -9_214_646_400_000, 9_214_646_400_000


@dataclass(frozen=True)
class Settings:
    """Tunable parameters; the defaults are the reference deployment's values.

    ``state_ttl_ms`` of ``None`` keeps the current version of a key for good,
    so that a late closing change always finds the version it closes. ``patience_ms`` is how
    long, in event time, a fact without a valid version waits for one that comes late.
    """

    environment: str | None = None
    root: str = "."
    source_lateness: str = "30 seconds"
    consolidation_lateness: str = "10 seconds"
    buffer_ms: int = 10_000
    window_ms: int = 100_000
    state_ttl_ms: int | None = None
    patience_ms: int = 0
    lookback: str = "36500 days"
    order_grace_ms: int = 100
    batch_rows: int = 1000

    def topic(self, root_name: str) -> str:
        """Topic name with the environment as suffix: ``store.orders.landing.dev``."""
        env = self.environment if self.environment is not None else os.environ.get("ENVIRONMENT")
        return f"{root_name}.{env}" if env else root_name

    def dataset(self, root_name: str) -> str:
        """Path of the directory that stands for a topic or table."""
        return f"{self.root}/{self.topic(root_name)}"


def session_defaults(builder):
    """Session settings the engine relies on; apply before ``getOrCreate``."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates and epochs are UTC whatever the zone of the machine."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory below the cluster's shared checkpoint folder.

    Only where none is named and Spark runs in one process (tests), a temporary
    folder takes its place; a cluster has to name one, as executors do not see the driver's.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = shared or tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
