"""Placement of documents on shards by a lookup table that the shards fill in turns.

Every shard has a preference order over the slots of a table of prime size: an offset and a
skip, both from hashes of its name, whose multiples run through all slots. Shards take turns
claiming the next slot they prefer that is still free, until the table is full, so every
shard holds nearly the same number of slots (times its weight), and taking a shard away moves
few documents but its own. A document's slot is a hash of its key; one lookup gives its shard.

The table has a fixed number of slots, so it is shipped to all executors whatever the number
of documents, and the lookup is an array access, constant in time and without a shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime well above a hundred slots for each of up to 600 shards.
SLOTS = 65537
#: The largest table that is shipped.
MOST_SLOTS = 1 << 22


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS,
                 weights: list[int] | None = None) -> np.ndarray:
    """For every slot, the position in ``shards`` of the shard that has claimed it.

    Shards are asked in the order of their names, so their order in the list is no matter. A
    shard of weight k claims k slots in each of its turns.
    """
    if not _is_prime(slots) or slots > MOST_SLOTS:
        raise ValueError(f"the number of slots must be a prime up to {MOST_SLOTS}")
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards must be named, each once, and be no more than the slots")
    if weights is not None and (len(weights) != len(shards) or min(weights) < 1):
        raise ValueError("every shard needs a weight of at least 1")
    order = sorted(range(len(shards)), key=lambda s: shards[s])
    digests = [hashlib.blake2b(name.encode(), digest_size=16).digest() for name in shards]
    nexts = [int.from_bytes(d[:8], "big") % slots for d in digests]
    skips = [int.from_bytes(d[8:], "big") % (slots - 1) + 1 for d in digests]
    table, free = [-1] * slots, slots
    while free:
        for s in order:
            for _ in range(weights[s] if weights else 1):
                if not free:
                    break
                at = nexts[s]
                while table[at] >= 0:
                    at = (at + skips[s]) % slots
                table[at] = s
                nexts[s] = (at + skips[s]) % slots
                free -= 1
    return np.array(table, np.int32)


def slot_of(keys: list[Column], slots: int = SLOTS) -> Column:
    """Slot of a key; a NULL among the columns counts as a value of its own."""
    parts = [p for k in keys for p in (k.isNull(), k)]
    return F.pmod(F.xxhash64(*parts), F.lit(slots)).cast("int")


def place(docs: DataFrame, shards: list[str], *, keys: tuple[str, ...] = ("doc_id",),
          slots: int = SLOTS, weights: list[int] | None = None) -> DataFrame:
    """``docs`` with ``slot, shard, shard_name``.

    One row for each row of ``docs``, placed by its key alone: repeated rows and equal keys
    share a shard, NULL keys share one too. Where one key has a large share of the rows, pass
    more columns as key to spread it. Texts are not read. Columns of ``docs`` with one of the
    three names are replaced; an empty table stays empty.
    """
    table = lookup_table(shards, slots, weights)
    spark: SparkSession = docs.sparkSession
    entries = spark.createDataFrame(
        [(slot, int(s), shards[s]) for slot, s in enumerate(table.tolist())],
        "slot int, shard int, shard_name string")
    kept = [c for c in docs.columns if c not in ("slot", "shard", "shard_name")]
    keyed = docs.select(F.struct(F.lit(0), *[F.col(f"`{c}`") for c in kept]).alias("_row"),
                        slot_of([F.col(f"`{k}`") for k in keys], slots).alias("slot"))
    return keyed.join(F.broadcast(entries), "slot").select(
        *[F.col(f"_row.`{c}`") for c in kept], "slot", "shard", "shard_name")


def moved_share(before: np.ndarray, before_names: list[str], after: np.ndarray,
                after_names: list[str]) -> float:
    """Share of slots whose shard differs between two tables of one size."""
    a, b = np.array(before_names)[before], np.array(after_names)[after]
    return float((a != b).mean())


def write_shards(placed: DataFrame, path: str, *, tasks_a_shard: int = 1) -> None:
    """Write every shard into a folder of its own, ``shard=k``.

    Rows of a shard are dealt over ``tasks_a_shard`` tasks by a hash of the row, so a shard
    of any size is written by several tasks and files.
    """
    part = F.pmod(F.xxhash64(*placed.columns), F.lit(tasks_a_shard))
    (placed.withColumn("_part", part).repartition("shard", "_part").drop("_part")
     .write.mode("errorifexists").partitionBy("shard").parquet(path))
