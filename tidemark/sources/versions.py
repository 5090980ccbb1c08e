"""Dimension tables that are merged into batch by batch.

A table is a folder of immutable commits and a list of manifests. A merge adds one commit, with the
versions that its changes leave open and those that they close, and reads nothing that is held:
what a version was first merged with counts, and its earliest end, which readers and
:func:`compact` find by its surrogate key. Each manifest names the commits that make up the table.

    commits/<id>/version_end=closed/key_bucket=<b>/      manifests/<number>
    commits/<id>/version_end=open/key_bucket=<b>/

A manifest is written beside and renamed into place, so readers see a whole one or none, and
a merge that dies leaves only a commit that nothing names. Files are deleted by
:func:`vacuum` alone, so a reader finishes on the manifest it began with. Each table has one
writer at a time, as a stream with its checkpoint is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import END_OF_TIME
from ..functions.columns import packed_key, unpacked_key
from .sinks import exists, hadoop_path, stream_id

BUCKETS = 64
# The merge that a stored row came with.
_MERGE = "__merge"


@dataclass(frozen=True)
class Manifest:
    """What a table consists of after a number of merges.

    ``merged`` holds the last batch of each stream. A new checkpoint gives a stream a new id,
    so its numbers, which begin anew, are not taken for repetitions. ``parts`` are all commits,
    oldest first; ``opened`` has those that a bucket's open versions follow from, and ``closed`` those
    with closed versions.
    """

    number: int = -1
    buckets: int = BUCKETS
    opened: dict[str, list[str]] = field(default_factory=dict)
    closed: tuple[str, ...] = ()
    merged: dict[str, int] = field(default_factory=dict)
    parts: tuple[str, ...] = ()

    def commits(self) -> set[str]:
        return set(self.parts)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    files, at = hadoop_path(spark, f"{path}/manifests")
    if not files.exists(at):
        return []
    names = [s.getPath().getName() for s in files.listStatus(at)]
    return sorted(int(n) for n in names if n.isdigit())


def manifest(spark: SparkSession, path: str, number: int | None = None) -> Manifest:
    """The last manifest, or the one with ``number``; an empty one for a table without any."""
    numbers = _numbers(spark, path)
    if not numbers:
        return Manifest()
    files, at = hadoop_path(spark, f"{path}/manifests/{numbers[-1] if number is None else number}")
    stream = files.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    read = json.loads(text)
    # Older manifests name one commit for each bucket.
    opened = {b: [c] if isinstance(c, str) else c for b, c in read["opened"].items()}
    parts = read.get("parts") or dict.fromkeys([*read["closed"], *(c for held in opened.values() for c in held)])
    return Manifest(**{**read, "opened": opened, "closed": tuple(read["closed"]), "parts": tuple(parts)})


def _commit(spark: SparkSession, path: str, new: Manifest) -> None:
    files, draft = hadoop_path(spark, f"{path}/manifests/.{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(asdict(new)).encode()))
    finally:
        stream.close()
    target = f"{path}/manifests/{new.number}"
    if exists(spark, target) or not files.rename(draft, hadoop_path(spark, target)[1]):
        raise RuntimeError(f"another writer has made manifest {new.number} of {path}")


def _folded(rows: DataFrame, sk: str, within: Sequence[str] = ()) -> DataFrame:
    """One row per version: as it was first merged, with its earliest end."""
    rest = [c for c in rows.columns if c not in (sk, _MERGE, "validTo", *within)]
    first = F.struct(F.coalesce(_MERGE, F.lit(-1)).alias(_MERGE), "validTo", *rest)
    kept = rows.groupBy(*within, sk).agg(F.min(first).alias("__first"), F.min("validTo").alias("validTo"))
    return kept.select(*within, sk, f"__first.{_MERGE}", *[F.col(f"__first.{c}").alias(c) for c in rest], "validTo")


def _write(rows: DataFrame, path: str, sk: str, buckets: int) -> str:
    """Fold rows into a commit with one shuffle: by bucket and, as a bucket may be large, slice of it,
    so that not every task writes to each; adaptive execution joins small ones. The names
    of the folders' columns are none that a dimension has."""
    name = uuid.uuid4().hex
    slices = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // buckets)
    hashed = F.xxhash64(sk)
    place = {"key_bucket": F.pmod(hashed, F.lit(buckets)).cast("int"),
             "__slice": F.pmod(F.shiftright(hashed, 32), F.lit(slices)).cast("int")}
    placed = rows.withColumns(place).withColumn(sk, packed_key(sk)).repartition(*place)
    state = F.when(F.col("validTo") == END_OF_TIME, "open").otherwise("closed")
    (_folded(placed, sk, list(place)).drop("__slice")
     .withColumns({sk: unpacked_key(sk), "version_end": state})
     .write.partitionBy("version_end", "key_bucket").parquet(f"{path}/commits/{name}"))
    return name


def _written(spark: SparkSession, path: str, commit: str, state: str) -> list[str]:
    """The buckets that a commit has rows of."""
    files, at = hadoop_path(spark, f"{path}/commits/{commit}/version_end={state}")
    if not files.exists(at):
        return []
    names = [s.getPath().getName() for s in files.listStatus(at)]
    return [n.removeprefix("key_bucket=") for n in names if n.startswith("key_bucket=")]


def _read(spark: SparkSession, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    # Paths of several commits are no partitions of one folder.
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)


def _rows(spark: SparkSession, path: str, schema: T.StructType, at: Manifest,
          commits: Sequence[str]) -> DataFrame:
    """The stored rows of the commits, with their merge's number."""
    paths = [f"{path}/commits/{c}/version_end=open/key_bucket={b}" for c in commits
             for b in _written(spark, path, c, "open") if c in at.opened.get(b, ())]
    paths += [f"{path}/commits/{c}/version_end=closed" for c in commits if c in at.closed]
    return _read(spark, T.StructType([*schema, T.StructField(_MERGE, T.LongType())]), paths)


def read_versions(spark: SparkSession, path: str, schema: T.StructType, sk: str,
                  number: int | None = None) -> DataFrame:
    """The dimension table: one row per version; as of an earlier manifest with ``number``.

    A version that a repeated change has opened again after its end counts as closed.
    """
    at = manifest(spark, path, number)
    rows = _rows(spark, path, schema, at, at.parts).withColumn(sk, packed_key(sk))
    return _folded(rows, sk).withColumn(sk, unpacked_key(sk)).select(*schema.fieldNames())


def merge_versions(changes: DataFrame, path: str, sk: str, number: int | None = None, *,
                   buckets: int = BUCKETS, compact_from: int | None = 16) -> None:
    """Merge changelog rows into the dimension table at ``path``.

    ``number`` names a micro-batch of the stream that runs; a number that its stream has merged
    is skipped, so a retry changes nothing. ``buckets`` counts for a new table. With
    ``compact_from`` parts or more, small ones are joined.
    """
    spark = changes.sparkSession
    at = manifest(spark, path)
    stream = stream_id(spark) or "batch"
    if number is not None and number <= at.merged.get(stream, -1):
        return
    at = replace(at, buckets=at.buckets if at.number >= 0 else buckets)
    merged = {**at.merged, stream: at.merged.get(stream, -1) + 1 if number is None else number}
    after = replace(at, number=at.number + 1, merged=merged)
    name = _write(changes.withColumn(_MERGE, F.lit(after.number).cast("bigint")), path, sk, at.buckets)
    after = _with_part(spark, path, after, name)
    _commit(spark, path, after)
    if compact_from is not None and max(map(len, (after.closed, *after.opened.values())), default=0) >= compact_from:
        compact(spark, path, changes.schema, sk)


def _with_part(spark: SparkSession, path: str, at: Manifest, name: str) -> Manifest:
    ended = _written(spark, path, name, "closed")
    touched = {*_written(spark, path, name, "open"), *ended}
    if not touched:
        return at
    opened = {**at.opened, **{b: [*at.opened.get(b, ()), name] for b in touched}}
    return replace(at, opened=opened, closed=(*at.closed, *([name] if ended else ())), parts=(*at.parts, name))


def compact(spark: SparkSession, path: str, schema: T.StructType, sk: str) -> None:
    """Join the newest commits into one, and leave out open versions that ended among them.

    A commit with closed versions joins while it is at most twice the size of all newer ones
    together, so a row is rewritten as often as the table doubles. Older manifests stay readable.
    """
    at = manifest(spark, path)
    joined, size = [], 0
    for commit in reversed(at.closed):
        files, place = hadoop_path(spark, f"{path}/commits/{commit}/version_end=closed")
        own = files.getContentSummary(place).getLength()
        if len(joined) > 1 and own > 2 * size:
            break
        joined.append(commit)
        size += own
    # Where nearly nothing has ended, all of it.
    begin = at.parts.index(joined[-1]) if 1 < len(joined) < len(at.closed) else 0
    kept, newest = at.parts[:begin], at.parts[begin:]
    if len(newest) < 2:
        return
    name = _write(_rows(spark, path, schema, at, newest), path, sk, at.buckets)
    held = {b: [c for c in commits if c in kept] for b, commits in at.opened.items()}
    before = replace(at, number=at.number + 1, parts=kept, closed=tuple(c for c in at.closed if c in kept),
                     opened={b: commits for b, commits in held.items() if commits})
    _commit(spark, path, _with_part(spark, path, before, name))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the last ``keep`` manifests, and the commits that only those others name.

    Not to be run beside a merge, whose commit no manifest names yet, and ``keep`` has to cover
    the manifests that readers may still be at.
    """
    numbers = _numbers(spark, path)
    kept = numbers[-keep:]
    named = set().union(*(manifest(spark, path, n).commits() for n in kept)) if kept else set()
    files, commits = hadoop_path(spark, f"{path}/commits")
    for n in numbers[:-keep]:
        files.delete(hadoop_path(spark, f"{path}/manifests/{n}")[1], False)
    if files.exists(commits):
        for status in files.listStatus(commits):
            if status.getPath().getName() not in named:
                files.delete(status.getPath(), True)
