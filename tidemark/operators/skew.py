"""Ordered neighbours per key without putting a whole key into one task.

Versioning needs, for each row, the next row of its key. A window over the key
does that with one shuffle, but a key that holds a third of the table would
then be sorted by one task. So long keys are cut into stretches of time first
and the window runs per key and stretch.

The cuts are timestamps that occur in the data, chosen by a hash of key and
timestamp: about one in ``rows_per_cut`` instants becomes a cut. A cut is the
first instant of its stretch, so the neighbour across a boundary is known from
the cut itself and no second pass over the data is needed. Short keys have
no cut and keep the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Cuts are collected and broadcast, so their number has a fixed limit. When
# there would be more, the cuts are thinned, which only makes stretches longer.
MAX_CUTS = 100_000
ROWS_PER_CUT = 4_000_000
# A group of rows of one instant counts as hot from this many sampled rows on.
HOT_SAMPLES = 8

# Below this estimated size no key can be too long for one task.
SMALL_BYTES = 64 << 20

_STRETCH, _CUTS = "__stretch", "__cuts"


@dataclass(frozen=True)
class Cuts:
    """Chosen cuts (a small frame: key columns and ``__cuts``) and hot instants."""

    by_key: DataFrame | None
    hot_instants: DataFrame | None = None

    def __bool__(self) -> bool:
        return self.by_key is not None


NO_CUTS = Cuts(None)


def estimated_bytes(df: DataFrame) -> int:
    """The size the optimizer assumes, as for its own choice of join."""
    if df.isStreaming:
        return 1 << 62
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(str(size))
    except AttributeError:  # a Connect session does not expose it
        return 1 << 62


def find_cuts(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    *,
    tie: Sequence[str] = (),
    carry: Sequence[str] = (),
    latest: bool = False,
    rows_per_cut: int = ROWS_PER_CUT,
    max_cuts: int | None = None,
    size_of: DataFrame | None = None,
) -> Cuts:
    """Choose cuts with one pass over key, time and carried columns only.

    ``carry`` columns of the first row of each cut (the last with ``latest``)
    travel with it. Instants with very many rows, as left by redelivered
    messages, are reported as well; a random row sample finds them.
    Which cuts are chosen never changes a result. With the default
    ``rows_per_cut`` the pass is left out where ``size_of`` (or the input) is small.
    """
    if rows_per_cut == ROWS_PER_CUT and estimated_bytes(size_of or df) < SMALL_BYTES:
        return NO_CUTS
    limit = MAX_CUTS if max_cuts is None else max_cuts
    edge = F.max if latest else F.min
    chosen = F.pmod(F.xxhash64(*keys, ts), F.lit(rows_per_cut)) == 0
    sampled = F.rand(17) < F.lit(1.0 / rows_per_cut)
    at = [*keys, ts]
    carried = list(dict.fromkeys([*tie, *carry])) or [ts]
    value = F.struct(*[F.col(c) for c in carried])
    found = (
        df.where(F.col(ts).isNotNull())
        .select(*keys, ts, value.alias("v"), chosen.alias("chosen"), sampled.alias("sampled"))
        .where("chosen OR sampled")
        .groupBy(*at)
        .agg(edge("v").alias("v"), F.any_value("chosen").alias("chosen"),
             F.count_if("sampled").alias("hits"))
        .where(F.col("chosen") | (F.col("hits") >= HOT_SAMPLES))
    )
    rows = found.limit(limit + 1).collect()
    if len(rows) > limit:
        return find_cuts(df, keys, ts, tie=tie, carry=carry, latest=latest,
                         rows_per_cut=rows_per_cut * 16, max_cuts=limit)
    spark = df.sparkSession
    cuts = [r for r in rows if r["chosen"]]
    hot = [tuple(r[c] for c in at) for r in rows if r["hits"] >= HOT_SAMPLES]
    by_key = hot_instants = None
    if cuts:
        stops = F.struct(F.col(ts).alias("at"), F.col("v"))
        by_key = (
            spark.createDataFrame([(*[r[c] for c in at], r["v"]) for r in cuts],
                                  found.select(*at, "v").schema)
            .groupBy(*keys)
            .agg(F.sort_array(F.collect_list(stops)).alias(_CUTS))
        )
    if hot:
        hot_instants = spark.createDataFrame(hot, found.select(*at).schema)
    return Cuts(by_key, hot_instants)


def stretch_number(cuts: Column, ts: Column, *, after: bool = False) -> Column:
    """Number of cuts at or before ``ts`` (strictly before it with ``after``).

    Binary search over the sorted array, by halving steps.
    """
    steps = F.array(*[F.lit(1 << i) for i in range(MAX_CUTS.bit_length(), -1, -1)])

    def step_up(position: Column, step: Column) -> Column:
        ahead = F.get(cuts, position + step - 1)["at"]
        passed = (ahead < ts) if after else (ahead <= ts)
        inside = position + step <= F.size(cuts)
        return F.when(inside & passed, position + step).otherwise(position)

    return F.when(cuts.isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), step_up))


def with_stretch(df: DataFrame, cuts: Cuts, keys: Sequence[str], ts: str,
                 *, after: bool = False) -> DataFrame:
    """Add the stretch of each row, and the cuts of its key."""
    # At most MAX_CUTS entries in all, whatever the size of the data.
    marked = df.join(F.broadcast(cuts.by_key), list(keys), "left").select(*df.columns, _CUTS)
    return marked.withColumn(_STRETCH, stretch_number(F.col(_CUTS), F.col(ts), after=after))


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    *,
    tie: Sequence[str] = (),
    carry: Sequence[str] | None = None,
    previous: bool = False,
    prefix: str | None = None,
    rows_per_cut: int = ROWS_PER_CUT,
    cuts: Cuts | None = None,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """Add columns of the next (or previous) row of the same key, in order of
    ``ts`` and then ``tie``, as ``next_<column>`` or ``previous_<column>``."""
    carry = list(carry if carry is not None else [ts])
    prefix = prefix or ("previous_" if previous else "next_")
    if cuts is None:
        cuts = find_cuts(df, keys, ts, tie=tie, carry=carry, latest=previous,
                         rows_per_cut=rows_per_cut, size_of=size_of)
    columns = [F.col(c) for c in df.columns]
    shift = F.lag if previous else F.lead
    order = [F.col(ts), *[F.col(c) for c in tie]]
    if not cuts:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.select(*columns, *[shift(c).over(window).alias(prefix + c) for c in carry])

    marked = with_stretch(df, cuts, keys, ts, after=previous)
    window = Window.partitionBy(*keys, _STRETCH).orderBy(*order)
    # Over the boundary: the cut that opens the next stretch, or closes the one before.
    across = F.get(F.col(_CUTS), F.col(_STRETCH) - (1 if previous else 0))
    across = F.when(F.col(_STRETCH) > 0, across) if previous else across
    marked = marked.withColumn("__across", across).drop(_CUTS)
    at_edge = shift(F.lit(1)).over(window).isNull()
    return marked.select(
        *columns,
        *[F.when(at_edge, F.col(f"__across.v.{c}")).otherwise(shift(c).over(window))
          .alias(prefix + c) for c in carry],
    )


def collapse_instants(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str],
                      hot_instants: DataFrame | None) -> DataFrame:
    """Reduce each hot instant to its last row before anything is shuffled by key.

    Copies are combined inside each map task, so a third of the table being
    copies of one row costs one row per task.
    """
    if hot_instants is None:
        return df
    at = [*keys, ts]
    marked = df.join(F.broadcast(hot_instants.withColumn("__hot", F.lit(True))), at, "left")
    row = F.struct(*[F.col(c) for c in df.columns])
    last = (
        marked.where("__hot")
        .groupBy(*at)
        .agg(F.max_by(row, F.struct(*[F.col(c) for c in tie]) if tie else F.lit(0)).alias("r"))
        .select("r.*")
    )
    return marked.where("__hot IS NULL").select(*df.columns).unionByName(last)


@dataclass(frozen=True)
class Salted:
    """Both sides of a join and the equality that its salt adds, if any."""

    left: DataFrame
    right: DataFrame
    condition: Column | None


def salt_hot_keys(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    *,
    spread_by: str,
    rows_per_part: int = ROWS_PER_CUT,
    size_of: DataFrame | None = None,
    sample_from: DataFrame | None = None,
    max_keys: int | None = None,
) -> Salted:
    """Split the rows that ``left`` has on its hot keys, for a join with ``right``.

    A key of about ``rows_per_part`` rows or more is split into parts of that
    size; the rows of ``right`` with that key are repeated once per part.
    Adaptive execution would only do this where both sides are freshly
    shuffled, and here the right side usually comes out of a window. Hot keys are
    found by a random sample of the key columns; which ones are found never
    changes a result, so ``sample_from`` may name a cheaper frame whose keys are
    distributed alike. A row's part follows from ``spread_by`` and its input task, so
    copies of one row spread too.
    """
    if rows_per_part == ROWS_PER_CUT and estimated_bytes(size_of or left) < SMALL_BYTES:
        return Salted(left, right, None)
    if left.isStreaming:
        return Salted(left, right, None)
    limit = MAX_CUTS if max_keys is None else max_keys
    rate = min(1.0, 2.0 * HOT_SAMPLES / rows_per_part)
    expected = rows_per_part * rate
    found = (
        (sample_from or left).select(*left_keys).where(F.rand(29) < F.lit(rate))
        .groupBy(*left_keys).count().where(F.col("count") >= F.lit(expected / 2))
        .limit(limit + 1).collect()
    )
    if len(found) > limit:
        return salt_hot_keys(left, right, left_keys, right_keys, spread_by=spread_by,
                             rows_per_part=rows_per_part * 16, sample_from=sample_from,
                             max_keys=limit)
    hot = [(*r[:-1], int(r["count"] / (expected / 2)) + 1)
           for r in found if all(v is not None for v in r[:-1])]
    if not hot:
        return Salted(left, right, None)
    schema = left.select(*left_keys, F.lit(0).alias("__parts")).schema
    # At most MAX_CUTS rows, whatever the size of the data.
    parts = F.broadcast(left.sparkSession.createDataFrame(hot, schema))
    spot = F.pmod(F.xxhash64(spread_by) + F.spark_partition_id(), F.col("__parts"))
    marked = left.join(parts, list(left_keys), "left").select(
        *left.columns, F.coalesce(spot, F.lit(0)).cast("int").alias("__part"))
    named = parts.withColumnsRenamed(dict(zip(left_keys, right_keys)))
    repeated = right.join(named, list(right_keys), "left").select(
        *right.columns,
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - 1))
        .alias("__right_part"))
    return Salted(marked, repeated, F.col("__part") == F.col("__right_part"))
