"""Temporal joins as equi-joins with a bounded range test.

All of them join on the key and, for keys with very many versions, on a stretch
of time as well. Stretches begin at version starts, so a version lies in
one stretch and a row meets only the versions near it instead of all of its key.
Keys with very many rows on the left are split into parts, and the few
versions they meet are repeated for each part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import END_OF_TIME
from ..functions.columns import valid_at
from .scd2 import latest_per_instant, tie_columns
from .skew import (
    NO_CUTS,
    ROWS_PER_CUT,
    Cuts,
    estimated_bytes,
    find_cuts,
    salt_hot_keys,
    stretch_number,
    with_neighbour,
    with_stretch,
)

# Versions of one key that a row may be compared with, on average.
VERSIONS_PER_CUT = 4096
# Product of estimated sizes (bytes) below which versions per key need no look.
SMALL_PRODUCT = 10**14
# A dimension is broadcast only when its caller proves it has no more rows.
MAX_BROADCAST_ROWS = 500_000


def fits_broadcast(rows: int | None) -> bool:
    return rows is not None and rows <= MAX_BROADCAST_ROWS


def broadcast_within(df: DataFrame, rows: int | None) -> DataFrame:
    """Broadcast hint for a frame of at most ``rows`` rows, if that is small enough."""
    return F.broadcast(df) if fits_broadcast(rows) else df


def _is_small(left: DataFrame, right: DataFrame) -> bool:
    """Whether even all pairs of the two sides would be few."""
    return estimated_bytes(left) * estimated_bytes(right) < SMALL_PRODUCT


def _cuts_of_long_keys(starts: DataFrame, key: str, ts: str, rows_per_cut: int) -> Cuts:
    """Cuts of the keys that have more than ``rows_per_cut`` versions, which short keys do not need.

    Without any, the join is by the key alone and takes versions as their window left them.
    """
    cuts = find_cuts(starts, [key], ts, rows_per_cut=rows_per_cut)
    if not cuts:
        return NO_CUTS
    # At most MAX_CUTS keys, whatever the size of the data.
    counts = starts.join(F.broadcast(cuts.by_key.select(key)), key, "left_semi").groupBy(key).count()
    long = counts.where(F.col("count") > F.lit(rows_per_cut)).select(key)
    keys = long.collect()
    if not keys:
        return NO_CUTS
    kept = starts.sparkSession.createDataFrame(keys, long.schema)
    return Cuts(cuts.by_key.join(F.broadcast(kept), key, "left_semi"))


def point_in_time_join(
    facts: DataFrame,
    dimension: DataFrame,
    on: tuple[str, str],
    ts: str,
    *,
    inclusive_end: bool = False,
    disjoint: bool = False,
    versions_from: DataFrame | None = None,
    keys_from: DataFrame | None = None,
    dimension_rows: int | None = None,
    rows_per_cut: int = VERSIONS_PER_CUT,
    rows_per_part: int = ROWS_PER_CUT,
    how: str = "inner",
    size_of: DataFrame | None = None,
) -> DataFrame:
    """Give each fact the dimension version valid at its ``ts``.

    ``on`` names the key in the facts and in the dimension, which must be
    consolidated. A version gives way to the next version of its key, so a
    delete row that was never closed cannot match beside its successor; pass
    ``disjoint=True`` where the versions are known not to overlap. Facts
    without a valid version are left out (``how="inner"``), kept with NULLs
    (``"left"``) or returned alone (``"left_anti"``).

    ``versions_from``, with columns ``on[1]`` and ``validFrom``, may name a cheaper
    frame with about the same version starts. ``dimension_rows`` is a proven upper
    bound of the dimension's rows; without it Spark chooses the strategy.
    ``keys_from``, with columns ``on[0]`` and ``ts``, may name a cheaper frame with keys
    distributed as in the facts, and ``size_of`` one of about their size.
    """
    fact_key, dim_key = on
    if how != "inner":
        # Rows without key or time match nothing. Kept out of the exchange, they pile up nowhere.
        known = F.col(fact_key).isNotNull() & F.col(ts).isNotNull()
        unknown = facts.where(~known)
        joined = _point_in_time_join(
            facts.where(known), dimension, on, ts, inclusive_end, disjoint, versions_from, keys_from,
            dimension_rows, rows_per_cut, rows_per_part, how, size_of)
        return joined.unionByName(unknown, allowMissingColumns=True)
    return _point_in_time_join(
        facts, dimension, on, ts, inclusive_end, disjoint, versions_from, keys_from, dimension_rows,
        rows_per_cut, rows_per_part, how, size_of)


def _point_in_time_join(
    facts: DataFrame, dimension: DataFrame, on: tuple[str, str], ts: str, inclusive_end: bool,
    disjoint: bool, versions_from: DataFrame | None, keys_from: DataFrame | None,
    dimension_rows: int | None, rows_per_cut: int, rows_per_part: int, how: str,
    size_of: DataFrame | None,
) -> DataFrame:
    fact_key, dim_key = on
    starts = dimension if versions_from is None else versions_from
    starts = starts.select(dim_key, "validFrom")
    right = dimension
    if not disjoint:
        # Partitioned and sorted as a merge join of the key needs it: no extra shuffle.
        right = with_neighbour(right, [dim_key], "validFrom", tie=["validTo"], size_of=starts)
        right = right.withColumn("validTo", F.least("validTo", F.col("next_validFrom") - 1))
        right = right.drop("next_validFrom")
    right = right.withColumnsRenamed(
        {dim_key: "__dim_key", "validFrom": "__from", "validTo": "__to"})
    condition = F.col(fact_key) == F.col("__dim_key")
    left = facts
    cuts = NO_CUTS
    if rows_per_cut != VERSIONS_PER_CUT or not _is_small(size_of or facts, starts):
        cuts = _cuts_of_long_keys(starts, dim_key, "validFrom", rows_per_cut)
    if cuts:
        named = Cuts(cuts.by_key.withColumnRenamed(dim_key, fact_key))
        left = with_stretch(left, named, [fact_key], ts).drop("__cuts")
        named = Cuts(cuts.by_key.withColumnRenamed(dim_key, "__dim_key"))
        right = with_stretch(right, named, ["__dim_key"], "__from")
        # At most one version lies across a cut, so this adds no more rows than cuts.
        last = stretch_number(F.col("__cuts"), F.greatest("__from", "__to"))
        right = right.withColumn(
            "__dim_stretch", F.explode(F.sequence(F.col("__stretch"), last)))
        right = right.drop("__stretch", "__cuts")
        condition &= F.col("__stretch") == F.col("__dim_stretch")
    if not fits_broadcast(dimension_rows):
        stretched = bool(cuts)
        if keys_from is not None and stretched:
            named = Cuts(cuts.by_key.withColumnRenamed(dim_key, fact_key))
            keys_from = with_stretch(keys_from, named, [fact_key], ts)
        salted = salt_hot_keys(
            left, right, [fact_key, "__stretch"] if stretched else [fact_key],
            ["__dim_key", "__dim_stretch"] if stretched else ["__dim_key"],
            spread_by=ts, rows_per_part=rows_per_part, size_of=size_of or facts,
            sample_from=keys_from)
        left, right = salted.left, salted.right
        condition = condition if salted.condition is None else condition & salted.condition
    condition &= valid_at(F.col(ts), F.col("__from"), F.col("__to"), inclusive_end)
    joined = left.join(broadcast_within(right, dimension_rows), condition, how)
    spare = {"__dim_key", "__from", "__to", "__stretch", "__dim_stretch", "__part",
             "__right_part"}
    return joined.select(*[c for c in joined.columns if c not in spare])


def latest_state(changes: DataFrame, key: str, ts: str = "ts_ms") -> DataFrame:
    """The last change of each key; combined in each map task before the shuffle."""
    order = F.struct(*[F.col(c) for c in (ts, *tie_columns(changes))])
    row = F.struct(*[F.col(c) for c in changes.columns])
    return changes.groupBy(key).agg(F.max_by(row, order).alias("r")).select("r.*")


def latest_state_join(
    child: DataFrame,
    parent: DataFrame,
    on: str,
    child_key: str,
    *,
    ts: str = "ts_ms",
    op: str = "op",
    parent_columns: dict[str, str],
    effective_time: str = "greatest",
    parent_rows: int | None = None,
    rows_per_cut: int = VERSIONS_PER_CUT,
    rows_per_part: int = ROWS_PER_CUT,
) -> DataFrame:
    """Join two change feeds so that a change on either side gives the joined row.

    A child version meets every parent version that overlaps it in time; the
    row takes effect when the later of the two does, or at the child's own
    time with ``effective_time="child"``. Children without a parent give no row
    until one appears. Deletes of a parent are ignored, its last columns stay.
    ``parent_columns`` maps parent columns to output names.
    """
    if effective_time not in ("greatest", "child"):
        raise ValueError(f"unknown effective_time: {effective_time}")
    # A delete of a child is an event: its row must not return when the parent changes.
    ahead = F.coalesce(F.col(f"next_{ts}"), F.lit(END_OF_TIME))
    children = latest_per_instant(child, child_key, ts).withColumn(
        "__end", F.when(F.col(op) == "d", F.col(ts) + 1).otherwise(ahead)).drop(f"next_{ts}")
    alive = parent.where(F.col(op) != "d") if op in parent.columns else parent
    parents = latest_per_instant(alive, on, ts).select(
        F.col(on).alias("__parent"), F.col(ts).alias("__from"),
        F.coalesce(F.col(f"next_{ts}"), F.lit(END_OF_TIME)).alias("__to"),
        *[F.col(c).alias(name) for c, name in parent_columns.items()])
    cuts = NO_CUTS
    if rows_per_cut != VERSIONS_PER_CUT or not _is_small(child, alive):
        cuts = _cuts_of_long_keys(alive.select(on, ts), on, ts, rows_per_cut)
    condition = F.col(on) == F.col("__parent")
    if cuts:
        named = Cuts(cuts.by_key.withColumnRenamed(on, "__parent"))
        parents = with_stretch(parents, named, ["__parent"], "__from").drop("__cuts")
        parents = parents.withColumnRenamed("__stretch", "__parent_stretch")
        children = with_stretch(children, cuts, [on], ts)
        # A child is repeated for each stretch it reaches; each holds a parent
        # version it overlaps, so the copies never outnumber the result.
        last = stretch_number(F.col("__cuts"), F.col("__end") - 1)
        children = children.withColumn(
            "__stretch", F.explode(F.sequence(F.col("__stretch"), last))).drop("__cuts")
        condition &= F.col("__stretch") == F.col("__parent_stretch")
    if not fits_broadcast(parent_rows):
        stretched = bool(cuts)
        salted = salt_hot_keys(
            children, parents, [on, "__stretch"] if stretched else [on],
            ["__parent", "__parent_stretch"] if stretched else ["__parent"],
            spread_by=child_key, rows_per_part=rows_per_part, size_of=child,
            sample_from=None if stretched else child)
        children, parents = salted.left, salted.right
        condition = condition if salted.condition is None else condition & salted.condition
    condition &= (F.col("__from") < F.col("__end")) & (F.col(ts) < F.col("__to"))
    joined = children.join(broadcast_within(parents, parent_rows), condition)
    if effective_time == "greatest":
        joined = joined.withColumn(ts, F.greatest(ts, "__from"))
    return joined.select(*child.columns, *parent_columns.values())


def join_state(rows: DataFrame, state: DataFrame, on: str, *, spread_by: str,
               state_rows: int | None = None, rows_per_part: int = ROWS_PER_CUT,
               keys_from: DataFrame | None = None) -> DataFrame:
    """Inner join with one state row per key; hot keys of ``rows`` are split.

    ``keys_from``, with column ``on``, may name a cheaper frame with keys distributed alike.
    """
    right = state.withColumnRenamed(on, "__key")
    condition = F.col(on) == F.col("__key")
    if not fits_broadcast(state_rows):
        salted = salt_hot_keys(rows, right, [on], ["__key"], spread_by=spread_by,
                               rows_per_part=rows_per_part, sample_from=keys_from)
        rows, right = salted.left, salted.right
        condition = condition if salted.condition is None else condition & salted.condition
    joined = rows.join(broadcast_within(right, state_rows), condition)
    return joined.drop("__key", "__part", "__right_part")


def without_match(facts: DataFrame, dimension: DataFrame, on: tuple[str, str], ts: str,
                  **options) -> DataFrame:
    """Facts that no version of the dimension is valid for."""
    return point_in_time_join(facts, dimension, on, ts, how="left_anti", **options)
