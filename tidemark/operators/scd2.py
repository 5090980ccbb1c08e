"""Type-2 versions from row changes.

One window per key (see :mod:`skew` for very long keys) gives everything: ties,
version ends and deletes. The changelog form and the consolidated form are
both row-wise views of that result, so neither needs a second shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import END_OF_TIME
from ..functions.columns import acceptance_window_end, surrogate_key
from .skew import ROWS_PER_CUT, collapse_instants, find_cuts, with_neighbour

TIE_BREAK = ("lsn", "emitted_ts_ms")


def tie_columns(df: DataFrame, tie: Sequence[str] = TIE_BREAK) -> list[str]:
    return [c for c in tie if c in df.columns]


def latest_per_instant(
    changes: DataFrame, key: str, ts: str = "ts_ms", *,
    tie: Sequence[str] | None = None, rows_per_cut: int = ROWS_PER_CUT,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """Keep the last change of each key and instant and add ``next_<ts>``.

    A row is the last of its instant when the next row of its key is later, so
    the same window finds ties and version ends.
    """
    tie = tie_columns(changes) if tie is None else list(tie)
    changes = changes.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    cuts = find_cuts(changes, [key], ts, tie=tie, carry=[ts], rows_per_cut=rows_per_cut,
                     size_of=size_of)
    changes = collapse_instants(changes, [key], ts, tie, cuts.hot_instants)
    ahead = with_neighbour(changes, [key], ts, tie=tie, cuts=cuts)
    following = F.col(f"next_{ts}")
    return ahead.where(following.isNull() | (following > F.col(ts)))


def scd2_versions(
    changes: DataFrame,
    key: str,
    attrs: Mapping[str, Column | str],
    *,
    sk: str,
    entity: str,
    ts: str = "ts_ms",
    op: str = "op",
    delete_rows: str = "open",
    tie: Sequence[str] | None = None,
    rows_per_cut: int = ROWS_PER_CUT,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """One row per version: ``sk``, attributes, ``validFrom``, ``validTo``.

    A version ends one millisecond before the next change of its key. The row
    of a delete stays ``"open"``, as the change log has no row that closes it;
    ``"closed"`` ends it at the next change too, so that versions never
    overlap, and ``"drop"`` leaves it out. ``attrs`` maps output names to columns of
    ``changes`` and should include the key. ``size_of`` may name a cheaper frame of
    about the same size.
    """
    if delete_rows not in ("open", "closed", "drop"):
        raise ValueError(f"unknown delete_rows: {delete_rows}")
    rows = latest_per_instant(changes, key, ts, tie=tie, rows_per_cut=rows_per_cut,
                              size_of=size_of)
    deleted = F.coalesce(F.col(op) == "d", F.lit(False))
    if delete_rows == "drop":
        rows = rows.where(~deleted)
    end = F.coalesce(F.col(f"next_{ts}") - 1, F.lit(END_OF_TIME))
    if delete_rows == "open":
        end = F.when(deleted, F.lit(END_OF_TIME)).otherwise(end)
    return rows.select(
        surrogate_key(entity, F.col(key), F.col(ts)).alias(sk),
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in attrs.items()],
        F.col(ts).cast("bigint").alias("validFrom"),
        end.cast("bigint").alias("validTo"),
    )


def as_changelog(versions: DataFrame) -> DataFrame:
    """Every version as opened, plus a closing row for each version that ended."""
    ends = F.when(F.col("validTo") == END_OF_TIME, F.array(F.lit(END_OF_TIME))).otherwise(
        F.array(F.lit(END_OF_TIME), F.col("validTo")))
    return versions.withColumn("validTo", F.explode(ends))


def scd2_changelog(changes: DataFrame, key: str, attrs: Mapping[str, Column | str],
                   **options) -> DataFrame:
    return as_changelog(scd2_versions(changes, key, attrs, **options))


def consolidate(changelog: DataFrame, sk: str) -> DataFrame:
    """One row per surrogate key: the closing row where there is one.

    Where rows of one key differ in other columns, those of the earliest end count, ties
    going to the smallest. Copies are combined before the shuffle, which is by the
    surrogate key alone.
    """
    rest = [c for c in changelog.columns if c not in (sk, "validTo")]
    row = F.struct("validTo", *rest)
    kept = changelog.groupBy(sk).agg(F.min(row).alias("__row"))
    return kept.select(sk, "__row.*").select(*changelog.columns)


def consolidate_in_windows(changelog: DataFrame, sk: str,
                           window_ms: int = 100_000) -> DataFrame:
    """What a consolidating stream emits for the whole log.

    A closing row is always emitted. An open row is emitted only where no
    closing row of its version came before the end of its acceptance window,
    for a watermark that keeps up with event time.
    """
    rest = [c for c in changelog.columns if c not in (sk, "validTo")]
    closing = F.when(F.col("validTo") != END_OF_TIME, F.col("validTo"))
    grouped = changelog.groupBy(sk).agg(
        F.min(F.struct("validTo", *rest)).alias("__row"),
        F.min(closing).alias("__closed"), F.max("validTo").alias("__last"))
    grouped = grouped.select(sk, *[F.col(f"__row.{c}").alias(c) for c in rest], "__closed", "__last")
    window_end = acceptance_window_end(F.col("validFrom"), window_ms)
    was_open = F.col("__last") == END_OF_TIME
    late = F.col("__closed").isNull() | (F.col("__closed") + 1 > window_end)
    ends = F.filter(
        F.array(F.when(was_open & late, F.lit(END_OF_TIME)), F.col("__closed")),
        lambda end: end.isNotNull())
    exploded = grouped.select(sk, *rest, F.explode(ends).alias("validTo"))
    return exploded.select(*changelog.columns)


def current(versions: DataFrame) -> DataFrame:
    """Open versions only, on consolidated input."""
    return versions.where(F.col("validTo") == END_OF_TIME)


def drop_unchanged(
    changes: DataFrame, key: str, tracked: Sequence[str], ts: str = "ts_ms", op: str = "op", *,
    tie: Sequence[str] | None = None, rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Leave out updates that change no tracked column of their key.

    Deletes, and the first change after a delete, always stay.
    """
    tie = tie_columns(changes) if tie is None else list(tie)
    rows = latest_per_instant(changes, key, ts, tie=tie, rows_per_cut=rows_per_cut)
    state = F.struct(*[F.col(c) for c in tracked], (F.col(op) == "d").alias("deleted"))
    rows = rows.drop(f"next_{ts}").withColumn("__state", F.md5(F.to_json(
        state, {"ignoreNullFields": "false"})))
    rows = with_neighbour(rows, [key], ts, tie=tie, carry=["__state"], previous=True,
                          prefix="__previous", rows_per_cut=rows_per_cut)
    changed = ~F.col("__state").eqNullSafe(F.col("__previous__state"))
    return rows.where(changed | (F.col(op) == "d")).select(*changes.columns)


def integrity_report(versions: DataFrame, key: str, *,
                     rows_per_cut: int = ROWS_PER_CUT) -> DataFrame:
    """Neighbouring versions of a key that overlap, leave a gap or run backwards."""
    rows = with_neighbour(
        versions.select(key, "validFrom", "validTo"), [key], "validFrom", tie=["validTo"],
        rows_per_cut=rows_per_cut)
    following, end = F.col("next_validFrom"), F.col("validTo")
    problem = (
        F.when(end < F.col("validFrom"), "inverted")
        .when(following <= end, "overlap")
        .when(following > end + 1, "gap")
    )
    return rows.withColumn("problem", problem).where("problem IS NOT NULL")
