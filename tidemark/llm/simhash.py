"""Near-duplicates by SimHash, found by exact comparison of tiles.

Every text gets a 64-bit fingerprint of its word shingles. Equal fingerprints form a
class; classes whose fingerprints differ in at most ``radius`` bits are linked, and
linked classes form a component.

Fingerprints are laid out in tiles by the population counts of their four 16-bit
words. One differing bit changes one count by one, so two fingerprints within the
radius lie in tiles whose four counts differ by the radius at most in sum, and all
other pairs of tiles are skipped unseen. What is left is compared in full, by
exclusive-or and bit counts on numpy blocks. Tiles beyond a fixed size are cut into
chunks by a hash, and each pair of chunks is a group of its own, so no task ever
holds more than ``HOME_ROWS + GUEST_ROWS`` fingerprints, whatever a tile's share is.

A group reports the links it saw as a spanning star for each of its components, never
as pairs: a thousand near copies give a thousand rows.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed

SEED = 42
RADIUS = 3
SHINGLE_WORDS = 3
#: About so many fingerprints of one tile, and of those it is compared with, in a group.
HOME_ROWS, GUEST_ROWS = 4096, 65536
#: Rows of the home side that meet all guests in one numpy operation.
BLOCK_CELLS = 1 << 20
#: Shingles whose bits are counted at once.
COUNTED = 1 << 15


def fingerprint(text: str | None) -> int:
    """SimHash of the lower-cased word shingles, as a signed 64-bit number.

    Words are what white space (tab to carriage return, and space) separates; only A-Z
    change case. A text with fewer words than a shingle is one shingle, one without
    words has fingerprint zero. A bit is set if over half the hashes have it, repeated
    shingles counted each time.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    runs = zip(*(words[k:] for k in range(SHINGLE_WORDS))) if len(words) >= SHINGLE_WORDS \
        else iter([words])
    digest, set_bits, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    while chunk := [digest(s, SEED) for s in map(b" ".join, itertools.islice(runs, COUNTED))]:
        bits = np.unpackbits(np.array(chunk, ">u8").view(np.uint8)).reshape(-1, 64)
        set_bits += bits.sum(axis=0, dtype=np.int64)
        total += len(chunk)
    return int(np.packbits(2 * set_bits > total).view(">i8")[0])


def fingerprint_column(text: Column) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return of(text)


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _counts(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long")))
            for i in range(4)]


def _tile(counts: list[Column]) -> Column:
    """One number for four counts; room for the steps beyond 0 and 16 is left on both sides."""
    return sum((c + RADIUS) * 32 ** i for i, c in enumerate(counts)).cast("int")


def _steps(radius: int) -> list[int]:
    """Differences of tile numbers from a tile to itself and to half of the tiles near it.

    A step and its opposite stand for the same pair of tiles, so one of them is enough.
    """
    near = (s for s in itertools.product(range(-radius, radius + 1), repeat=4)
            if sum(map(abs, s)) <= radius)
    return sorted({sum(d * 32 ** i for i, d in enumerate(s)) for s in near if s >= (0, 0, 0, 0)})


def _merge(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the components of linked numbers; ``parent`` points at the smallest member."""
    while True:
        a, b = parent[left], parent[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (above := parent[parent]).tobytes() != parent.tobytes():
            parent[:] = above


def _linked(home: np.ndarray, guests: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a group, each with the smallest of its component if that is another."""
    every = np.unique(np.concatenate([home, guests]))
    at_home, at_guests = np.searchsorted(every, home), np.searchsorted(every, guests)
    parent = np.arange(len(every))
    rows = max(1, BLOCK_CELLS // max(1, len(guests)))
    for start in range(0, len(home), rows):
        apart = np.bitwise_count(home[start:start + rows, None] ^ guests[None, :])
        i, j = np.nonzero(apart <= radius)
        _merge(parent, at_home[start + i], at_guests[j])
    moved = np.flatnonzero(parent != np.arange(len(every)))
    return every[moved], every[parent[moved]]


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Spanning links ``(a, b)`` between the distinct fingerprints ``fp`` of ``classes``.

    Two fingerprints are connected by these links exactly if a chain of steps of at most
    ``radius`` bits leads from one to the other.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"radius must be 0 to {RADIUS}")
    steps = F.array(*[F.lit(s) for s in _steps(radius)])
    # At most 17**4 tiles exist, however many documents there are: a bound for broadcasts.
    sizes = classes.groupBy(_tile(_counts(F.col("fp"))).alias("tile")).agg(
        F.count(F.lit(1)).alias("n"))
    guests = (sizes.select(F.explode(F.transform(steps, lambda s: F.col("tile") - s)).alias("tile"),
                           F.col("n").alias("guest_n"))
              .groupBy("tile").agg(F.sum("guest_n").alias("guest_n")))
    plan = checkpointed(
        sizes.join(guests, "tile").select(
            "tile",
            F.ceil(F.col("n") / HOME_ROWS).cast("int").alias("homes"),
            F.ceil(F.col("guest_n") / GUEST_ROWS).cast("int").alias("rounds")))
    of_tile = classes.select("fp", _tile(_counts(F.col("fp"))).alias("own"))
    chunk = F.xxhash64("fp")
    home = (of_tile.withColumnRenamed("own", "tile").join(F.broadcast(plan), "tile")
            .select("fp", "tile", F.pmod(chunk, F.col("homes")).cast("int").alias("home"),
                    F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)).alias("round"),
                    F.lit(True).alias("at_home")))
    guest = (of_tile.select("fp", F.explode(F.transform(steps, lambda s: F.col("own") - s))
                            .alias("tile"))
             .join(F.broadcast(plan), "tile")
             .select("fp", "tile",
                     F.explode(F.sequence(F.lit(0), F.col("homes") - 1)).alias("home"),
                     F.pmod(chunk, F.col("rounds")).cast("int").alias("round"),
                     F.lit(False).alias("at_home")))

    def compare(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().view(np.uint64)
        at_home = group.column("at_home").to_numpy(zero_copy_only=False)
        a, b = _linked(fp[at_home], fp[~at_home], radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (home.unionByName(guest).groupBy("tile", "home", "round")
            .applyInArrow(compare, "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every number that occurs in the links ``(a, b)``.

    Each round hooks every root to its smallest neighbour, shortens the chains of hooks
    by doubling, and draws the links anew between the roots that are left. All steps are
    joins on unique keys or sums combined in the map tasks; nothing is gathered.
    """
    edges = checkpointed(edges.where("a != b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    nodes = edges.select(F.explode(F.array("hi", "lo")).alias("node")).distinct()
    label = checkpointed(nodes.withColumn("root", F.col("node")))
    while not edges.isEmpty():
        hooks = checkpointed(edges.groupBy("hi").agg(F.min("lo").alias("up"))
                             .withColumnRenamed("hi", "node"))
        while True:
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = checkpointed(hooks.join(above, "up", "left").select(
                "node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")))
            hooks = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        label = checkpointed(label.join(
            hooks.withColumnRenamed("node", "root"), "root", "left").select(
            "node", F.coalesce("up", "root").alias("root")))
        for end in ("hi", "lo"):
            edges = edges.join(hooks.withColumnRenamed("node", end), end, "left").withColumn(
                end, F.coalesce("up", end)).drop("up")
        edges = checkpointed(edges.where("hi != lo").select(
            F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).distinct())
    return label


def near_duplicates(docs: DataFrame, radius: int = RADIUS, *, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Component of every document: ``id_col, fp, root, component_id``.

    One row for each row of ``docs``. ``component_id`` is the smallest id of all documents
    reachable over links, ``root`` a fingerprint that names the component. Texts that are
    NULL, empty or blank have fingerprint zero and are linked like any other. Rows with
    NULL ids take part and get the smallest non-NULL id of their component, NULL if it has
    none; repeated rows stay repeated. An empty table gives an empty one. Only the two
    columns named are read, so further columns of any name do no harm.
    """
    rows = checkpointed(docs.select(F.col(id_col).alias("doc_id"),
                                    fingerprint_column(F.col(text_col)).alias("fp")))
    return _components(rows, radius).withColumnRenamed("doc_id", id_col)


def _components(rows: DataFrame, radius: int) -> DataFrame:
    """``rows`` of ``doc_id, fp``, and more, with ``root`` and ``component_id``."""
    classes = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(classes, radius))
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = placed.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(of_class, "fp").select(*rows.columns, "root", "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, *, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id, with its columns.

    Of repeated rows with that id one stays; a component whose ids are all NULL keeps one
    row. Columns that clash with names used inside come back unchanged.
    """
    doc, text = F.col(id_col), F.col(text_col)
    # A row is known by hashes of its id and its text, so texts are read for their fingerprints once.
    keys = (F.xxhash64(doc, doc.isNull()), F.xxhash64(text, text.isNull()))
    rows = checkpointed(docs.select(
        doc.alias("doc_id"), keys[0].alias("k1"), keys[1].alias("k2"), fingerprint_column(text).alias("fp")))
    found = _components(rows, radius).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "k1", "k2")).alias("first"))
    kept = found.select(F.col("first.k1").alias("_k1"), F.col("first.k2").alias("_k2"))
    inner = docs.select(keys[0].alias("_k1"), keys[1].alias("_k2"),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    one = inner.join(kept, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"])
    return one.select("_row.*")
