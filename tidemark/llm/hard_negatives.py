"""Hard negatives by Fagin's threshold algorithm over per-dimension sorted lists.

Anchors meet all rows in blocks: rows are dealt into blocks by a hash, anchors into blocks of
their own, and each pair of blocks is one task's work, of bounded size. A task sorts its rows
once for each dimension. For an anchor it walks all lists at once, from the largest component
down where the anchor's own is positive and from the smallest up where it is negative, scores
every row it meets by its whole integer inner product (random access), and stops once no row
that it has not met can enter: the sum of the components at the lists' places times the
anchor's, the threshold, lies strictly below the ``k``-th score of every window of interest.
What the blocks found is merged by ranks over a few rows for each anchor.

A first round finds each anchor's positives, a second the negatives within the window of scores
that each positive opens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed

POSITIVES = NEGATIVES = 5
#: Parts of a component's unit, and the share of a positive's score that a negative must reach.
SCALE, LEAST_PERCENT = 256, 80
#: Components of rows and of anchors in a block.
BLOCK_CELLS, ANCHOR_CELLS = 1 << 22, 1 << 20
#: Rows of a block below which no block is made smaller for the sake of more tasks.
SMALL_BLOCK = 4096
#: Places of each list that are read first; every further reading doubles what was read.
FIRST_DEPTH = 64
#: Larger components have no place in the sums.
LARGEST = 1 << 27


def quantised(embedding: Column) -> Column:
    """``floor(256 * x)`` of every component; NULL for vectors that take no part."""
    parts = F.transform(embedding, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x)
                     & (F.abs(x.cast("double")) <= float(LARGEST // SCALE)))
    return F.when(sound, parts.cast("array<int>"))


class SortedLists:
    """Rows of a block with one sorted list for each dimension."""

    def __init__(self, vectors: np.ndarray):
        # Sums are exact in the narrowest type that is sure to hold them.
        self.top = int(np.abs(vectors).max(initial=0))
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)
        self.exact: dict[str, np.ndarray] = {}

    def _typed(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        most = self.top * int(np.abs(anchor).max(initial=0)) * max(1, len(anchor))
        kind = "f4" if most < 1 << 24 else "f8" if most < 1 << 53 else "i8"
        if kind not in self.exact:
            self.exact[kind] = self.vectors.astype(kind)
        return self.exact[kind], anchor.astype(kind)

    def met(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """Rows newly met with their scores, and the threshold; ``None`` when all were met."""
        n = len(self.vectors)
        wide = anchor.astype(np.int64)
        used = np.flatnonzero(wide)
        if not len(used):
            yield np.arange(n), np.zeros(n, np.int64), None
            return
        vectors, typed = self._typed(anchor)
        rising = wide[used] < 0
        low, high = used[rising], used[~rising]
        seen = np.zeros(n, bool)
        done, depth = 0, FIRST_DEPTH
        while done < n:
            end = min(n, depth)
            fresh = np.zeros(n, bool)
            fresh[self.order[done:end, low]] = True
            fresh[self.order[n - end:n - done, high]] = True
            fresh &= ~seen
            seen |= fresh
            rows = np.flatnonzero(fresh)
            scores = (vectors[rows] @ typed).astype(np.int64)
            threshold = int(self.sorted[end - 1, low].astype(np.int64) @ wide[low]
                            + self.sorted[n - end, high].astype(np.int64) @ wide[high])
            yield rows, scores, threshold if end < n and not seen.all() else None
            done, depth = end, depth * 2


class _Window:
    """The ``k`` best rows, by score and then id, of scores from ``low`` to ``high``."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        within = np.ones(len(scores), bool)
        if self.low is not None:
            within &= (scores >= self.low) & (scores <= self.high)
        if len(self.scores) == self.k:
            within &= scores >= self.scores[-1]
        scores, ids = scores[within], ids[within]
        if len(scores) > 4 * self.k:
            edge = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[scores >= edge], ids[scores >= edge]
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, ids])
        best = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[best], ids[best]

    def settled(self, threshold: int) -> bool:
        """Whether no row with at most this score can still enter."""
        if self.low is not None and threshold < self.low:
            return True
        return len(self.scores) == self.k and threshold < self.scores[-1]


def _search(lists: SortedLists, ids: np.ndarray, labels: np.ndarray, anchor: np.ndarray,
            anchor_id: int, label: int, windows: list[_Window], same: bool) -> None:
    """Fill the windows with the anchor's best rows of the same, or of other labels."""
    for rows, scores, threshold in lists.met(anchor):
        wanted = (labels[rows] == label) == same
        wanted &= ids[rows] != anchor_id
        for window in windows:
            window.add(scores[wanted], ids[rows][wanted])
        if threshold is not None and all(w.settled(threshold) for w in windows):
            return


def _blocks(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """Rows and queries dealt into pairs of blocks, ``(dims, row_block, query_block)``."""
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.max("dims").alias("dims")).first()
    asked = queries.count()
    dims = max(1, found.dims or 1)
    spark = rows.sparkSession
    largest = max(1, BLOCK_CELLS // dims)
    # More and smaller blocks where there would be fewer than the tasks that run at once.
    row_blocks = max(-(-found.n // largest),
                     min(-(-found.n // SMALL_BLOCK), 2 * spark.sparkContext.defaultParallelism), 1)
    query_blocks = max(1, -(-asked // max(1, ANCHOR_CELLS // dims)))
    place = F.xxhash64("vec_id", F.lit(13))

    def all_of(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    nothing = F.lit(None).cast(queries.schema["positives"].dataType).alias("positives")
    ours = rows.select("vec_id", "label", "dims", "vector", F.lit(False).alias("asks"), nothing,
                       F.pmod(place, F.lit(row_blocks)).cast("int").alias("row_block"),
                       all_of(query_blocks, "query_block"))
    theirs = queries.select("vec_id", "label", "dims", "vector", F.lit(True).alias("asks"), "positives",
                            all_of(row_blocks, "row_block"),
                            F.pmod(place, F.lit(query_blocks)).cast("int").alias("query_block"))
    return ours.unionByName(theirs)


def _vectors(column: pa.ChunkedArray, rows: np.ndarray) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(lists)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, len(flat) // n if n else 0)[rows]


def _numbers(group: pa.Table, name: str) -> np.ndarray:
    return group.column(name).to_numpy()


def _best(found: DataFrame, by: list[str], k: int, score: str, id_col: str) -> DataFrame:
    """The ``k`` best of the few rows that the blocks report for each group, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), id_col)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives_of(rows: DataFrame, anchors: DataFrame, k: int = POSITIVES) -> DataFrame:
    """``vec_id, positives``: each anchor's first ``k`` other rows of its label."""
    queries = anchors.withColumn("positives", F.lit(None).cast("array<struct<id:bigint,score:bigint>>"))

    def search(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        at, every = np.flatnonzero(asks), np.flatnonzero(~asks)
        vectors = group.column("vector")
        ids, labels = _numbers(group, "vec_id"), _numbers(group, "label")
        out: list[tuple] = []
        if len(at) and len(every):
            lists = SortedLists(_vectors(vectors, every))
            for k_at, anchor in zip(at, _vectors(vectors, at)):
                window = _Window(k)
                _search(lists, ids[every], labels[every], anchor, ids[k_at], labels[k_at],
                        [window], True)
                out += [(ids[k_at], i, s) for i, s in zip(window.ids, window.scores)]
        return pa.table([pa.array([int(r[c]) for r in out], pa.int64()) for c in range(3)],
                        ["vec_id", "id", "score"])

    found = _blocks(rows, queries).groupBy("dims", "row_block", "query_block").applyInArrow(
        search, "vec_id long, id long, score long")
    return _best(found, ["vec_id"], k, "score", "id").groupBy("vec_id").agg(
        F.sort_array(F.collect_list(F.struct("id", "score"))).alias("positives"))


def negatives_of(rows: DataFrame, anchors: DataFrame, k: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, positive_score, negative_id, negative_score, rank`` for anchors
    with their ``positives``."""

    def search(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        at, every = np.flatnonzero(asks), np.flatnonzero(~asks)
        vectors = group.column("vector")
        ids, labels = _numbers(group, "vec_id"), _numbers(group, "label")
        out: list[tuple] = []
        if len(at) and len(every):
            lists = SortedLists(_vectors(vectors, every))
            positives = group.column("positives").take(pa.array(at)).to_pylist()
            for k_at, anchor, wanted in zip(at, _vectors(vectors, at), positives):
                # The lowest score is the least integer with 80 p <= 100 s.
                windows = {p: _Window(k, -(-LEAST_PERCENT * p // 100), p)
                           for p in {w["score"] for w in wanted}}
                _search(lists, ids[every], labels[every], anchor, ids[k_at], labels[k_at],
                        list(windows.values()), False)
                for w in wanted:
                    window = windows[w["score"]]
                    out += [(ids[k_at], w["id"], w["score"], i, s)
                            for i, s in zip(window.ids, window.scores)]
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        return pa.table([pa.array([int(r[c]) for r in out], pa.int64()) for c in range(5)], names)

    found = _blocks(rows, anchors).groupBy("dims", "row_block", "query_block").applyInArrow(
        search, "anchor_id long, positive_id long, positive_score long, negative_id long, "
                "negative_score long")
    return _best(found, ["anchor_id", "positive_id"], k, "negative_score", "negative_id")


def mine(embeddings: DataFrame, is_anchor: Column, *, label: Column | None = None,
         id_col: str = "vec_id", vector_col: str = "embedding", positives: int = POSITIVES,
         negatives: int = NEGATIVES) -> DataFrame:
    """Hard negatives of all anchors: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``.

    ``is_anchor`` and ``label`` are expressions over the columns of ``embeddings`` (``label``
    defaults to the column). Rows with a NULL id, label or vector, with a component that is
    NULL, not finite or beyond ``LARGEST`` once scaled take no part. Rows that share an id count
    as one, the smallest in label and vector. Vectors of other lengths than the anchor's are
    no candidates; vectors of length 0 score 0. Anchors without a positive, and positives
    without a negative in their window, give no row; an empty table gives none. Columns
    other than those named are not read.
    """
    label = F.col("label") if label is None else label
    named = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
        quantised(F.col(vector_col)).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    # Repeated rows are combined in the map tasks, so an id with very many is one row a task.
    once = named.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").groupBy(
        "vec_id").agg(F.min(F.struct("label", "vector", "anchor")).alias("r"))
    rows = checkpointed(once.select("vec_id", "r.*", F.size("r.vector").alias("dims")))
    anchors = rows.where("anchor").drop("anchor")
    rows = rows.drop("anchor")
    found = checkpointed(positives_of(rows, anchors, positives))
    asked = anchors.join(found, "vec_id")
    return negatives_of(rows, asked, negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score")
