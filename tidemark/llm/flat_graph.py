"""Near-duplicate embeddings by search in robust-pruned flat graphs of overlapping shards.

* Equal vectors form a class, which is one node of the graph.
* Medoids are fitted on a bounded sample. A node belongs to the shard of its nearest medoid and
  of every medoid nearly as near, so shards overlap. A shard of more than ``GROUP_ROWS`` nodes is
  cut into parts by a hash and each pair of parts is a group, so no task holds more.
* In each group every node is joined with near nodes, pruned robustly: of two candidates in
  about the same direction only the nearer stays. The adjacency lists that a node got in all its
  groups are united.
* Each node is then looked for in each of its groups: a greedy search over the united lists,
  from the group's medoids, and from there on every node in reach is expanded until no new
  one turns up. The search may start at the node itself only where it was not arrived at.
* What was found is verified by the cosine in double precision. A pair that lies in several
  groups counts in the first of them alone, so counts add up without any pair being
  written; for the components a group reports a spanning star, not its pairs.
* The recall is audited: sampled nodes are compared with all rows in blocks. Where it falls
  short, shards are made to overlap more and the graph is built again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed
from tidemark.llm.simhash import components

LINKED = 0.95
#: How far below a link's similarity nodes are still expanded beyond the greedy search.
REACH_BELOW = 0.03
#: Nodes of a shard on average, and at most in a group.
SHARD_ROWS, GROUP_ROWS = 1024, 4096
#: Rows the medoids are fitted on, and the most medoids there are.
SAMPLE_ROWS, MAX_MEDOIDS = 20_000, 4096
#: A node joins the shards of medoids that are less similar than its nearest by this at most,
#: to begin with, and when the audit asks for more.
MARGIN, MAX_MARGIN = 0.05, 0.45
#: Medoids that are closer than that would split near-duplicates at random.
MEDOIDS_APART = 0.85
#: Out-degree, candidates that are pruned to it, and by how much nearer a neighbour must be.
DEGREE, CANDIDATES, ALPHA = 16, 48, 1.2
#: Nodes that the greedy search keeps, and the medoids of a group it starts from.
BEAM, STARTS = 8, 4
#: Sampled nodes that the audit compares with all rows, and the recall it asks for.
AUDIT_ROWS, LEAST_RECALL = 256, 0.99
#: Cells that one numpy step works on.
CELLS = 1 << 21


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, initial=0, keepdims=True)
    return wide / np.sqrt((wide ** 2).sum(axis=1, keepdims=True))


def fit_medoids(sample: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` rows of ``sample``, of length 1, that its clusters lie around."""
    rng = np.random.default_rng(11)
    centres = sample[rng.permutation(len(sample))[:k]]
    for _ in range(3):
        near = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        size = np.sqrt((sums ** 2).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, sums / np.maximum(size, 1e-12), centres)
    medoids = sample[np.unique((centres @ sample.T).argmax(axis=1))]
    kept: list[int] = []
    alike = medoids @ medoids.T
    for k in range(len(medoids)):
        if not kept or alike[k, kept].max() < MEDOIDS_APART:
            kept.append(k)
    return medoids[kept]


def robust_prune(vectors: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Neighbours of every row, nearest first and filled up with -1.

    All rows are pruned in step: the nearest candidate left becomes a neighbour, and candidates
    that are nearer to it than to the row, by ``ALPHA``, go. Places left over are given to the
    nearest candidates that went, so copies with equal distances stay well connected.
    """
    n = len(vectors)
    alike = vectors @ vectors.T
    np.fill_diagonal(alike, -2)
    width = min(CANDIDATES, n - 1)
    if width <= 0:
        return np.full((n, degree), -1, np.int32)
    if width < n - 1:
        near = np.argpartition(-alike, width - 1, axis=1)[:, :width]
    else:
        near = np.argsort(-alike, axis=1)[:, :width]
    near = np.take_along_axis(
        near, np.argsort(-np.take_along_axis(alike, near, axis=1), axis=1, kind="stable"), axis=1)
    far = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(alike, near, axis=1)))
    left = np.ones((n, width), bool)
    chosen = np.zeros((n, width), bool)
    rows = np.arange(n)
    for _ in range(min(degree, width)):
        first = left.argmax(axis=1)
        some = left[rows, first]
        if not some.any():
            break
        chosen[rows[some], first[some]] = True
        left[rows, first] = False
        picked = near[rows, first]
        apart = np.sqrt(np.maximum(0, 2 - 2 * alike[picked[:, None], near]))
        left &= (ALPHA * apart > far) | ~some[:, None]
    # Chosen ones first, then the others, each nearest first.
    order = np.argsort(~chosen, axis=1, kind="stable")[:, :degree]
    out = np.take_along_axis(near, order, axis=1).astype(np.int32)
    if out.shape[1] < degree:
        out = np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)
    return out


def entry_medoids(vectors: np.ndarray) -> np.ndarray:
    """Rows that a search starts from: medoids of slices at growing distance from the centre."""
    inward = np.argsort(-(vectors @ vectors.mean(axis=0)), kind="stable")
    return np.unique([part[(vectors[part] @ vectors[part].mean(axis=0)).argmax()]
                      for part in np.array_split(inward, min(STARTS, len(inward)))])


def range_search(vectors: np.ndarray, lists: np.ndarray, starts: np.ndarray,
                 asked: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """``(asked place, row)`` of all rows found in ``reach`` of the asked ones.

    ``lists`` holds each row's neighbours, filled up with -1. The greedy search keeps the
    ``BEAM`` best rows of each asked one and expands the best that it has not expanded yet.
    """
    m, n = len(asked), len(vectors)
    target = vectors[asked]
    at = np.arange(m)
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True  # stands for no neighbour
    seen[:, starts] = True
    width = max(BEAM, len(starts))
    ids = np.full((m, width), n)
    alike = np.full((m, width), -2.0, vectors.dtype)
    ids[:, :len(starts)] = starts
    alike[:, :len(starts)] = target @ vectors[starts].T
    done = ids == n
    found_q, found_r = [], []

    def keep(q: np.ndarray, r: np.ndarray, s: np.ndarray) -> None:
        near = s >= reach
        found_q.append(q[near])
        found_r.append(r[near])

    keep(np.repeat(at, len(starts)), np.tile(starts, m), alike[:, :len(starts)].ravel())
    while True:
        waiting = np.where(done, -3.0, alike)
        best = waiting.argmax(axis=1)
        active = np.flatnonzero(waiting[at, best] > -3)
        if not len(active):
            break
        done[active, best[active]] = True
        fresh = lists[ids[active, best[active]]]
        fresh = np.where(fresh < 0, n, fresh)
        fresh = np.where(seen[active[:, None], fresh], n, fresh)
        seen[active[:, None], fresh] = True
        real = fresh < n
        scores = np.full(fresh.shape, -2.0, vectors.dtype)
        q, c = np.nonzero(real)
        scores[q, c] = np.einsum("ij,ij->i", target[active[q]], vectors[fresh[q, c]])
        keep(active[q], fresh[q, c], scores[q, c])
        every = np.concatenate([alike[active], scores], axis=1)
        rows = np.concatenate([ids[active], fresh], axis=1)
        old = np.concatenate([done[active], ~real], axis=1)
        best = np.argpartition(-every, width - 1, axis=1)[:, :width]
        alike[active] = np.take_along_axis(every, best, axis=1)
        ids[active] = np.take_along_axis(rows, best, axis=1)
        done[active] = np.take_along_axis(old, best, axis=1)
    # A row that was not arrived at is searched for from itself.
    missed = np.flatnonzero(~seen[at, asked])
    seen[missed, asked[missed]] = True
    q = np.concatenate([*found_q, missed])
    r = np.concatenate([*found_r, asked[missed]])
    pairs_q, pairs_r = [q], [r]
    # Everything in reach is expanded, whatever its place in the beam.
    step = max(1, CELLS // (max(1, lists.shape[1]) * max(1, vectors.shape[1])))
    while len(q):
        next_q, next_r = [], []
        for start in range(0, len(q), step):
            of = np.repeat(q[start:start + step], lists.shape[1])
            to = lists[r[start:start + step]].ravel()
            new = ~seen[of, np.where(to < 0, n, to)]
            key = np.unique(of[new].astype(np.int64) * n + to[new])
            of, to = key // n, key % n
            seen[of, to] = True
            near = np.einsum("ij,ij->i", target[of], vectors[to]) >= reach
            next_q.append(of[near])
            next_r.append(to[near])
        q, r = np.concatenate(next_q), np.concatenate(next_r)
        pairs_q.append(q)
        pairs_r.append(r)
    return np.concatenate(pairs_q), np.concatenate(pairs_r)


def _lists(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = whole.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(whole), len(flat) // max(1, len(whole)))


def _sample_medoids(classes: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Medoids for each length of vectors, from a sample drawn by a hash."""
    share = min(1.0, 1.2 * SAMPLE_ROWS / max(1, n))
    drawn = (classes.where(F.pmod(F.xxhash64("h1", F.lit(5)), F.lit(1 << 30)) < share * (1 << 30))
             .select("dims", "h1", "vector").limit(SAMPLE_ROWS).toPandas())
    medoids = {}
    for dims, rows in drawn.sort_values("h1").groupby("dims"):
        sample = unit(np.array(rows["vector"].tolist(), np.float64))
        k = max(1, min(MAX_MEDOIDS, round(n * len(rows) / len(drawn) / SHARD_ROWS)))
        medoids[int(dims)] = fit_medoids(sample.astype(np.float32), k)
    return medoids


def _placed(classes: DataFrame, medoids: dict[int, np.ndarray], margin: float) -> DataFrame:
    """``classes`` with their sorted shards, numbers that are unique among all lengths."""
    first, offset = {}, 0
    for dims in sorted(medoids):
        first[dims] = offset
        offset += len(medoids[dims])
    shipped = classes.sparkSession.sparkContext.broadcast((medoids, first, offset))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        medoids, first, other = shipped.value
        for batch in batches:
            shards: list[list[int]] = [[] for _ in range(batch.num_rows)]
            lengths = batch.column("dims").to_numpy()
            for dims in np.unique(lengths):
                rows = np.flatnonzero(lengths == dims)
                if dims not in medoids:
                    for k in rows:
                        shards[k] = [other + int(dims)]
                    continue
                x = unit(_lists(batch.column("vector").take(pa.array(rows)))).astype(np.float32)
                alike = x @ medoids[dims].T
                near = alike >= alike.max(axis=1, keepdims=True) - margin
                for k, row in zip(rows, near):
                    shards[k] = (np.flatnonzero(row) + first[dims]).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shards, pa.list_(pa.int32()))], [*batch.schema.names, "shards"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{schema}, shards array<int>")


def _groups(placed: DataFrame) -> DataFrame:
    """A row for each node in each of its groups, ``(shard, left, right)``; ``part`` is its own."""
    each = placed.withColumn("shard", F.explode("shards"))
    sizes = each.groupBy("shard").count()
    # A shard of more than one group has parts of half a group's size.
    parts = sizes.select("shard", F.when(F.col("count") <= GROUP_ROWS, 1).otherwise(
        F.ceil(F.col("count") * 2.2 / GROUP_ROWS)).cast("int").alias("parts"))
    # At most MAX_MEDOIDS shards for each length of vectors.
    dealt = each.join(F.broadcast(parts), "shard").withColumn(
        "part", F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: p != F.col("part"))
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(others)
    spread = dealt.withColumn("other", F.explode(others))
    return spread.select(
        "shard", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"),
        "node", "part", "parts", "weight", "shards", "vector")


_GROUP = ("shard", "left", "right")


def _built(groups: DataFrame) -> DataFrame:
    """``node, near``: the united adjacency lists of all groups."""

    def build(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_numpy()
        order = np.argsort(nodes)
        x = unit(_lists(group.column("vector"))[order]).astype(np.float32)
        nodes = nodes[order]
        near = robust_prune(x)
        rows, places = np.nonzero(near >= 0)
        to = near[rows, places]
        # Links lead back as well, so that no row is without a way in.
        return pa.table({"node": np.concatenate([nodes[rows], nodes[to]]),
                         "near": np.concatenate([nodes[to], nodes[rows]])})

    links = groups.select(*_GROUP, "node", "vector").groupBy(*_GROUP).applyInArrow(
        build, "node long, near long")
    return links.groupBy("node").agg(F.collect_set("near").alias("near"))


def _searched(groups: DataFrame, adjacency: DataFrame, linked: float) -> DataFrame:
    """``node, links, root_a, root_b``: links counted for a node, or a step of a spanning star."""

    def search(group: pa.Table) -> pa.Table:
        shard, left, right = (group.column(c)[0].as_py() for c in _GROUP)
        nodes = group.column("node").to_numpy()
        order = np.argsort(nodes)
        nodes = nodes[order]
        wide = unit(_lists(group.column("vector"))[order])
        x = wide.astype(np.float32)
        weight = group.column("weight").to_numpy()[order]
        part = group.column("part").to_numpy()[order]
        parts = group.column("parts")[0].as_py()
        n = len(nodes)
        near = group.column("near").combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(near), 0).to_numpy()
        every = near.flatten().to_numpy()
        to = np.minimum(np.searchsorted(nodes, every), n - 1)
        to = np.where(nodes[to] == every, to, -1)
        of = np.repeat(np.argsort(order), sizes)
        of, to = of[to >= 0], to[to >= 0]
        by_row = np.argsort(of, kind="stable")
        of, to = of[by_row], to[by_row]
        starts_at = np.searchsorted(of, np.arange(n))
        width = int(np.bincount(of, minlength=n).max(initial=1))
        lists = np.full((n, width), -1, np.int32)
        lists[of, np.arange(len(of)) - starts_at[of]] = to

        starts = entry_medoids(x)
        # A pair is counted in the first shard that both are in.
        column = group.column("shards").combine_chunks()
        lengths = pc.list_value_length(column).to_numpy()
        flat = column.flatten().to_numpy()
        member = np.repeat(np.argsort(order), lengths)
        earlier = flat < shard
        names, flat = np.unique(flat[earlier], return_inverse=True)
        in_shard = np.zeros((n, len(names)), np.float32)
        in_shard[member[earlier], flat] = 1

        hit = np.zeros((n, n), bool)
        block = max(1, min(n, 1 << 10))
        for start in range(0, n, block):
            asked = np.arange(start, min(n, start + block))
            q, r = range_search(x, lists, starts, asked, linked - REACH_BELOW)
            hit[asked[q], r] = True
        hit |= hit.T
        links = np.zeros(n, np.int64)
        parent = np.arange(n)
        step = max(1, CELLS // max(1, x.shape[1]))
        rows = max(1, (1 << 24) // max(1, n))
        for start in range(0, n, rows):
            a, b = np.nonzero(hit[start:start + rows])
            a += start
            a, b = a[a < b], b[a < b]
            for s in range(0, len(a), step):
                i, j = a[s:s + step], b[s:s + step]
                good = np.einsum("ij,ij->i", wide[i], wide[j]) >= linked
                i, j = i[good], j[good]
                _join(parent, i, j)
                ours = (in_shard[i] * in_shard[j]).sum(axis=1) == 0 if len(names) else np.ones(len(i), bool)
                if parts > 1:
                    # Pairs within one part count in its group with the part after it.
                    same = part[i] == part[j]
                    after = (part[i] + 1) % parts
                    here = (np.minimum(part[i], after) == left) & (np.maximum(part[i], after) == right)
                    ours &= ~same | here
                np.add.at(links, i[ours], weight[j[ours]])
                np.add.at(links, j[ours], weight[i[ours]])
        counted = np.flatnonzero(links)
        moved = np.flatnonzero(parent != np.arange(n))
        empty = np.zeros(len(moved), np.int64)
        return pa.table({
            "node": np.concatenate([nodes[counted], nodes[moved]]),
            "links": np.concatenate([links[counted], empty]),
            "root": pa.array(np.concatenate([nodes[counted], nodes[parent[moved]]]))})

    rows = groups.join(adjacency, "node", "left")
    return rows.groupBy(*_GROUP).applyInArrow(search, "node long, links long, root long")


def _join(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Unite the components of linked rows; ``parent`` names each one's smallest row."""
    while len(left):
        a, b = parent[left], parent[right]
        apart = a != b
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        if not len(left):
            return
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(above := parent[parent], parent):
            parent[:] = above


def audited_recall(classes: DataFrame, counts: DataFrame, linked: float = LINKED,
                   rows: int = AUDIT_ROWS) -> float:
    """Links found of those that sampled nodes have among all rows, compared in blocks.

    Nodes with links are sampled like the others, by a hash, so the sample is as large on
    any table; without a link in the sample the recall is 1.
    """
    n = classes.count()
    share = min(1.0, 2.0 * rows / max(1, n))
    sample = (classes.where(F.pmod(F.xxhash64("h2", F.lit(9)), F.lit(1 << 30)) < share * (1 << 30))
              .select("node", "dims", "vector").limit(rows).toPandas())
    if not len(sample):
        return 1.0
    asked = {int(d): (g["node"].to_numpy(), unit(np.array(g["vector"].tolist(), np.float64)))
             for d, g in sample.groupby("dims")}
    shipped = classes.sparkSession.sparkContext.broadcast(asked)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, int] = {}
        for batch in batches:
            lengths = batch.column("dims").to_numpy()
            for dims, (nodes, x) in shipped.value.items():
                at = np.flatnonzero(lengths == dims)
                for start in range(0, len(at), 4096):
                    rows = pa.array(at[start:start + 4096])
                    y = unit(_lists(batch.column("vector").take(rows)))
                    near = x @ y.T >= linked
                    near &= nodes[:, None] != batch.column("node").take(rows).to_numpy()[None, :]
                    sums = near @ batch.column("weight").take(rows).to_numpy()
                    for node, links in zip(nodes, sums):
                        totals[node] = totals.get(node, 0) + int(links)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())],
            ["node", "exact"])

    exact = classes.select("node", "dims", "weight", "vector").mapInArrow(
        count, "node long, exact long").groupBy("node").agg(F.sum("exact").alias("exact"))
    found = exact.join(counts, "node", "left").agg(
        F.sum("exact").alias("exact"), F.sum(F.least("exact", "links")).alias("found")).first()
    return 1.0 if not found.exact else (found.found or 0) / found.exact


def near_duplicates(embeddings: DataFrame, *, linked: float = LINKED, id_col: str = "vec_id",
                    vector_col: str = "embedding", margin: float = MARGIN,
                    least_recall: float = LEAST_RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings``.

    ``n_links`` counts the other rows with a cosine of at least ``linked``, ``component_id`` is
    the smallest id that links lead to, ``kept`` holds where that is the row's own. Vectors that
    are NULL, of no length, zero, or hold a NULL, NaN or infinite component link with
    nothing, and vectors of different lengths not with each other. Rows with equal vectors are
    linked, repeated rows too. A row with a NULL id counts as a link, gives its component
    no id and is not kept. An empty table gives an empty one. Other columns are not read.
    """
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))
    named = embeddings.select(F.col(id_col).cast("long").alias("vec_id"),
                              F.when(usable, F.col(vector_col)).alias("vector"))
    rows = named.select("vec_id", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")).alias("h1"),
                        F.xxhash64("vector", F.lit(1)).alias("h2"), "vector")
    classes = rows.where("vector IS NOT NULL").groupBy("h1", "h2").agg(
        F.first("vector").alias("vector"), F.count(F.lit(1)).alias("weight"),
        F.min("vec_id").alias("first_id"))
    classes = checkpointed(classes.select(
        F.monotonically_increasing_id().alias("node"), "h1", "h2", "weight", "first_id",
        F.size("vector").alias("dims"), "vector"))
    n = classes.count()
    medoids = _sample_medoids(classes, n)
    while True:
        placed = checkpointed(_placed(classes.select("node", "weight", "dims", "vector"), medoids, margin))
        groups = _groups(placed)
        found = checkpointed(_searched(groups, _built(groups), linked))
        counts = found.groupBy("node").agg(F.sum("links").alias("links"))
        if margin >= MAX_MARGIN or audited_recall(classes, counts, linked) >= least_recall:
            break
        margin = min(MAX_MARGIN, 1.6 * margin + 0.02)
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    of_class = (classes.select("node", "h1", "h2", "weight", "first_id")
                .join(counts, "node", "left").join(roots, "node", "left")
                .withColumn("root", F.coalesce("root", "node")))
    smallest = of_class.groupBy("root").agg(F.min("first_id").alias("component_id"))
    result = of_class.join(smallest, "root").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    joined = rows.drop("vector").join(result, ["h1", "h2"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("vec_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
