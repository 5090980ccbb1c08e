"""Embedding near-duplicates, conversation repair and hard negatives against brute force."""

import functools
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_repair, flat_graph, hard_negatives

VECTORS = "vec_id long, embedding array<float>, label int, node string, shard int"
TURNS = "conv_id long, turn long, role string, text string, code string, audit string"


# Conversations


def walked(codes):
    """Cost and audit by trying every edit at every state of the grammar."""

    @functools.lru_cache(None)
    def best(i, state, put):
        out = [(0, "")] if i == len(codes) and state in (0, 3) else []

        def add(price, letter, rest):
            if rest is not None:
                out.append((price + rest[0], letter + rest[1]))

        nexts = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}[state]
        if i < len(codes):
            initial, fault = codes[i] // 4, codes[i] % 4
            add(4, "D", best(i + 1, state, 0))
            for to in nexts if fault not in (1, 2) else ():
                fee = 3 if fault == 3 else 0
                if initial == to:
                    add(fee, "K", best(i + 1, to, 0))
                elif to != 1:
                    add(fee + 3, "R", best(i + 1, to, 0))
        for to in nexts if put < 3 else ():
            if to != 1:
                add(3, "I", best(i, to, put + 1))
        return min(out) if out else None

    return best(0, 0, 0)


def some_codes(rng, n):
    return bytes(rng.choice([0, 1, 2, 2, 3, 3]) * 4 + rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))


@pytest.mark.parametrize("segment", [1, 2, 5, 16])
def test_alignment_equals_all_edits_tried(monkeypatch, segment):
    monkeypatch.setattr(conversation_repair, "SEGMENT", segment)
    rng = random.Random(segment)
    for _ in range(300):
        codes = some_codes(rng, rng.randrange(0, 11))
        assert conversation_repair.repair(codes) == walked(tuple(codes))


def test_a_long_conversation_is_the_same_in_pieces(monkeypatch):
    codes = bytes([2 * 4, 3 * 4 + 3, 2 * 4, 2 * 4 + 1, 3 * 4] * 24)
    whole = conversation_repair.repair(codes)
    monkeypatch.setattr(conversation_repair, "SEGMENT", len(codes))
    assert conversation_repair.repair(codes) == whole


def repaired(spark, rows, plain=False):
    df = spark.createDataFrame(rows, TURNS)
    run = conversation_repair.repair_conversations if plain else conversation_repair.repair_damaged
    return {r.conv_id: r for r in run(df).collect()}


def turn(conv, n, role, text):
    return conv, n, role, text, "x", "y"


def digest(*turns):
    return hashlib.sha256("\n".join(turns).encode()).hexdigest()


def test_repair_of_known_conversations(spark):
    long = "word " * 200_000 + "end."
    got = repaired(spark, [
        turn(1, 0, "user", "Hi."), turn(1, 1, "assistant", "Yes."),
        turn(2, 0, "system", "S."), turn(2, 5, "user", "A?"), turn(2, 6, "user", "B?"),
        turn(3, 0, "user", " \t\n"), turn(3, 1, "user", "Cut"), turn(3, 2, "assistant", "Ok.\n"),
        turn(4, 0, "user", "Twice."), turn(4, 0, "user", "Twice."), turn(4, 1, "assistant", long),
        turn(5, None, "user", "First."), turn(5, 3, "assistant", "Last."),
        turn(6, 0, "", "No role."), turn(7, None, "user", "A."), turn(None, 0, "user", "A."),
        turn(None, 1, "assistant", "B.")], plain=True)
    assert (got[1].cost, got[1].audit, got[1].repaired_sha256) == (
        0, "KK", digest("user:Hi.", "assistant:Yes."))
    assert (got[2].gaps, got[2].illegal, got[2].cost, got[2].audit) == (4, 1, 3, "KKR")
    assert got[2].repaired_sha256 == digest("system:S.", "user:A?", "assistant:B?")
    assert (got[3].blank, got[3].truncated, got[3].cost, got[3].audit) == (1, 1, 7, "DKK")
    assert (got[4].duplicate, got[4].audit) == (1, "KDK")
    assert got[4].repaired_sha256 == digest("user:Twice.", "assistant:" + long)
    assert (got[5].gaps, got[5].audit) == (0, "KK")
    assert (got[6].cost, got[6].audit, got[6].repaired_sha256) == (4, "D", digest())
    assert got[7].gaps == 0 and got[None].audit == "KK"


def test_damage_follows_its_hash(spark):
    rows = [turn(c, t, "assistant" if t % 2 else "user", f"Text {c} {t}. Really?")
            for c in range(40) for t in range(6)]
    kinds = {(c, t): zlib.crc32(f"{c}:{t}".encode()) % 20 for c in range(40) for t in range(6)}
    got = {}
    for r in conversation_repair.damage(spark.createDataFrame(rows, TURNS)).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    assert set(kinds.values()) >= {0, 1, 2, 3, 4}
    for c, t, role, text, *_ in rows:
        want = {0: None, 1: [(role, "")], 2: [(role, text.replace(".", "").replace("?", ""))],
                3: [(role, text)] * 2, 4: [("user", text)]}.get(kinds[c, t], [(role, text)])
        assert got.get((c, t)) == want


def test_lost_conversations_and_nulls(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    kept = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 > 4)
    got = repaired(spark, [turn(gone, 0, "user", "Hi."), turn(kept, 0, None, None),
                           turn(None, None, None, None)])
    assert (got[gone].cost, got[gone].audit, got[gone].repaired_sha256) == (0, "", digest())
    # A NULL text is one space, so blank.
    assert (got[kept].blank, got[kept].audit, got[kept].illegal) == (1, "D", 0)
    assert set(got) == {gone, kept, None}
    assert repaired(spark, []) == {}


# Embeddings


def all_pairs(ids, vectors, linked=flat_graph.LINKED):
    x = flat_graph.unit(np.array(vectors, np.float64))
    near = x @ x.T >= linked
    np.fill_diagonal(near, False)
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in zip(*np.nonzero(near)):
        a, b = sorted((top(ids[a]), top(ids[b])))
        root[b] = a
    return {i: (int(n), top(i)) for i, n in zip(ids, near.sum(axis=1))}


def planted(rng, n, dims, groups):
    """Random vectors, with groups of near copies at the edge of being linked, and exact copies."""
    x = rng.standard_normal((n, dims))
    at = 0
    for size, noise in groups:
        x[at:at + size] = x[at] + noise * rng.standard_normal((size, dims))
        at += size
    x[at:at + 5] = x[at]
    return x.astype(np.float32)


@pytest.mark.parametrize("group_rows", [4096, 128])
def test_links_and_components_equal_all_pairs(spark, monkeypatch, group_rows):
    monkeypatch.setattr(flat_graph, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(flat_graph, "SHARD_ROWS", 200)
    x = planted(np.random.default_rng(3), 1500, 24, [(400, 0.1), (60, 0.2), (40, 0.23), (2, 0.1)])
    ids = list(np.random.default_rng(4).permutation(1500) * 3)
    df = spark.createDataFrame([(int(i), v.tolist(), 0, "x", 1) for i, v in zip(ids, x)], VECTORS)
    got = {r.vec_id: r for r in flat_graph.near_duplicates(df).collect()}
    want = all_pairs([int(i) for i in ids], x)
    assert len(got) == 1500
    found = sum(r.n_links for r in got.values()) / sum(n for n, _ in want.values())
    assert 0.99 <= found <= 1
    assert all(r.n_links <= want[i][0] for i, r in got.items())
    assert np.mean([got[i].component_id == c for i, (_, c) in want.items()]) > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_pruning_keeps_the_nearest_and_drops_its_shadow():
    angles = np.array([0, 0.1, 0.11, -0.3])
    x = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    near = flat_graph.robust_prune(x, degree=2)
    assert near[0].tolist() == [1, 3]


def test_audit_sees_what_is_missing(spark):
    x = planted(np.random.default_rng(5), 300, 16, [(50, 0.05)])
    rows = [(i, i, i, 1, 16, v.tolist()) for i, v in enumerate(x)]
    classes = spark.createDataFrame(rows, "node long, h1 long, h2 long, weight long, dims int, vector array<float>")
    links = all_pairs(list(range(300)), x)
    full = spark.createDataFrame([(i, n) for i, (n, _) in links.items()], "node long, links long")
    assert flat_graph.audited_recall(classes, full, rows=1000) == 1
    half = full.withColumn("links", (F.col("links") / 2).cast("long"))
    assert 0.4 < flat_graph.audited_recall(classes, half, rows=1000) < 0.6


ODD = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], None), (2, [2.0, 0.0], None), (3, None, 1), (4, [], 1),
       (5, [0.0, 0.0], 1), (6, [1.0, None], 1), (7, [float("nan"), 1.0], 1), (8, [1.0, 0.0, 0.0], 1),
       (None, [1.0, 0.0], 1), (9, [float("inf"), 1.0], 1), (10, [0.0, 1.0], 1), (11, [3e38, 0.0], 1)]


def test_odd_vectors_link_with_nothing(spark):
    df = spark.createDataFrame([(i, v, k, "x", 0) for i, v, k in ODD], VECTORS)
    rows = flat_graph.near_duplicates(df).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows}
    assert len(rows) == len(ODD)
    assert got[1] == (4, 1, True) and got[2] == (4, 1, False) and got[11] == (4, 1, False)
    assert got[None] == (4, 1, False)
    for i in (3, 4, 5, 6, 7, 8, 9, 10):
        assert got[i] == (0, i, True)
    assert flat_graph.near_duplicates(df.limit(0)).collect() == []


# Hard negatives


def mined_by_sorting(ids, labels, vectors):
    v = np.floor(256 * np.array(vectors, np.float64)).astype(np.int64)
    out = []
    for a in range(len(ids)):
        if ids[a] % 10:
            continue
        order = sorted((int(-(v[a] @ v[b])), ids[b], b) for b in range(len(ids)) if ids[b] != ids[a])
        for p, pid, _ in [o for o in order if labels[o[2]] == labels[a]][:5]:
            negatives = [o for o in order if labels[o[2]] != labels[a] and -80 * p <= -100 * o[0] <= -100 * p]
            out += [(ids[a], pid, k + 1, o[1], -p, -o[0]) for k, o in enumerate(negatives[:5])]
    return sorted(out)


@pytest.mark.parametrize("cells", [None, 100])
@pytest.mark.parametrize("kind", ["normal", "ties", "skewed"])
def test_negatives_equal_a_full_sort(spark, monkeypatch, kind, cells):
    if cells:
        monkeypatch.setattr(hard_negatives, "BLOCK_CELLS", cells * 6)
        monkeypatch.setattr(hard_negatives, "ANCHOR_CELLS", 6 * 7)
    rng = np.random.default_rng(8)
    n = 400
    x = {"normal": rng.standard_normal((n, 6)), "ties": rng.integers(-1, 2, (n, 6)) / 4,
         "skewed": np.exp(rng.standard_normal((n, 6)))}[kind].astype(np.float32)
    labels = [int(k) for k in np.where(rng.random(n) < 0.34, 0, rng.integers(0, 4, n))]
    ids = [int(i) for i in rng.permutation(n)]
    df = spark.createDataFrame([(i, v.tolist(), k, "x", 0) for i, v, k in zip(ids, x, labels)], VECTORS)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0).collect()
    assert sorted(tuple(r) for r in got) == mined_by_sorting(ids, labels, x)


def test_search_stops_once_the_threshold_is_below_the_windows():
    x = np.zeros((5000, 3), np.int64)
    x[:, 0] = np.arange(5000)
    met = list(hard_negatives.SortedLists(x).met(np.array([2, 0, 0])))
    assert len(met[0][0]) == hard_negatives.FIRST_DEPTH and met[0][2] == 2 * (5000 - 64)
    window = hard_negatives._Window(5)
    hard_negatives._search(hard_negatives.SortedLists(x), np.arange(5000), np.zeros(5000), np.array([2, 0, 0]),
                           -1, 0, [window], True)
    assert window.ids.tolist() == [4999, 4998, 4997, 4996, 4995]


def test_odd_vectors_take_no_part(spark):
    rows = [(i, v, k, "x", 0) for i, v, k in ODD] + [
        (20, [1.0, 0.0], 1, "x", 0), (20, [1.0, 0.0], 1, "x", 0), (21, [1.0, 0.0], 2, "y", 0)]
    df = spark.createDataFrame(rows, VECTORS)
    got = hard_negatives.mine(df, F.col("vec_id") % 20 == 0).collect()
    # Of label 1 with two components there are 1, 5, 10 and the anchor.
    assert sorted((r.positive_id, r.negative_id, r.positive_score) for r in got) == [(1, 21, 65536)]
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
