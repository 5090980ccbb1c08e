"""Branches of reply trees against a walk over every path."""

import random

from tidemark.llm import chat_trees


def walk(rows, most):
    """(branch, rank, turn, node) of the chosen branches, from all root-to-leaf paths."""
    parent = {n: p for n, p, _ in rows}
    score = {n: s or 0.0 for n, _, s in rows}
    trees = {}
    for leaf in set(parent) - set(parent.values()):
        path = [leaf]
        while parent.get(path[-1]) in parent and len(path) <= len(rows):
            path.append(parent[path[-1]])
        if len(path) <= len(rows):
            order = (-sum(score[n] for n in path) / len(path), -len(path), leaf)
            trees.setdefault(path[-1], []).append((order, path[::-1]))
    return sorted((path[-1], k + 1, turn, node)
                  for branches in trees.values() for k, (_, path) in enumerate(sorted(branches)[:most])
                  for turn, node in enumerate(path))


def chosen(spark, rows, most):
    messages = spark.createDataFrame(rows, "node long, parent long, score double")
    best = chat_trees.best_branches(messages, most=most)
    return sorted(tuple(r) for r in best.select("branch", "rank", "turn", "node").collect())


def test_random_forests_equal_a_walk(spark):
    rng = random.Random(7)
    # Scores of quarters add up exactly, and often tie.
    rows = [(n, rng.choice([None, 10_000 + n] + [rng.randrange(n)] * 8) if n else None,
             rng.choice([None, 0.0, 0.25, 0.5, 1.0])) for n in range(150)]
    rows += [(200, 202, 1.0), (201, 200, 1.0), (202, 201, 1.0), (203, 202, 9.0)]  # a cycle and a leaf on it
    for most in (1, 3):
        assert chosen(spark, rows, most) == walk(rows, most)


def test_only_chosen_paths_are_listed(spark, monkeypatch):
    # A chain with a reply on each message: all paths together have some 20,000 messages.
    n = 200
    rows = [(k, k - 1 if k else None, 1.0) for k in range(n)]
    rows += [(1000 + k, k, 2.0 if k == 150 else 0.5) for k in range(n)]
    sizes, plain = [], chat_trees.checkpointed
    monkeypatch.setattr(chat_trees, "checkpointed", lambda df: sizes.append((df := plain(df)).count()) or df)
    assert chosen(spark, rows, 1) == walk(rows, 1)
    assert max(sizes) <= len(rows)
