"""As-of joins over sorted ranges, and NULL keys in joins that keep all facts."""

import random

import pytest

from tidemark.config import END_OF_TIME as END
from tidemark.operators.joins import point_in_time_join, without_match
from tidemark.operators.ranges import as_of_join

FACTS = "id INT, k BIGINT, ts_ms BIGINT, name STRING"
VERSIONS = "key BIGINT, validFrom BIGINT, validTo BIGINT, sk STRING, n INT"


def tables(spark, seed, overlap=0.1):
    """A third of all facts on one key, which has most of the versions, and a third without key."""
    rng = random.Random(seed)
    versions = []
    for key in range(40):
        starts = sorted(rng.sample(range(3000), 400 if key == 0 else 4))
        for a, b in zip(starts, [*starts[1:], None]):
            end = END if b is None or rng.random() < overlap else b - 1 - (rng.random() < 0.2) * 5
            versions.append((key, a, end, f"{key}-{a}", key))
    facts = []
    for k in range(3000):
        key = rng.choice([0, None, rng.randrange(60)])
        facts.append((k, key, None if rng.random() < 0.02 else rng.randrange(3200), "x"))
    return facts, versions, spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)


def walked(facts, versions, inclusive):
    out = {}
    for k, key, ts, _ in facts:
        before = [v for v in versions if key is not None and ts is not None and v[0] == key and v[1] <= ts]
        last = max(before, default=None, key=lambda v: (v[1], v[2]))
        if last is not None and (ts <= last[2] if inclusive else ts < last[2]):
            out[k] = last[3]
    return out


@pytest.mark.parametrize("ranges", [None, 1, 37])
@pytest.mark.parametrize("inclusive", [False, True])
def test_as_of_join_equals_a_walk(spark, ranges, inclusive):
    rows, versions, facts, dimension = tables(spark, 2)
    want = walked(rows, versions, inclusive)

    def joined(how):
        return as_of_join(facts, dimension, ("k", "key"), "ts_ms", ["sk", "n"], inclusive_end=inclusive,
                          how=how, ranges=ranges)

    assert {r.id: r.sk for r in joined("inner").collect()} == want
    left = joined("left")
    assert left.columns == ["id", "k", "ts_ms", "name", "sk", "n"]
    got = {r.id: r.sk for r in left.collect()}
    assert len(got) == len(rows) and {k: v for k, v in got.items() if v is not None} == want
    assert {r.id for r in joined("left_anti").collect()} == {r[0] for r in rows} - want.keys()


def test_no_task_holds_a_hot_key(spark):
    _, _, facts, dimension = tables(spark, 3)
    joined = as_of_join(facts, dimension, ("k", "key"), "ts_ms", ["sk"], ranges=16)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    # The window's partitions are those of the ranges; nothing is shuffled by key.
    assert "Exchange hashpartitioning(key" not in plan


def test_copies_and_empty_tables(spark):
    facts = spark.createDataFrame([(1, 1, 5, "a")] * 3, FACTS)
    versions = spark.createDataFrame([(1, 0, END, "s", 1)] * 2 + [(1, 0, 3, "t", 1)], VERSIONS)
    assert [r.sk for r in as_of_join(facts, versions, ("k", "key"), "ts_ms", ["sk"]).collect()] == ["s"] * 3
    none = versions.limit(0)
    assert as_of_join(facts, none, ("k", "key"), "ts_ms", ["sk"]).count() == 0
    assert as_of_join(facts, none, ("k", "key"), "ts_ms", ["sk"], how="left").count() == 3
    assert as_of_join(facts.limit(0), versions, ("k", "key"), "ts_ms", ["sk"], how="left").count() == 0


def test_null_keys_stay_out_of_the_exchange(spark):
    rows, versions, facts, dimension = tables(spark, 4, overlap=0)
    want = walked(rows, versions, False)
    kept = without_match(facts, dimension, ("k", "key"), "ts_ms")
    assert {r.id for r in kept.collect()} == {r[0] for r in rows} - want.keys()
    left = point_in_time_join(facts, dimension, ("k", "key"), "ts_ms", how="left")
    got = {r.id: r.sk for r in left.collect()}
    assert len(got) == len(rows) and {k: v for k, v in got.items() if v is not None} == want
    for df in (kept, left):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" in plan and "isnotnull(k" in plan
