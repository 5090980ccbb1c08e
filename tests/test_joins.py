import random

import pytest
from harness import Harness

from tidemark.config import END_OF_TIME as END
from tidemark.operators.joins import (
    join_state,
    latest_state,
    latest_state_join,
    point_in_time_join,
)
from tidemark.operators.skew import salt_hot_keys
from tidemark.streaming.processors import LatestStateJoin

DIM = "k INT, sk STRING, validFrom BIGINT, validTo BIGINT"
FACT = "id INT, fk INT, ts_ms BIGINT"


def run(spark, facts, dims, **options):
    left = spark.createDataFrame(facts, FACT)
    right = spark.createDataFrame(dims, DIM)
    rows = point_in_time_join(left, right, ("fk", "k"), "ts_ms", **options).collect()
    return sorted(tuple(r) for r in rows)


def test_edges_of_validity(spark):
    dims = [(1, "a", 100, 199), (1, "b", 200, END)]
    facts = [(i, 1, t) for i, t in enumerate((99, 100, 198, 199, 200))]
    assert run(spark, facts, dims) == [
        (1, 1, 100, "a"), (2, 1, 198, "a"), (4, 1, 200, "b")]
    assert (3, 1, 199, "a") in run(spark, facts, dims, inclusive_end=True)
    assert run(spark, facts, dims, how="left_anti") == [(0, 1, 99), (3, 1, 199)]
    assert len(run(spark, facts, dims, how="left")) == 5


def test_open_delete_row_does_not_match_beside_its_successor(spark):
    dims = [(1, "a", 100, 199), (1, "deleted", 200, END), (1, "b", 300, END)]
    assert run(spark, [(1, 1, 250), (2, 1, 350)], dims) == [
        (1, 1, 250, "deleted"), (2, 1, 350, "b")]


@pytest.mark.parametrize("options", [
    {}, {"rows_per_cut": 4}, {"rows_per_cut": 1}, {"dimension_rows": 1000},
    {"rows_per_cut": 3, "dimension_rows": 1000}, {"disjoint": True, "rows_per_cut": 5},
    {"how": "left", "rows_per_cut": 4}, {"how": "left_anti", "rows_per_cut": 4},
    {"rows_per_part": 20}, {"rows_per_part": 20, "rows_per_cut": 5},
    {"rows_per_part": 20, "how": "left"}, {"rows_per_part": 9, "how": "left_anti"}])
def test_hot_key_matches_a_walk(spark, options):
    """One key with a third of all facts and most versions."""
    rng = random.Random(11)
    dims = []
    for k in range(30):
        starts = sorted(rng.sample(range(0, 2000), 300 if k == 0 else 4))
        for i, start in enumerate(starts):
            end = starts[i + 1] - 1 if i + 1 < len(starts) else END
            dims.append((k, f"{k}-{start}", start, end))
    facts = [(i, 0 if i % 3 == 0 else rng.randrange(40), rng.randrange(-50, 2100))
             for i in range(900)]
    expected = []
    for i, k, ts in facts:
        match = [d[1] for d in dims if d[0] == k and d[2] <= ts < d[3]]
        how = options.get("how", "inner")
        if how == "left_anti":
            expected += [] if match else [(i, k, ts)]
        elif match or how == "left":
            expected.append((i, k, ts, match[0] if match else None))
    assert run(spark, facts, dims, **options) == sorted(expected, key=lambda r: r[:3])
    if "rows_per_part" in options:
        sample = spark.createDataFrame(facts, FACT).select("fk", "ts_ms")
        assert run(spark, facts, dims, keys_from=sample, **options) == sorted(
            expected, key=lambda r: r[:3])


CHILD = "ck INT, pk INT, ts_ms BIGINT, op STRING, name STRING"
PARENT = "pk INT, ts_ms BIGINT, op STRING, title STRING"


def walk(children, parents):
    """Latest-state simulation: all changes in time order, a child is where it moved to."""
    state, known, out = {}, {}, set()
    for c in sorted([(*c[2:3], 1, c) for c in children] + [(p[1], 0, p) for p in parents]):
        ts, is_child, row = c
        if is_child:
            state[row[0]] = row
            if row[1] in known:
                out.add((row[0], row[1], ts, row[4], known[row[1]]))
        elif row[2] != "d":
            known[row[0]] = row[3]
            for child in state.values():
                if child[1] == row[0] and child[3] != "d":
                    out.add((child[0], row[0], ts, child[4], row[3]))
    return sorted(out)


@pytest.mark.parametrize("options", [
    {}, {"rows_per_cut": 1}, {"rows_per_cut": 10}, {"rows_per_part": 15},
    {"rows_per_cut": 3, "rows_per_part": 15}])
@pytest.mark.parametrize("seed", range(2))
def test_latest_state_join_matches_a_walk(spark, seed, options):
    rng = random.Random(seed)
    times = rng.sample(range(10_000), 400)
    children = [(rng.randrange(25), 0 if rng.random() < 0.4 else rng.randrange(5), t,
                 rng.choice("cuuud"), f"n{t}") for t in times[:250]]
    parents = [(0 if rng.random() < 0.5 else rng.randrange(5), t, rng.choice("cuuud"), f"t{t}")
               for t in times[250:]]
    got = latest_state_join(
        spark.createDataFrame(children, CHILD), spark.createDataFrame(parents, PARENT), "pk", "ck",
        parent_columns={"title": "title"}, **options).collect()
    assert sorted((r["ck"], r["pk"], r["ts_ms"], r["name"], r["title"]) for r in got) == walk(
        children, parents)


def test_parent_after_child_and_effective_time(spark):
    children = spark.createDataFrame([(1, 7, 100, "c", "book")], CHILD)
    parents = spark.createDataFrame([(7, 150, "c", "v0"), (7, 300, "u", "v1")], PARENT)
    rows = latest_state_join(children, parents, "pk", "ck", parent_columns={"title": "title"})
    assert sorted((r["ts_ms"], r["title"]) for r in rows.collect()) == [(150, "v0"), (300, "v1")]
    rows = latest_state_join(children, parents, "pk", "ck", effective_time="child",
                             parent_columns={"title": "title", "ts_ms": "parent_ts_ms"})
    assert sorted((r["ts_ms"], r["parent_ts_ms"]) for r in rows.collect()) == [
        (100, 150), (100, 300)]
    with pytest.raises(ValueError):
        latest_state_join(children, parents, "pk", "ck", effective_time="x", parent_columns={})


COLUMNS = ["ts", "tie", "id", "op", "payload"]


def test_stream_join_emits_on_both_sides():
    h = Harness(LatestStateJoin())
    h.send((100, 0, "1", "c", "b1"), (110, 0, "2", "c", "b2"), columns=COLUMNS)
    assert h.output == []
    h.send((150, 0, None, "c", "a0"), columns=COLUMNS)
    assert sorted(h.output) == [("b1", "a0", "c", 150, 0), ("b2", "a0", "c", 150, 0)]
    h.send((200, 0, "1", "u", "b1x"), columns=COLUMNS)
    assert h.output[-1] == ("b1x", "a0", "u", 200, 0)
    h.send((250, 0, None, "d", "gone"), (120, 0, None, "u", "old"), columns=COLUMNS)
    assert len(h.output) == 3


def test_stream_join_in_child_time():
    h = Harness(LatestStateJoin("child"))
    h.send((100, 0, "1", "c", "b"), (150, 0, None, "c", "a"), columns=COLUMNS)
    assert h.output == [("b", "a", "c", 100, 0)]


def test_latest_state(spark):
    df = spark.createDataFrame(
        [(1, 7, 5, "c", "old"), (1, 7, 9, "u", "new"), (2, 7, 1, "c", "only")], CHILD)
    assert sorted((r["ck"], r["name"]) for r in latest_state(df, "ck").collect()) == [
        (1, "new"), (2, "only")]


def test_hot_key_is_split(spark):
    """Copies of one row spread over the parts, and each part meets the state."""
    rows = spark.range(0, 4000, 1, 8).selectExpr(
        "0 AS id", "CASE WHEN id % 3 = 0 THEN 7 ELSE CAST(id AS INT) END AS fk", "5L AS ts_ms")
    state = spark.range(4000).selectExpr("CAST(id AS INT) AS fk", "id * 2 AS twice")
    salted = salt_hot_keys(rows, state.withColumnRenamed("fk", "k"), ["fk"], ["k"],
                           spread_by="id", rows_per_part=300)
    sizes = [r["count"] for r in salted.left.where("fk = 7").groupBy("__part").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 600 and sum(sizes) == 1335
    assert salted.right.where("k <> 7").count() == 3999
    got = join_state(rows, state, "fk", spread_by="id", rows_per_part=300)
    assert got.columns == ["id", "fk", "ts_ms", "twice"]
    assert got.count() == 4000 and got.where("twice <> fk * 2").count() == 0


def test_short_keys_are_not_cut(spark):
    from tidemark.operators import joins

    short = spark.range(4000).selectExpr("id AS k", "id AS validFrom")
    assert not joins._cuts_of_long_keys(short, "k", "validFrom", 4)
    long = short.unionByName(spark.range(400).selectExpr("-1L AS k", "id AS validFrom"))
    kept = joins._cuts_of_long_keys(long, "k", "validFrom", 4)
    assert [r["k"] for r in kept.by_key.select("k").collect()] == [-1]


def test_packed_keys_come_back(spark):
    from tidemark.functions.columns import packed_key, unpacked_key

    keys = [None, "", "x", "0123456789abcde", "0" * 32, "0123456789abcdef" * 2, "0123456789ABCDEF" * 2,
            "é" * 8, "f" * 32 + "\n", "g" * 32, "a" * 33]
    held = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i INT, sk STRING")
    packed = held.withColumn("sk", packed_key("sk"))
    assert [r[0] for r in packed.orderBy("i").selectExpr("length(sk)").collect()][4:6] == [16, 16]
    assert [r["sk"] for r in packed.withColumn("sk", unpacked_key("sk")).orderBy("i").collect()] == keys


def test_facts_of_large_tables_shuffle_once_for_each_join(spark, sf_dir, monkeypatch):
    """Hot keys are looked for in the feeds alone, versions are joined as their window left
    them, and surrogate keys are packed on the way."""
    from tidemark.bindings import queries
    from tidemark.operators import joins

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    looked = []
    salt = joins.salt_hot_keys

    def spy(*args, sample_from=None, **options):
        looked.append(plan(sample_from))
        return salt(*args, sample_from=sample_from, **options)

    monkeypatch.setattr(joins, "salt_hot_keys", spy)
    monkeypatch.setattr(joins, "_is_small", lambda *_: False)
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    expected = {tuple(r) for r in queries.fact_order_items(spark, sf_dir).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        del looked[:]
        fact = queries.fact_order_items(spark, sf_dir)
        assert len(looked) == 4 and not any("Exchange" in p for p in looked)
        # Items and the orders' window; the versions of orders go into the join as they are.
        text = plan(fact)
        assert text.count("Exchange hashpartitioning(order_id") == 2
        assert text.count("Exchange hashpartitioning(orderId") == 0
        assert {tuple(r) for r in fact.collect()} == expected
        del looked[:]
        shipped = queries.fact_shipment_events(spark, sf_dir)
        assert looked and not any("Exchange" in p for p in looked)
        assert shipped.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_last_state_of_events(spark):
    from tidemark.plans.facts import live_rows

    changes = spark.createDataFrame(
        [(1, "a", "c", 5, 1), (1, "b", "u", 5, 2), (1, None, "u", 4, 9), (2, "x", "c", 1, 1),
         (2, "x", "d", 2, 2), (3, "y", None, 7, None), (None, "z", "c", 1, 1), (4, "z", "c", None, 1)],
        "id INT, name STRING, op STRING, ts_ms BIGINT, lsn BIGINT")
    found = sorted(tuple(r) for r in live_rows(changes, "id").collect())
    assert found == [(1, "b", "u", 4, 2), (3, "y", None, 7, None)]


def test_reports_group_by_packed_keys(spark):
    from tidemark.plans.reports import sales_by

    keys = ["0" * 32, "f" * 32, "other"]
    facts = spark.createDataFrame([(k, 2, 1.5) for k in [*keys, *keys]], "sk STRING, quantity INT, priceTotal DOUBLE")
    dimension = spark.createDataFrame([(k, k[0]) for k in keys], "sk STRING, name STRING")
    report = sales_by(facts, dimension, "sk", ["name"])
    assert sorted(tuple(r) for r in report.collect()) == [("0", 2, 4, 3.0), ("f", 2, 4, 3.0), ("o", 2, 4, 3.0)]
    assert "unhex" in report._jdf.queryExecution().optimizedPlan().toString()
