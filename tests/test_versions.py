"""Version and consolidation cases, in batch and streaming form."""

import json
import random

import pytest
from harness import Harness
from pyspark.sql import functions as F

from tidemark.config import END_OF_TIME as END
from tidemark.operators import scd2
from tidemark.streaming.processors import (
    AsOfJoin,
    Consolidator,
    LatestStateJoin,
    ParentChanges,
    VersionBuilder,
)

SCHEMA = "id INT, ts_ms BIGINT, op STRING, status STRING"

# Changes (time, operation) in arrival order, and the changelog rows they give.
CASES = {
    "single insert": ([(1000, "c")], [(1000, END)]),
    "in order": ([(1000, "c"), (2000, "u"), (3000, "u")],
                 [(1000, END), (1000, 1999), (2000, END), (2000, 2999), (3000, END)]),
    "out of order": ([(3000, "u"), (1000, "c"), (2000, "u")],
                     [(1000, END), (1000, 1999), (2000, END), (2000, 2999), (3000, END)]),
    "delete": ([(1000, "c"), (2000, "d")], [(1000, END), (1000, 1999), (2000, END)]),
    "far apart": ([(1000, "c"), (21000, "u")], [(1000, END), (1000, 20999), (21000, END)]),
    "delete then insert": ([(1000, "c"), (2000, "d"), (3000, "c")],
                           [(1000, END), (1000, 1999), (2000, END), (3000, END)]),
    "update without state": ([(1000, "u")], [(1000, END)]),
    "real times": ([(1753177299838, "c"), (1753506450424, "u")],
                   [(1753177299838, END), (1753177299838, 1753506450423),
                    (1753506450424, END)]),
}


def versions(spark, rows, **options):
    df = spark.createDataFrame([(i, t, o, s) for i, t, o, s in rows], SCHEMA)
    return scd2.scd2_versions(df, "id", {"id": "id", "status": "status"}, sk="sk", entity="t",
                              **options)


def pairs(df):
    return sorted((r["validFrom"], r["validTo"]) for r in df.collect())


@pytest.mark.parametrize("name", CASES)
def test_batch_changelog(spark, name):
    changes, expected = CASES[name]
    log = scd2.as_changelog(versions(spark, [(1, t, o, "x") for t, o in changes]))
    assert pairs(log) == sorted(expected)


@pytest.mark.parametrize("name", CASES)
def test_stream_changelog(name):
    changes, expected = CASES[name]
    h = Harness(VersionBuilder(10_000, event_time=False))
    h.send(*[(t, 0, o, "{}") for t, o in changes], columns=["ts", "tie", "op", "payload"])
    got = [(r[2], r[3]) for r in h.clock(10_000)]
    assert sorted(got) == sorted(expected)
    # In the order of the changes: a version closes before its successor opens.
    assert [f for f, _ in got] == sorted(f for f, _ in got)


def test_buffer_timeout():
    h = Harness(VersionBuilder(10_000, event_time=False))
    h.now = 5000
    h.send((1000, 0, "c", "{}"), columns=["ts", "tie", "op", "payload"])
    assert h.clock(14_999) == []
    assert len(h.clock(15_000)) == 1


def test_event_time_buffer_keeps_what_the_watermark_has_not_passed():
    h = Harness(VersionBuilder(100))
    h.send((1000, 0, "c", "a"), (5000, 0, "u", "c"), columns=["ts", "tie", "op", "payload"])
    assert [r[1:4] for r in h.clock(1100)] == [("a", 1000, END)]
    h.send((2000, 0, "u", "b"), columns=["ts", "tie", "op", "payload"])
    h.clock(9000)
    assert [r[1:4] for r in h.output[1:]] == [
        ("a", 1000, 1999), ("b", 2000, END), ("b", 2000, 4999), ("c", 5000, END)]


def test_late_change_is_marked_and_changes_nothing():
    h = Harness(VersionBuilder(0, event_time=False))
    h.send((5000, 0, "c", "a"), columns=["ts", "tie", "op", "payload"])
    h.clock(1)
    h.send((1000, 0, "u", "late"), columns=["ts", "tie", "op", "payload"])
    assert h.clock(2)[-1] == ("1", "late", 1000, None, True)
    h.send((6000, 0, "u", "b"), columns=["ts", "tie", "op", "payload"])
    assert [r[1:4] for r in h.clock(3)[2:]] == [("a", 5000, 5999), ("b", 6000, END)]


def test_keys_do_not_mix_and_attributes_follow(spark):
    rows = [(1, 1000, "c", "pending"), (1, 2000, "u", "shipped"), (2, 3000, "c", "pending")]
    log = scd2.as_changelog(versions(spark, rows)).collect()
    got = sorted((r["id"], r["validFrom"], r["validTo"], r["status"]) for r in log)
    assert got == [(1, 1000, 1999, "pending"), (1, 1000, END, "pending"),
                   (1, 2000, END, "shipped"), (2, 3000, END, "pending")]


def test_delete_row_keeps_its_status(spark):
    log = scd2.as_changelog(
        versions(spark, [(1, 1000, "c", "pending"), (1, 2000, "d", "cancelled")])).collect()
    assert sorted((r["validFrom"], r["validTo"], r["status"]) for r in log) == [
        (1000, 1999, "pending"), (1000, END, "pending"), (2000, END, "cancelled")]


def test_closing_row_has_the_key_of_the_version(spark):
    log = scd2.as_changelog(versions(spark, [(1, 1000, "c", "a"), (1, 2000, "u", "b")])).collect()
    assert len({r["sk"] for r in log if r["validFrom"] == 1000}) == 1
    assert len({r["sk"] for r in log}) == 2


def test_delete_row_modes(spark):
    rows = [(1, 1000, "c", "a"), (1, 2000, "d", "b"), (1, 3000, "c", "c")]
    assert pairs(versions(spark, rows)) == [(1000, 1999), (2000, END), (3000, END)]
    assert pairs(versions(spark, rows, delete_rows="closed")) == [
        (1000, 1999), (2000, 2999), (3000, END)]
    assert pairs(versions(spark, rows, delete_rows="drop")) == [(1000, 1999), (3000, END)]
    with pytest.raises(ValueError):
        versions(spark, rows, delete_rows="none")


def test_last_change_of_an_instant_wins(spark):
    df = spark.createDataFrame(
        [(1, 1000, "c", "first", 1), (1, 1000, "u", "last", 3), (1, 1000, "u", "mid", 2),
         (1, 2000, "u", "next", 4)], SCHEMA + ", lsn BIGINT")
    got = scd2.scd2_versions(df, "id", {"id": "id", "status": "status"}, sk="sk", entity="t")
    assert sorted((r["validFrom"], r["status"]) for r in got.collect()) == [
        (1000, "last"), (2000, "next")]


CONSOLIDATION = ["validFrom", "validTo", "payload"]


def test_consolidation_overwrite():
    h = Harness(Consolidator(50), "A")
    h.send((10, END, "{}"), columns=CONSOLIDATION)
    h.send((10, 19, "{}"), columns=CONSOLIDATION)
    assert [r[2:] for r in h.clock(50)] == [(10, 19)]


def test_consolidation_timer():
    h = Harness(Consolidator(50), "A")
    h.send((10, END, "{}"), columns=CONSOLIDATION)
    assert h.clock(49) == []
    assert [r[2:] for r in h.clock(50)] == [(10, END)]


def test_consolidation_late_closure():
    h = Harness(Consolidator(50), "A")
    h.send((10, END, "{}"), columns=CONSOLIDATION)
    h.clock(50)
    h.send((10, 90, "{}"), columns=CONSOLIDATION)
    assert [r[2:] for r in h.clock(100)] == [(10, END), (10, 90)]


@pytest.mark.parametrize("rows", [[(10, 19)], [(10, 49)], [(10, 50)], [(10, 90)], [(10, 90), (10, 19)], []])
@pytest.mark.parametrize("apart", [False, True])
def test_consolidation_does_not_depend_on_batches(rows, apart):
    h = Harness(Consolidator(50), "A")
    rows = [(*r, "{}") for r in [*rows, (10, END)]]
    for part in [[r] for r in rows] if apart else [rows]:
        h.send(*part, columns=CONSOLIDATION)
    got = [r[2:] for r in h.clock(500)]
    first = min(e for _, e, _ in rows)
    assert got == ([(10, END)] if first == END or first + 1 > 50 else []) + ([(10, first)] if first != END else [])


JOINED = ["id", "ts", "stop", "revision", "payload"]


def version(start, stop=END):
    return None, start, stop, None, f"v{start}"


def fact(name, ts, revision=1):
    return name, ts, None, revision, f"{name}.{revision}"


def test_fact_waits_for_the_dimension():
    h = Harness(AsOfJoin())
    h.send(fact("a", 150), fact("b", 250), fact("c", 50), columns=JOINED)
    assert h.clock(40) == []
    h.send(version(100), columns=JOINED)
    assert h.clock(120) == [("c.1", None)]
    h.send(version(200), version(100, 199), columns=JOINED)
    assert h.clock(200)[1:] == [("a.1", "v100")]
    assert h.clock(300)[2:] == [("b.1", "v200")]
    # A fact from behind the watermark is joined at once, with the version of its time.
    h.send(fact("d", 120, 7), columns=JOINED)
    assert h.output[3:] == [("d.7", "v100")]


def test_fact_meets_no_version_that_has_ended():
    h = Harness(AsOfJoin())
    h.send(version(100), version(100, 199), fact("a", 199), fact("b", 198), columns=JOINED)
    assert sorted(h.clock(500)) == [("a.1", None), ("b.1", "v100")]
    h = Harness(AsOfJoin(inclusive_end=True))
    h.send(version(100, 199), fact("a", 199), columns=JOINED)
    assert h.clock(500) == [("a.1", "v100")]


def test_patience_gives_late_versions_a_chance():
    h = Harness(AsOfJoin(patience_ms=100))
    h.send(fact("a", 50), fact("b", 60), fact("b", 60, 2), columns=JOINED)
    assert h.clock(90) == []
    h.send(version(10), columns=JOINED)
    assert sorted(h.output) == [("a.1", "v10"), ("b.2", "v10")]
    h.send(fact("c", 5), columns=JOINED)
    assert h.clock(104)[2:] == [] and h.clock(105)[2:] == [("c.1", None)]


@pytest.mark.parametrize("batches", [1, 3, 20])
def test_as_of_join_equals_a_walk_in_any_batches(batches):
    rng = random.Random(batches)
    starts = sorted(rng.sample(range(1000), 30))
    log = [(s, version(s)) for s in starts]
    log += [(b, version(a, b - 1)) for a, b in zip(starts, starts[1:])]
    facts = [(rng.randrange(1000), fact(f"f{k}", rng.randrange(1000))) for k in range(200)]
    h, now = Harness(AsOfJoin()), 0
    for k in range(batches):
        low, high = 1000 * k // batches, 1000 * (k + 1) // batches
        rows = [r for at, r in log + facts if low <= at < high]
        rng.shuffle(rows)
        h.send(*rows, columns=JOINED)
        h.clock(high - 1)
    got = dict(h.clock(5000))
    for _, (name, ts, *_) in facts:
        before = [s for s in starts if s <= ts]
        valid = before and (before[-1] == starts[-1] or ts < starts[len(before)] - 1)
        assert got[f"{name}.1"] == (f"v{before[-1]}" if valid else None)


def test_batch_consolidation_cases(spark):
    def run(rows, window=None):
        log = spark.createDataFrame(rows, "sk STRING, validFrom BIGINT, validTo BIGINT")
        return pairs(scd2.consolidate(log, "sk") if window is None
                     else scd2.consolidate_in_windows(log, "sk", window))

    assert run([("A", 10, END), ("A", 10, 19)]) == [(10, 19)]
    assert run([("A", 10, END), ("A", 10, 19)], 50) == [(10, 19)]
    assert run([("A", 10, END)], 50) == [(10, END)]
    assert run([("A", 10, END), ("A", 10, 90)], 50) == [(10, 90), (10, END)]
    assert run([("A", 10, 19), ("A", 10, 19), ("A", 10, END)]) == [(10, 19)]


def reference_versions(changes):
    """Versions of one key by walking through its changes."""
    out, current = [], None
    for ts, op, status in sorted({c[0]: c for c in changes}.values()):
        if current is not None:
            out.append((current[0], ts - 1, current[1]))
        if op == "d":
            out.append((ts, END, status))
            current = None
        else:
            current = (ts, status)
    if current is not None:
        out.append((current[0], END, current[1]))
    return sorted(out)


@pytest.mark.parametrize("rows_per_cut", [None, 3, 25])
def test_long_keys_and_copies_match_a_walk(spark, rows_per_cut):
    """A third of the rows on one key, and many copies of one of its rows."""
    rng = random.Random(5)
    rows = {}
    for _ in range(3000):
        key = 0 if rng.random() < 0.34 else rng.randrange(1, 400)
        ts = rng.randrange(0, 4000)
        rows[key, ts] = (key, ts, rng.choice("cuud"), rng.choice("abc"))
    changes = list(rows.values())
    copies = changes + [rows[next(k for k in rows if k[0] == 0)]] * 1500
    rng.shuffle(copies)
    options = {} if rows_per_cut is None else {"rows_per_cut": rows_per_cut}
    got = versions(spark, copies, **options).collect()
    expected = []
    for key in {c[0] for c in changes}:
        mine = [(c[1], c[2], c[3]) for c in changes if c[0] == key]
        expected += [(key, *v) for v in reference_versions(mine)]
    assert sorted((r["id"], r["validFrom"], r["validTo"], r["status"]) for r in got) == sorted(
        expected)
    # Changelog rows: every version opens, all but the last open ones close.
    log = scd2.as_changelog(versions(spark, copies, **options)).count()
    deletes_not_last = len(expected) - sum(1 for e in expected if e[2] != END)
    assert log == 2 * len(expected) - deletes_not_last


@pytest.mark.parametrize("rows_per_cut", [None, 2])
def test_unchanged_updates_are_left_out(spark, rows_per_cut):
    rng = random.Random(8)
    rows = [(k, ts, rng.choice("uuuud"), rng.choice("ab")) for k in (1, 2) for ts in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    options = {} if rows_per_cut is None else {"rows_per_cut": rows_per_cut}
    got = scd2.drop_unchanged(df, "id", ["status"], **options).collect()
    expected, before = [], {}
    for row in sorted(rows):
        state = (row[3], row[2] == "d")
        if row[2] == "d" or before.get(row[0]) != state:
            expected.append(row)
        before[row[0]] = state
    assert sorted(tuple(r) for r in got) == expected


@pytest.mark.parametrize("rows_per_cut", [None, 1, 2])
def test_integrity_report(spark, rows_per_cut):
    rows = [("a", 1, 9), ("a", 10, 19), ("a", 30, 25), ("b", 1, 20), ("b", 10, END), ("c", 1, 5),
            ("c", 7, END)]
    df = spark.createDataFrame(rows, "key STRING, validFrom BIGINT, validTo BIGINT")
    options = {} if rows_per_cut is None else {"rows_per_cut": rows_per_cut}
    got = scd2.integrity_report(df, "key", **options).collect()
    assert sorted((r["key"], r["validFrom"], r["problem"]) for r in got) == [
        ("a", 10, "gap"), ("a", 30, "inverted"), ("b", 1, "overlap"), ("c", 1, "gap")]


def test_input_order_does_not_matter(spark):
    rng = random.Random(3)
    rows = [(k, ts, "u", str(ts)) for k in range(5) for ts in range(0, 500, 50)]
    first = sorted(versions(spark, rows).collect())
    rng.shuffle(rows)
    assert sorted(versions(spark, rows).collect()) == first


def test_payloads_survive_the_stream_format(spark):
    """A processor carries the rest of a row as text; nothing gets lost in it."""
    from tidemark.streaming.operators import _packed, _unpacked

    df = spark.sql("SELECT 1L AS a, 1.5D AS b, CAST(NULL AS STRING) AS c, DATE '1931-02-03' AS d,"
                   " TIMESTAMP '2020-01-02 03:04:05.678901' AS e, 12.30BD AS f, 'x\"y' AS g")
    back = _unpacked(df.select(_packed(df.columns).alias("p")), "p", df.schema).select("p.*")
    assert back.collect() == df.collect()
    assert json.loads(df.select(_packed(df.columns)).first()[0])["c"] is None
    assert df.select(F.lit(1)).count() == 1


def test_redelivered_change_keeps_the_version():
    h = Harness(VersionBuilder(0))
    columns = ["ts", "tie", "op", "payload"]
    for op, payload in (("u", "a"), ("d", "b")):
        ts = {"u": 1000, "d": 2000}[op]
        for _ in range(2):
            h.send((ts, 1, op, payload), columns=columns)
            h.clock(ts)
    assert h.output == [("1", "a", 1000, END, False), ("1", "a", 1000, 1999, False),
                        ("1", "b", 2000, END, False)]


def test_moved_child_leaves_its_parent():
    moves = Harness(ParentChanges(), key="7")
    columns = ["ts", "tie", "parent", "op", "payload"]
    moves.send((10, 1, "A", "c", "x"), (30, 3, "C", "u", "z"), columns=columns)
    moves.send((20, 2, "B", "u", "y"), (30, 3, "C", "u", "z"), columns=columns)
    told = [(r[0], r[2], r[4]) for r in moves.output]
    assert told == [("A", 10, "c"), ("C", 30, "u"), ("A", 30, "left"),
                    ("B", 20, "u"), ("B", 30, "left"), ("C", 30, "u")]
    join = Harness(LatestStateJoin(), key="A")
    rows = ["ts", "tie", "id", "op", "payload"]
    join.send((5, 0, None, "c", "p0"), (10, 1, "7", "c", "x"), columns=rows)
    join.send((30, 3, "7", "left", None), (30, 0, None, "u", "p1"), (40, 0, None, "u", "p2"),
              columns=rows)
    assert [(r[0], r[1], r[3]) for r in join.output] == [("x", "p0", 10)]
