import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import assign_sequence, check_state, hold, hold_release, release
from rivulet.operators.state import HOLDING
from rivulet.plans.skew import OrderedGroups, Running, numbered

# A threshold that makes every larger group hot, and one that makes none.
SPLIT, WHOLE = 5, 10**9


@pytest.fixture(scope="module")
def wide(spark):
    """Many partitions, so that small groups can count as hot."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


def random_rows(seed, n=600):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["warm"] * 2 + [f"k{i}" for i in range(8)]
    return [(i, rng.choice(keys), rng.choice(["a", "b", "c", "10", "9", "", None]), rng.choice(["hold", "hold", "release"]), rng.choice(["1", "2", None, ""])) for i in range(n)]


SCHEMA = "ord long, key string, value string, op string, dup string"


def simulate_check(rows, mode, state):
    state, out = dict(state), {}
    for ord_, key, value, *_ in rows:
        if not value:
            out[ord_] = ("empty", None)
            continue
        old = state.get(key)
        if not old:
            state[key] = value
            out[ord_] = ("initial", None)
            continue
        route = "less" if value < old else "equal" if value == old else "greater"
        out[ord_] = (route, old)
        if (mode == "not_equal" and route != "equal") or mode == route:
            state[key] = value
    return out, state


@pytest.mark.parametrize("hot_rows", [SPLIT, WHOLE])
@pytest.mark.parametrize("mode", ["greater", "less", "equal", "not_equal", "never"])
def test_check_state_equals_row_by_row(wide, mode, hot_rows):
    rows = random_rows(1)
    initial = {"hot": "b", "k1": "c", "other": "z"}
    df = wide.createDataFrame(rows, SCHEMA)
    seeds = wide.createDataFrame(list(initial.items()), "key string, value string")
    result = check_state(df, "key", "value", ["ord"], mode, "prev", seeds, hot_rows=hot_rows)
    expected, state = simulate_check(rows, mode, initial)
    assert {r.ord: (r.route, r.prev) for r in result.rows.collect()} == expected
    final = {r.key: (r.value, r.updated) for r in result.state.collect()}
    assert {k: v for k, (v, _) in final.items()} == state
    assert final["other"] == ("z", False) and final["hot"][1]


def test_check_state_falls_back_to_content(spark):
    df = spark.createDataFrame([(1, "k", "", "x"), (2, "k", "y", "x"), (3, "k", None, "")], "ord int, key string, value string, content string")
    rows = {r.ord: r.route for r in check_state(df, "key", "value", ["ord"]).rows.collect()}
    assert rows == {1: "initial", 2: "greater", 3: "empty"}


def simulate_gate(rows, held):
    held, out = dict(held), {}
    for ord_, key, _, op, dup in rows:
        name = "t." + key
        if op == "release":
            out[ord_] = "success" if held.pop(name, None) is not None else "missing"
        elif name not in held:
            held[name] = dup or HOLDING
            out[ord_] = "success"
        else:
            out[ord_] = "duplicate" if dup and dup == held[name] else "busy"
    return out, held


@pytest.mark.parametrize("hot_rows", [SPLIT, WHOLE])
def test_hold_release_equals_row_by_row(wide, hot_rows):
    rows = random_rows(2)
    initial = {"t.hot": "1", "t.k2": HOLDING, "t.away": "9"}
    df = wide.createDataFrame(rows, SCHEMA)
    seeds = wide.createDataFrame(list(initial.items()), "key string, value string")
    result = hold_release(df, F.lit("t"), "key", "op", ["ord"], "dup", seeds, hot_rows=hot_rows)
    expected, held = simulate_gate(rows, initial)
    assert {r.ord: r.route for r in result.rows.collect()} == expected
    assert set(expected.values()) == {"success", "busy", "duplicate", "missing"}
    assert {r.key: r.value for r in result.state.collect() if r.value is not None} == held


def test_long_hold_runs_without_release_stay_exact(wide):
    """One key, no release for hundreds of rows: the held value must reach every later chunk."""
    rows = [(i, "hot", None, "hold", "a" if i % 3 else "b") for i in range(400)]
    df = wide.createDataFrame(rows, SCHEMA)
    got = {r.ord: r.route for r in hold_release(df, F.lit("t"), "key", "op", ["ord"], "dup", hot_rows=SPLIT).rows.collect()}
    assert got == simulate_gate(rows, {})[0]


def test_hold_and_release_alone(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "ord int, key string")
    held = hold(df, F.lit("t"), "key", ["ord"])
    assert {r.ord: r.route for r in held.rows.collect()} == {1: "success", 2: "busy"}
    freed = release(df, F.lit("t"), "key", ["ord"], held.state.filter("value is not null"))
    assert {r.ord: r.route for r in freed.rows.collect()} == {1: "success", 2: "missing"}


@pytest.mark.parametrize("hot_rows", [SPLIT, WHOLE])
def test_assign_sequence(wide, hot_rows):
    rows = random_rows(3)
    df = wide.createDataFrame(rows, SCHEMA)
    counters = wide.createDataFrame([("hot", 50), ("idle", 7)], "sequence string, current long")
    result = assign_sequence(df, "key", counters, ["ord"], start=100, increment=5, hot_rows=hot_rows)
    current, expected = {"hot": 50, "idle": 7}, {}
    for ord_, key, *_ in rows:
        current[key] = current[key] + 5 if key in current else 100
        expected[ord_] = current[key]
    assert {r.ord: r.sequence_value for r in result.rows.collect()} == expected
    state = {r.sequence: (r.current, r.updated) for r in result.state.collect()}
    assert {k: v for k, (v, _) in state.items()} == current and state["idle"] == (7, False)


@pytest.mark.parametrize("hot_rows", [SPLIT, WHOLE])
def test_running_values_of_every_kind(wide, hot_rows):
    rng = random.Random(4)
    rows = [(i, rng.choice("aaab"), rng.choice([None, 1, 5, 3])) for i in range(300)]
    rng.shuffle(rows)
    df = wide.createDataFrame(rows, "ord int, k string, v int")
    groups = OrderedGroups(df, ["k"], ["ord"], hot_rows)
    kinds = ["max", "min", "first", "last", "count", "sum", "total"]
    got = groups.with_running(*[Running(x, x, F.col("v")) for x in kinds]).result().collect()
    assert (groups.bounds is not None) == (hot_rows == SPLIT)
    for r in got:
        group = sorted(x for x in rows if x[1] == r.k)
        before = [v for o, _, v in group if o < r.ord and v is not None]
        assert r["max"] == max(before, default=None) and r["min"] == min(before, default=None)
        assert r["first"] == (before[0] if before else None) and r["last"] == (before[-1] if before else None)
        assert r["count"] == len(before) and r["sum"] == sum(before)
        assert r["total"] == len([1 for _, _, v in group if v is not None])


def test_hot_group_is_cut_into_many_even_chunks(wide):
    df = wide.range(20000).select(F.lit("k").alias("k"), "id")
    groups = OrderedGroups(df, ["k"], ["id"], 100)
    sizes = [r["count"] for r in groups.df.groupBy("_rv_chunk").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 20000 / 10


def test_global_numbering_without_a_key(wide):
    df = wide.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("x"))
    rows = numbered(df, [], ["x"], hot_rows=100).result().collect()
    assert all(r._rv_index == r.x + 1 and r._rv_count == 5000 for r in rows) and len(rows) == 5000


def test_null_keys_and_order_ties_on_hot_path(wide):
    rows = [(None if i % 2 else "x", i % 10, i) for i in range(500)]
    df = wide.createDataFrame(rows, "k string, o int, id int")
    out = numbered(df, ["k"], ["o", "id"], hot_rows=20).result().collect()
    for k in (None, "x"):
        mine = sorted((r.o, r.id, r._rv_index) for r in out if r.k == k)
        assert [m[2] for m in mine] == list(range(1, 251))


def test_unknown_gate_operations_fail_and_change_nothing(spark):
    from pyspark.sql import functions as F

    from rivulet.operators.state import hold_release

    df = spark.createDataFrame([(1, "hold"), (2, "hodl"), (3, None), (4, "release")], "ord int, op string").withColumn("k", F.lit("a"))
    done = hold_release(df, F.lit("t"), F.col("k"), F.col("op"), ["ord"])
    assert [r.route for r in done.rows.orderBy("ord").collect()] == ["success", "failure", "failure", "success"]


def test_rows_that_failed_before_leave_the_state_alone(spark):
    from rivulet.operators import assign_sequence, check_state, hold_release

    rows = [(1, "k", "hold", "9", "failure", "bad"), (2, "k", "hold", "3", "success", None), (3, "k", "hold", "5", None, None),
            (4, "k", "release", "1", "failure", "bad"), (5, "k", "release", "4", "success", None), (6, "z", "hold", "1", "failure", "bad")]
    df = spark.createDataFrame(rows, "ord int, k string, op string, v string, route string, failure_reason string")
    gate = hold_release(df, F.lit("t"), "k", "op", ["ord"])
    assert {r.ord: r.route for r in gate.rows.collect()} == {1: "failure", 2: "success", 3: "busy", 4: "failure", 5: "success", 6: "failure"}
    for hot_rows in (1_000_000, 1):
        checked = check_state(df, "k", "v", ["ord"], prev_col="prev", hot_rows=hot_rows)
        assert {r.ord: (r.route, r.prev) for r in checked.rows.collect()} == {
            1: ("failure", None), 2: ("initial", None), 3: ("greater", "3"), 4: ("failure", None), 5: ("less", "5"), 6: ("failure", None)
        }
        assert {r.key: r.value for r in checked.state.collect()} == {"k": "5"}
        counters = spark.createDataFrame([("k", 10)], "sequence string, current long")
        for given, first in ((None, 1), (counters, 11)):
            numbered = assign_sequence(df, "k", given, ["ord"], hot_rows=hot_rows)
            assert {r.ord: (r.route, r.sequence_value) for r in numbered.rows.collect()} == {
                1: ("failure", None), 2: ("success", first), 3: ("success", first + 1), 4: ("failure", None),
                5: ("success", first + 2), 6: ("failure", None),
            }
            assert {r.sequence: r.current for r in numbered.state.collect()} == {"k": first + 2}
