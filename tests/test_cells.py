import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import (
    kt_check_and_put, kt_contains, kt_get, kt_get_and_put_if_absent, kt_get_by_filter, kt_last_cell_by_filter,
    kt_put, kt_put_if_absent, kt_remove, kt_remove_all, scan_cells,
)

CELLS = [("r1", "f", "a", "1"), ("r1", "f", "b", "2"), ("r1", "g", "a", "3"), ("r2", "f", "a", "4"), ("r3", "f", "b", "5")]


@pytest.fixture()
def cells(spark):
    return spark.createDataFrame(CELLS, "row_key string, family string, qualifier string, value string")


def as_set(df):
    return {tuple(r) for r in df.select("row_key", "family", "qualifier", "value").collect()}


@pytest.mark.parametrize(
    "fmt, expected",
    [
        ("qualifier", {"a": "3", "b": "2"}),
        ("family.qualifier", {"f.a": "1", "f.b": "2", "g.a": "3"}),
        ("tablename.qualifier", {"t.a": "3", "t.b": "2"}),
        ("tablename.family.qualifier", {"t.f.a": "1", "t.f.b": "2", "t.g.a": "3"}),
    ],
)
def test_scan_formats(cells, fmt, expected):
    rows = sorted(scan_cells(cells, name_format=fmt, table_name="t").collect(), key=lambda r: r.fragment_index)
    assert [r.row_key for r in rows] == ["r1", "r2", "r3"] and rows[0].attributes == expected
    assert {r.fragment_count for r in rows} == {3} and len({r.fragment_identifier for r in rows}) == 1
    wide = scan_cells(cells, name_format=fmt, table_name="t", names=list(expected)).filter("row_key = 'r1'").first()
    assert {n: wide[n] for n in expected} == expected


def test_scan_filters_row_key_name_and_parent(cells):
    out = scan_cells(cells, row_filter=F.col("row_key") < "r3", row_key_name="id", parent={"asked_by": "me"})
    assert {(r.id, r.asked_by, r.fragment_count) for r in out.collect()} == {("r1", "me", 2), ("r2", "me", 2)}
    assert scan_cells(cells, cell_filter=F.col("family") == "g").first().attributes == {"a": "3"}
    hit = scan_cells(cells, having=(F.col("qualifier") == "a") & (F.col("value") == "4")).collect()
    assert [(r.row_key, r.attributes) for r in hit] == [("r2", {"a": "4"})]


def test_scan_numbering_split_into_chunks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    big = spark.range(2000).select(F.format_string("%05d", "id").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"), F.col("id").cast("string").alias("value"))
    rows = scan_cells(big, names=["q"], hot_rows=50).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert all(r.fragment_index == int(r.row_key) + 1 for r in rows) and len(rows) == 2000


def test_get_and_contains(spark, cells):
    keys = spark.createDataFrame([("r1",), ("r3",), ("r9",)], "k string")
    assert {(r.k, r.v) for r in kt_get(keys, cells, "f", "a", "k", "v").collect()} == {("r1", "1"), ("r3", None), ("r9", None)}
    assert {(r.k, r.present) for r in kt_contains(keys, cells, "k").collect()} == {("r1", True), ("r3", True), ("r9", False)}


def test_put_and_if_absent(spark, cells):
    new = spark.createDataFrame(
        [("r1", "f", "a", "9", 1), ("r1", "f", "a", "8", 2), ("r4", "f", "a", "7", 1), ("r4", "f", "a", "6", 2)],
        "row_key string, family string, qualifier string, value string, ord int",
    )
    assert as_set(kt_put(cells, new, ["ord"])) == (set(CELLS) - {CELLS[0]}) | {("r1", "f", "a", "8"), ("r4", "f", "a", "6")}
    change = kt_put_if_absent(cells, new, ["ord"])
    assert as_set(change.cells) == set(CELLS) | {("r4", "f", "a", "7")}
    assert {(r.row_key, r.value, r.inserted) for r in change.results.collect()} == {
        ("r1", "9", False), ("r1", "8", False), ("r4", "7", True), ("r4", "6", False)}
    change = kt_get_and_put_if_absent(cells, new, ["ord"])
    assert {(r.row_key, r.value, r.old_value) for r in change.results.collect()} == {
        ("r1", "9", "1"), ("r1", "8", "1"), ("r4", "7", None), ("r4", "6", "7")}


def test_check_and_put(spark, cells):
    req = spark.createDataFrame(
        [("r1", "f", "a", "9", "1", 1), ("r1", "f", "a", "8", "9", 2), ("r2", "f", "a", "9", "0", 1), ("r7", "f", "a", "n", None, 1), (None, "f", "a", "z", None, 1)],
        "row_key string, family string, qualifier string, value string, expected string, ord int",
    )
    change = kt_check_and_put(cells, req, ["ord"])
    assert {(r.row_key, r.value, r.outcome) for r in change.results.collect()} == {
        ("r1", "9", "put"), ("r1", "8", "put"), ("r2", "9", "refused"), ("r7", "n", "put"), (None, "z", "refused")}
    assert as_set(change.cells) == (set(CELLS) - {CELLS[0]}) | {("r1", "f", "a", "8"), ("r7", "f", "a", "n")}


@pytest.mark.parametrize("hot_rows", [20, 1_000_000])
def test_check_and_put_decides_every_request_in_order(spark, cells, hot_rows):
    rng = random.Random(3)
    states = [None, "1", "2", "3", "4"]
    asked = [
        ("r1" if rng.random() < 0.6 else f"r{rng.randrange(2, 6)}", "f", "a", rng.choice(states[1:]), rng.choice(states), i)
        for i in range(600)
    ]
    # a counter: each request expects what the one before it left
    asked += [("count", "f", "n", str(i + 1), str(i) if i else None, i) for i in range(300)]
    now, expected = {c[:3]: c[3] for c in CELLS}, {}
    for row, family, name, value, wanted, i in sorted(asked, key=lambda r: r[5]):
        put = now.get((row, family, name)) == wanted
        if put:
            now[row, family, name] = value
        expected[row, i] = "put" if put else "refused"
    frame = spark.createDataFrame(asked, "row_key string, family string, qualifier string, value string, expected string, ord int")
    change = kt_check_and_put(cells, frame.repartition(7), ["ord"], hot_rows)
    assert {(r.row_key, r.ord): r.outcome for r in change.results.collect()} == expected
    assert as_set(change.cells) == {(*k, v) for k, v in now.items()}
    assert kt_check_and_put(cells, frame.limit(0), ["ord"]).results.count() == 0


def test_by_filter(cells):
    one = F.col("value") == "4"
    assert kt_get_by_filter(cells, one, "f", "a").first()["value"] == "4"
    assert kt_last_cell_by_filter(cells, F.col("value") == "1").first()["value"] == "3"
    none = kt_get_by_filter(cells, F.col("value") == "zz", "f", "a").first()
    assert (none["value"], none.route) == (None, "success")
    many = kt_last_cell_by_filter(cells, F.col("qualifier") == "b").first()
    assert many.route == "failure" and many["value"] is None


def test_remove(spark, cells):
    keys = spark.createDataFrame([("r1",), ("r9",)], "row_key string")
    change = kt_remove(cells, keys)
    assert as_set(change.cells) == set(CELLS[3:])
    assert {(r.row_key, r.existed) for r in change.results.collect()} == {("r1", True), ("r9", False)}
    assert kt_remove_all(cells).count() == 0


def test_scans_per_record_equal_a_plain_version(spark):
    import random

    from rivulet.operators import scan_cells_per_record

    rng = random.Random(5)
    keys = ["".join(rng.choice("abé𝄞 ") for _ in range(rng.randint(0, 4))) for _ in range(150)]
    cells = [(k, "f", q, f"{k}/{q}") for k in set(keys) for q in ("x", "y")[: 1 + len(k) % 2]]
    table = spark.createDataFrame(cells, "row_key string, family string, qualifier string, value string")
    asks = [(i, rng.choice([*keys, None]), rng.choice([*keys, None]), "clash") for i in range(60)] + [(99, "", None, "clash")] * 2
    records = spark.createDataFrame(asks, "id int, a string, b string, attributes_ string")
    byte = str.encode
    for parts, hot_rows in ((1, 10**6), (7, 10**6), (64, 5)):
        got = scan_cells_per_record(records, table, prefix="a", parts=parts, hot_rows=hot_rows).collect()
        want = [(i, k) for i, a, _, _ in asks if a is not None for k in set(keys) if k.startswith(a)]
        assert sorted((r.id, r.row_key) for r in got if r.route == "success") == sorted(want)
        assert sorted(r.id for r in got if r.route == "failure") == sorted(i for i, a, _, _ in asks if a is None)
        assert all(r["scan.failure.reason"] == r.failure_reason for r in got)
        by_record = {}
        for r in got:
            if r.route == "success":
                assert r.attributes == {q: v for k, _, q, v in cells if k == r.row_key}
                by_record.setdefault(r.fragment_identifier, []).append(r)
        for rows in by_record.values():
            rows.sort(key=lambda r: r.fragment_index)
            assert [r.fragment_index for r in rows] == list(range(1, len(rows) + 1)) and {r.fragment_count for r in rows} == {len(rows)}
            assert [r.row_key for r in rows] == sorted((r.row_key for r in rows), key=byte)
        got = scan_cells_per_record(records, table, lower="a", upper="b", parts=parts, hot_rows=hot_rows).collect()
        crossed = [i for i, a, b, _ in asks if a is not None and b is not None and byte(a) > byte(b)]
        want = [
            (i, k) for i, a, b, _ in asks if i not in crossed for k in set(keys)
            if (a is None or byte(k) >= byte(a)) and (b is None or byte(k) < byte(b))
        ]
        assert sorted((r.id, r.row_key) for r in got if r.route == "success") == sorted(want)
        assert sorted(r.id for r in got if r.route == "failure") == sorted(crossed)
    templated = scan_cells_per_record(records.filter("id = 1"), table, prefix="${a}", cell_filter=table["qualifier"] == "x").collect()
    assert {r.row_key for r in templated} == {k for k in keys if k.startswith(asks[1][1] or "")}
    assert not scan_cells_per_record(records, table.limit(0), prefix="a").filter("route = 'success'").collect()


def test_scans_per_record_store_no_matches(spark):
    import os

    from rivulet.operators import scan_cells_per_record
    from rivulet.session import shared_folder

    cells = spark.range(2000).selectExpr("cast(id as string) row_key", "'f' family", "'q' qualifier", "'v' value")
    records = spark.range(100).selectExpr("id", "cast(null as string) hi", "'1' lo")
    folder = os.path.join(shared_folder(spark), "rivulet")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    found = scan_cells_per_record(records, cells, lower="lo", upper="hi", hot_rows=50)
    assert found.count() == 100 * 1999 == found.filter("fragment_count = 1999 and fragment_index between 1 and 1999").count()
    stored = sum(spark.read.parquet(os.path.join(folder, f)).count() for f in set(os.listdir(folder)) - before)
    assert stored <= 3 * (2000 + 100)
