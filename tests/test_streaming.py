import os

import pytest
from pyspark.sql import functions as F

from rivulet.operators import apply_changes, assign_sequence, check_state, hold_release, merge_change_images, validate_xml, xml_to_columns
from rivulet.streaming import (
    StateTable, apply_per_batch, run_stateful, stream_assign_sequence, stream_check_state, stream_hold_release,
)

SCHEMA = "ord long, key string, value string, op string, dup string"


def write_batches(spark, folder, n_batches, n=240):
    rows = [(i, f"k{i * 7 % 5}", "abcde"[i * 3 % 5] if i % 11 else "", "release" if i % 4 == 3 else "hold", str(i % 2)) for i in range(n)]
    size = n // n_batches
    for b in range(n_batches):
        path = os.path.join(folder, f"part-{b}")
        spark.createDataFrame(rows[b * size:(b + 1) * size], SCHEMA).coalesce(1).write.parquet(path)
        # Files are taken oldest first.
        for name in os.listdir(path):
            os.utime(os.path.join(path, name), (1_000_000 + b, 1_000_000 + b))
    return spark.createDataFrame(rows, SCHEMA)


STEPS = {
    "check": (
        "key",
        stream_check_state("key", "value", ["ord"], replace_when="not_equal", prev_col="prev"),
        lambda df: check_state(df, "key", "value", ["ord"], "not_equal", "prev"),
        ["ord", "prev", "route"],
    ),
    "gate": (
        "key",
        stream_hold_release("key", "key", "op", ["ord"], "dup"),
        lambda df: hold_release(df, "key", "key", "op", ["ord"], "dup"),
        ["ord", "route"],
    ),
    "sequence": (
        "sequence",
        stream_assign_sequence("key", ["ord"], start=10, increment=3),
        lambda df: assign_sequence(df, "key", None, ["ord"], 10, 3),
        ["ord", "sequence_value"],
    ),
}


@pytest.mark.parametrize("name", list(STEPS))
def test_stream_in_many_batches_equals_one_batch(spark, tmp_path, name):
    key, step, batch, columns = STEPS[name]
    folder = str(tmp_path / "in")
    everything = write_batches(spark, folder, 6)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder + "/*")
    state = StateTable(spark, str(tmp_path / "state"), key, compact_every=3)
    run_stateful(stream, step, state, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.select("batch").distinct().count() == 6
    expected = batch(everything)
    assert sorted(map(str, out.select(*columns).collect())) == sorted(map(str, expected.rows.select(*columns).collect()))
    names = sorted(os.listdir(tmp_path / "state"))
    assert [n.split("-")[0] for n in names].count("full") == 2
    left = {tuple(r) for r in state.read(99).collect()}
    assert left == {tuple(r) for r in expected.state.drop("updated").collect()}


def test_replayed_batch_finds_the_same_state(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "ord long, key string")
    state = StateTable(spark, str(tmp_path / "s"), "sequence")
    step = stream_assign_sequence("key", ["ord"])
    for _ in range(2):
        result = step(df, state.read(0))
        assert sorted(r.sequence_value for r in result.rows.collect()) == [1, 2]
        state.write(0, result.state)
    result = step(df, state.read(1))
    assert sorted(r.sequence_value for r in result.rows.collect()) == [3, 4]
    # An unfinished version (no success marker) is not read.
    os.makedirs(tmp_path / "s" / "delta-000000000001")
    assert {tuple(r) for r in state.read(5).collect()} == {("a", 2)}


def test_a_batch_reads_the_state_of_its_keys_only(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "s"), "sequence", compact_every=2, buckets=16)
    step = stream_assign_sequence("key", ["ord"])
    many = spark.range(500).selectExpr("id as ord", "concat('k', id) as key")
    few = spark.createDataFrame([(1, "k7"), (2, "new"), (3, None), (4, "k7")], "ord long, key string")
    for n, batch in enumerate([many, few, few]):
        state.remove_superseded(n)
        before = state.read(n, batch.select(step.key().alias("sequence")))
        if n == 1:
            assert before.collect() == [("k7", 1)]
        elif n == 2:
            assert {tuple(r) for r in before.collect()} == {("k7", 3), ("new", 1), (None, 1)}
        state.write(n, step(batch, before).state)
    # the full version of batch 1 covers the two deltas before it, which went when batch 2 began
    assert sorted(os.listdir(tmp_path / "s")) == ["delta-000000000002", "full-000000000001"]
    everything = {r.sequence: r.current for r in state.read(3).collect()}
    assert len(everything) == 502 and (everything["k7"], everything["new"], everything[None], everything["k8"]) == (5, 2, 2, 1)


def test_sink_per_batch_applies_changes(spark, tmp_path):
    src, table = str(tmp_path / "in"), str(tmp_path / "table")
    text = '{"table":"s.t","op_type":"U","pos":"%02d","before":{"id":1},"after":{"id":1,"n":"%s"}}'
    spark.createDataFrame([(text % (1, "x"),), (text % (2, "y"),)], "content string").write.parquet(src)
    spark.createDataFrame([(1, "old"), (2, "keep")], "id long, n string").write.parquet(table + "/v=-1")

    def sink(batch, batch_id):
        current = spark.read.parquet(f"{table}/v={batch_id - 1}")
        apply_changes(current, batch, ["id"]).write.mode("overwrite").parquet(f"{table}/v={batch_id}")

    stream = spark.readStream.schema("content string").parquet(src)
    apply_per_batch(stream, sink, str(tmp_path / "cp")).awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(f"{table}/v=0").collect()} == {(1, "y"), (2, "keep")}


def test_stateless_change_and_xml_operators_accept_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([('{"table":"t","op_type":"I","after":{"a":1}}',), ("<r><a>1</a></r>",)], "content string").write.parquet(src)
    xsd = '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="r"><xs:complexType><xs:sequence><xs:element name="a" type="xs:int"/></xs:sequence></xs:complexType></xs:element></xs:schema>'
    stream = lambda: spark.readStream.schema("content string").parquet(src)
    for i, (out, route, n) in enumerate([
        (merge_change_images(stream()), "success", 1),
        (xml_to_columns(stream(), "/r", "record"), "success", 1),
        (validate_xml(stream(), xsd_text=xsd), "success", 1),
    ]):
        query = out.writeStream.format("memory").queryName(f"stateless_{i}").trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.table(f"stateless_{i}").filter(F.col("route") == route).count() == n
