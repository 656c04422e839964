import json

import pytest

from rivulet.operators import (
    attributes_to_json,
    columns_to_json,
    content_to_column,
    json_to_columns,
    json_to_csv,
    positional_rename,
    promote,
    route_counts,
    split_routes,
    update_columns,
)


def contents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, content string")


def test_content_to_column_keeps_content_and_applies_expression(spark):
    row = content_to_column(contents(spark, "Hi there"), "body", "upper(body)").first()
    assert (row.content, row.body, row.route) == ("Hi there", "HI THERE", "success")


def test_update_columns_literal_and_evaluated(spark):
    df = spark.createDataFrame([("x", "7")], "content string, a string")
    plain = update_columns(df, "n=${a}", {"b": "${a}!"}).first()
    assert (plain.content, plain.b) == ("n=${a}", "${a}!")
    done = update_columns(df, "n=${a}", {"b": "${a}!", "c": "${b}${b}"}, eval_content=True, eval_columns=True).first()
    assert (done.content, done.b, done.c) == ("n=7", "7!", "7!7!")
    assert update_columns(df, "n=${nope}", eval_content=True).first().content == "n="


def test_update_columns_recursive_reaches_fixed_point_or_fails(spark):
    df = spark.createDataFrame([("x", "${b}", "${c}", "end"), ("x", "${b}+", "${a}", "end")], "content string, a string, b string, c string")
    rows = update_columns(df, "${a}", eval_content=True, recursive=True).collect()
    assert (rows[0].content, rows[0].route) == ("end", "success")
    assert rows[1].route == "failure" and "rounds" in rows[1].failure_reason and rows[1].content == "x"


def test_update_columns_recursive_reaches_any_depth(spark):
    names = [f"h{i}" for i in range(12)]
    chain = ["end", *[f"${{h{i - 1}}}" for i in range(1, 12)]]
    df = spark.createDataFrame([("x", *chain), (None, "${h11}${h11}", *chain[1:]), ("x", None, *chain[1:])], f"content string, {' string, '.join(names)} string")
    rows = update_columns(df, "<${h11}>", {"new": "${h3}"}, eval_content=True, eval_columns=True, recursive=True).collect()
    assert [(r.content, r.new, r.route) for r in rows] == [("<end>", "end", "success"), (None, None, "failure"), ("<>", "", "success")]
    nested = spark.createDataFrame([("x", "b", "${${a}}", "end")], "content string, a string, c string, b string")
    assert update_columns(nested, "${c}", eval_content=True, recursive=True).first().content == "end"


def test_columns_to_json_prefix_regex_list_and_constants(spark):
    df = spark.createDataFrame([("1", "2", "3", "4")], "`in.z` string, a string, q1 string, q2 string")
    row = columns_to_json(
        df, prefix="in.", regex="q[0-9]", names="a,gone", constants_={"k": "v-${a}", "q2": "over"}
    ).first()
    assert row.content == '{"a":"2","gone":null,"k":"v-2","q1":"3","q2":"over","z":"1"}'
    assert columns_to_json(df, prefix="in.", strip_prefix=False).first().content == '{"in.z":"1"}'


def test_attributes_to_json_matches_column_form(spark):
    df = spark.createDataFrame([({"in.z": "1", "a": "2", "q1": "3"},)], "attributes map<string,string>")
    row = attributes_to_json(df, prefix="in.", regex="q[0-9]", names=["a", "gone"], constants_={"k": "${a}"}).first()
    assert row.content == '{"a":"2","gone":null,"k":"2","q1":"3","z":"1"}'


def test_json_to_columns_object_array_and_failures(spark):
    df = contents(
        spark,
        "{a: 1, 'b': \"x\", n: null, o: {c: 1}, l: [1]}",
        '[{"a": "p"}, 3, "s", {"b": true}]',
        "[]",
        '{"a":',
        "17",
    )
    rows = json_to_columns(df, prefix="t.").collect()
    by = lambda i, route: [r for r in rows if r.id == i and r.route == route]
    assert by(0, "success")[0].attributes == {"t.a": "1", "t.b": "x", "t.n": ""}
    assert by(0, "original")[0].content.startswith("{a: 1")
    first, second = sorted(by(1, "success"), key=lambda r: r.fragment_index)
    assert first.attributes == {"t.a": "p"} and second.attributes == {"t.b": "true"}
    assert (first.fragment_index, second.fragment_index, first.fragment_count) == (1, 2, 2)
    assert first.fragment_identifier == second.fragment_identifier and first.fragment_size == "0"
    assert first.content is None
    assert not by(2, "success") and len(by(2, "original")) == 1
    assert "not valid" in by(3, "failure")[0].failure_reason
    assert "not an array or an object" in by(4, "failure")[0].failure_reason


def test_json_to_columns_rename_always_add_and_nulls(spark):
    df = contents(spark, '{"a": 1, "b": null, "c": 2}')
    names = {"a": "x", "z": "y"}
    row = json_to_columns(df, rename=names, prefix="p_", emit_original=False).first()
    assert row.attributes == {"p_x": "1", "p_y": "", "p_b": "", "p_c": "2"}
    row = json_to_columns(df, rename=names, add_nulls=False, emit_original=False).first()
    assert row.attributes == {"x": "1", "c": "2"}
    row = json_to_columns(df, rename=names, always_add=False, emit_original=False).first()
    assert row.attributes == {"x": "1", "b": "", "c": "2"}


@pytest.mark.parametrize("mode, on_object, on_array", [("always", 1, 1), ("never", None, None), ("arrays", None, 1)])
def test_json_to_columns_fragment_modes(spark, mode, on_object, on_array):
    rows = json_to_columns(contents(spark, '{"a":1}', '[{"a":1}]'), fragments=mode, emit_original=False).collect()
    got = {r.id: r.fragment_index for r in rows}
    assert got == {0: on_object, 1: on_array}


def test_json_to_columns_typed_fields(spark):
    df = contents(spark, '[{"a": 5, "b.c": "x", "n": {"q": 1}}, {"a": 6, "b.c": null}]')
    out = json_to_columns(df, fields={"a": "bigint", "b.c": "string", "n": "string"}, rename={"a": "num"}, emit_original=False)
    rows = sorted(out.collect(), key=lambda r: r.num)
    assert [(r.num, r["b.c"], r.n) for r in rows] == [(5, "x", None), (6, "", None)]


def test_positional_rename_lists(spark):
    assert positional_rename("a,b,c", "x,y") == ({"a": "x", "b": "y"}, ["x", "y"])
    rename, added = positional_rename("a|a", "x|y|z", "|")
    assert rename == {"a": "x"}
    row = json_to_columns(contents(spark, '{"a": 1, "q": 2}'), rename=rename, always_add=added, emit_original=False).first()
    assert row.attributes == {"x": "1", "y": "", "z": "", "q": "2"}


def test_json_to_columns_last_of_repeated_keys_wins(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    row = json_to_columns(contents(spark, '{"a": 1, "b": 2, "a": 3}'), rename={"b": "a"}, emit_original=False).first()
    assert row.attributes == {"a": "2"}
    row = json_to_columns(contents(spark, '{"a": 1, "a": 3}'), emit_original=False).first()
    assert row.attributes == {"a": "3"}


def test_promote(spark):
    df = json_to_columns(contents(spark, '{"a":1}'), emit_original=False)
    row = promote(df, ["a", "b"]).first()
    assert (row.a, row.b) == ("1", None)


def test_json_to_csv_shapes(spark):
    fields = '{"fields":[{"name":"a"},{"name":"b"}]}'
    df = contents(
        spark,
        json.dumps([json.dumps({"a": 1, "b": 'say "hi"'})]),
        '[{"b": "x", "a": null}, {"a": 2}]',
        '{"a": 3, "b": "y", "c": 9}',
        "[]",
        "[5]",
        "{broken",
        "12",
    )
    rows = {r.id: r for r in json_to_csv(df, fields).collect()}
    assert rows[0].content == '"a","b"\n"1","say ""hi"""'
    assert rows[1].content == '"a","b"\n"","x"\n"2",""'
    assert rows[2].content == '"a","b"\n"3","y"'
    assert (rows[3].content, rows[3].route) == ("", "success")
    assert rows[4].route == "failure" and "objects" in rows[4].failure_reason and rows[4].content == "[5]"
    assert rows[5].route == "failure" and rows[5].content == "{broken"
    assert rows[6].content == '"a","b"'
    plain = json_to_csv(df.filter("id = 0"), ["b", "a"], delimiter="|", header=False, quoted=False).first()
    assert plain.content == 'say "hi"|1'


def test_routes_split_and_count(spark):
    out = json_to_columns(contents(spark, '{"a":1}', "3"))
    parts = split_routes(out, ["success", "original", "failure"])
    assert {k: v.count() for k, v in parts.items()} == {"success": 1, "original": 1, "failure": 1}
    assert {r.route: r.records for r in route_counts(out).collect()} == {"success": 1, "original": 1, "failure": 1}


def test_stateless_operators_accept_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    contents(spark, '{"a":1}', "[]").write.parquet(src)
    stream = spark.readStream.schema("id int, content string").parquet(src)
    out = columns_to_json(promote(json_to_columns(stream), ["a"]), names=["a"])
    query = out.writeStream.format("memory").queryName("shape_stream").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("shape_stream").filter("route = 'success'").count() == 3


def test_json_to_csv_keeps_all_digits(spark):
    df = contents(spark, '{"a": 12345678901234567.89, "b": {"k": "v"}}')
    assert json_to_csv(df, ["a", "b"], header=False, quoted=False).first().content == '12345678901234567.89,{"k":"v"}'


def test_text_after_the_document_fails(spark):
    texts = ['{"a":1}', ' {"a":1} // end', '{"a":1} junk', '{"a":1}{"b":2}', '{"a":1},{"b":2}', "", None, '[{"a":1}]', '[{"a":1}] x']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, content string")
    flat = json_to_columns(df, fields={"a": "int"}, fragments="never", emit_original=False)
    assert {(r.n, r.a, r.route) for r in flat.collect()} == {(i, 1 if i in (0, 1, 7) else None, "success" if i in (0, 1, 7) else "failure") for i in range(9)}
    csv = {r.n: (r.route, r.content) for r in json_to_csv(df, ["a"], header=False).collect()}
    assert {n: c for n, (route, c) in csv.items() if route == "success"} == {0: '"1"', 1: '"1"', 7: '"1"'}
    held = spark.createDataFrame([('["{\\"a\\":1} junk"]',)], "content string")
    assert json_to_csv(held, ["a"]).first().route == "failure"
