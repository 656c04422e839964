import json
import random

from rivulet.operators import apply_changes, changes_to_sql, merge_change_images, settle_changes


def change(op, before=None, after=None, table="app.Items", keys=("ID", "K2"), pos="1", **more):
    doc = {"table": table, "op_type": op, "op_ts": "t1", "pos": pos, "primary_keys": list(keys)}
    if before is not None:
        doc["before"] = before
    if after is not None:
        doc["after"] = after
    doc.update(more)
    return json.dumps(doc)


def contents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, content string")


BEFORE = {"ID": 1, "K2": "x", "NAME": "old", "NOTE": "keep"}
AFTER = {"ID": 1, "K2": "x", "NAME": "it's", "GONE": None}


def test_merge_overlays_after_on_before(spark):
    df = contents(spark, change("U", BEFORE, AFTER), change("T"), "{bad", change("D", BEFORE))
    out = merge_change_images(df, "lower", "tgt", "table, op_type", constants={"My_Const": "v${id}"})
    rows = {r.id: r for r in out.collect()}
    # " op_type" with its blank matches nothing.
    assert rows[0].content == '{"My_Const":"v0","gone":null,"id":1,"k2":"x","name":"it\'s","note":"keep","table":"tgt.items"}'
    assert rows[1].route == "unsupported op_type" and rows[1].content == change("T")
    assert rows[2].route == "failure"
    assert json.loads(rows[3].content)["name"] == "old"
    trimmed = merge_change_images(df, header_fields="table, op_type", trim=True, into="merged").first()
    assert json.loads(trimmed.merged)["op_type"] == "U" and trimmed.content == change("U", BEFORE, AFTER)


def test_merge_schema_override_and_values_keep_types(spark):
    df = contents(spark, change("I", None, {"A": 1.5, "B": True, "C": [1]}, table="Plain"))
    assert merge_change_images(df, target_schema="s", header_fields=["table"]).first().content == '{"A":1.5,"B":true,"C":[1],"table":"s.Plain"}'
    df = contents(spark, change("I", None, {"a": 1, "A": 2}))
    assert merge_change_images(df, "upper", "", header_fields=["table", "before"]).first().content == '{"A":2,"TABLE":"ITEMS"}'


def test_sql_text_of_each_kind(spark):
    df = contents(
        spark,
        change("I", None, AFTER),
        change("U", BEFORE, AFTER),
        change("D", {"ID": 1, "K2": None}),
        change("T", {}, {}),
        change("U", BEFORE, {"ID": 1, "K2": "x"}),
        change("U", BEFORE, AFTER, keys=()),
        change("U", None, AFTER),
        "nonsense",
    )
    rows = {r.id: r for r in changes_to_sql(df, "lower", "tgt").collect()}
    assert rows[0].content == "INSERT INTO tgt.items (id, k2, name, gone) VALUES ('1', 'x', 'it''s', null)"
    assert rows[1].content == "UPDATE tgt.items SET name = 'it''s', gone = null WHERE id = '1' AND k2 = 'x'"
    assert rows[2].content == "DELETE FROM tgt.items WHERE id = '1' AND k2 IS null"
    assert [rows[i].route for i in range(8)] == [
        "success", "success", "success", "unsupported op_type", "skipped", "failure", "failure", "failure"]
    assert "primary key" in rows[5].failure_reason and "before" in rows[6].failure_reason


def test_sql_options(spark):
    df = contents(spark, change("U", BEFORE, AFTER))
    row = changes_to_sql(df, semicolon=True, into="dml", key_columns="ID", column_map={"Items.NAME": "title"}).first()
    assert row.dml == "UPDATE app.Items SET K2 = 'x', title = 'it''s', GONE = null WHERE ID = '1';"
    assert row.content == change("U", BEFORE, AFTER)
    bare = changes_to_sql(contents(spark, change("D", BEFORE, keys=["ID"])), target_schema="").first()
    assert bare.content == "DELETE FROM Items WHERE ID = '1'"


def test_apply_changes(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "id long, name string, qty int")
    changes = contents(
        spark,
        change("U", {"id": 1}, {"id": 1, "name": "A"}, pos="01"),
        change("U", {"id": 1}, {"id": 1, "qty": None}, pos="02"),
        change("D", {"id": 2}, pos="03"),
        change("I", None, {"id": 4, "name": "d", "qty": 40}, pos="04"),
        change("U", {"id": 4}, {"id": 4, "qty": 41}, pos="05"),
        change("D", {"id": 3}, pos="06"),
        change("I", None, {"id": 3, "name": "again"}, pos="07"),
        change("T", {"id": 1}, {"id": 1}, pos="08"),
    )
    rows = {tuple(r) for r in apply_changes(target, changes, ["id"]).collect()}
    assert rows == {(1, "A", None), (4, "d", 41), (3, "again", None)}


def test_apply_changes_of_a_real_trail(spark):
    target = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, n int")
    record = lambda op, pos, before=None, after=None, table="s.t": (json.dumps(
        {"table": table, "op_type": op, "pos": pos, "primary_keys": ["id"], "before": before, "after": after}
    ),)
    changes = spark.createDataFrame([
        record("U", "01", {"id": 1}, {"id": 1, "n": 99}, "s.other"),
        record("D", "02", {"id": 2}), record("U", "03", {"id": 2}, {"id": 2, "n": 21}),
        record("U", "04", {"id": 3}, {"id": 3, "n": "abc"}),
        record("U", "05", {"id": 7}, {"id": 7, "n": 70}),
        record("I", "06", None, {"n": 5}),
        record("I", "07", None, {"id": 8, "n": 80}),
        ("not json",),
    ], "content string")
    rows = {tuple(r) for r in apply_changes(target, changes, ["id"], table="s.t").collect()}
    assert rows == {(1, 10), (3, 30), (8, 80)}


def test_numbers_keep_all_digits(spark):
    text = '{"table":"t","op_type":"I","pos":"1","primary_keys":["id"],"after":{"id":1,"p":12345678901234567.89,"o":{"k":[1]}}}'
    df = contents(spark, text)
    assert changes_to_sql(df).first().content == (
        "INSERT INTO t (id, p, o) VALUES ('1', '12345678901234567.89', '{\"k\":[1]}')"
    )
    target = spark.createDataFrame([], "id int, p decimal(20,2)")
    assert str(apply_changes(target, df, ["id"]).first().p) == "12345678901234567.89"


def test_records_are_parsed_once_and_whole(spark):
    good = '{"table":"s.t","op_type":"I","pos":"1","after":{"id":1}}'
    df = spark.createDataFrame([(1, good), (2, good + " junk"), (3, good + good), (4, good + "," + good), (5, ""), (6, None)], "n int, content string")
    for out in (merge_change_images(df), changes_to_sql(df)):
        kept = out.filter("route = 'success'")
        assert [r.n for r in kept.collect()] == [1] and out.filter("route = 'failure'").count() == 5
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1
    target = spark.createDataFrame([], "id long")
    assert [tuple(r) for r in apply_changes(target, df, ["id"]).collect()] == [(1,)]


def settled(target, changes, table=None):
    """Row by row: the table after the changes, and the outcome of each."""
    rows, outcomes = {r["id"]: dict(r) for r in target}, {}
    decided = []
    for at, text in changes:
        try:
            c = json.loads(text)
            c = c if isinstance(c, dict) else None
        except ValueError:
            c = None
        decided.append((at, text, c))
    for at, text, c in sorted(decided, key=lambda x: ((x[2] or {}).get("pos") or "", x[1])):
        op = (c or {}).get("op_type")
        image = (c or {}).get("after") if op == "I" else (c or {}).get("before")
        image = image if image is not None else (c or {}).get("after")
        key = (image or {}).get("id")
        key = int(key) if str(key).isdigit() else None
        if c is None or op not in ("I", "U", "D") or (table and c.get("table") != table) or key is None or c.get("pos") is None:
            outcomes[at] = "rejected"
            continue
        after = c.get("after")
        if op != "D" and after is None or op == "U" and not {"name", "n"} & set(after):
            outcomes[at] = "rejected"
            continue
        if op != "I" and key not in rows:
            outcomes[at] = "rejected"
            continue
        if op == "D":
            del rows[key]
            outcomes[at] = "applied"
            continue
        row = {"id": key, "name": None, "n": None} if op == "I" else dict(rows[key])
        fine = True
        for name in ("name", "n"):
            if name in after:
                if name == "n" and after[name] is not None and not str(after[name]).lstrip("-").isdigit():
                    fine = False
                else:
                    row[name] = after[name]
        rows[key] = row
        outcomes[at] = "applied" if fine else "partly"
    return rows, outcomes


def test_every_change_has_an_outcome(spark):
    rng = random.Random(6)
    target = [{"id": i, "name": f"t{i}", "n": i} for i in range(8)]
    changes = []
    for at in range(400):
        op = rng.choice("IUUUDDX") if at % 19 else None
        key = rng.choice([0, 1, 2, 3, 3, 3, 3, 9, 10, "x", None])
        doc = {"table": rng.choice(["a", "a", "a", "b"]), "op_type": op, "pos": f"{at:05d}" if at % 23 else None, "before": {"id": key}}
        if op != "D":
            doc["after"] = {"id": key, **rng.choice([{"name": f"v{at}"}, {"n": at}, {"n": "bad", "name": None}, {}])}
        if at % 31 == 0:
            del doc["before"]
            doc.pop("after", None)
        changes.append((at, json.dumps(doc) + ("" if at % 29 else "}")))
    df = spark.createDataFrame(changes, "at int, content string").repartition(3)
    base = spark.createDataFrame([(r["id"], r["name"], r["n"]) for r in target], "id long, name string, n long")
    for table in (None, "a"):
        rows, outcomes = settled(target, changes, table)
        for hot_rows in (1_000_000, 1):
            done = settle_changes(base, df, ["id"], table=table, hot_rows=hot_rows)
            got = done.outcomes.collect()
            assert len(got) == len(changes)
            assert {r["at"]: r["outcome"] for r in got} == outcomes
            assert all((r["failure_reason"] is None) == (r["outcome"] == "applied") for r in got)
            assert {r["id"]: r.asDict() for r in done.target.collect()} == rows
        assert done.rejected.count() == sum(o != "applied" for o in outcomes.values())


def test_reasons_of_changes_that_do_not_apply(spark):
    texts = [
        "no record", change("T"), change("U", {"ID": 5}, {"NAME": "x"}), change("D", {"K2": "x"}),
        change("I", None, {"ID": 6, "N": "many", "NAME": "kept"}), change("U", {"ID": 6}, {"ID": 6}), change("U", {"ID": 6}),
    ]
    base = spark.createDataFrame([], "ID int, NAME string, N int")
    done = settle_changes(base, contents(spark, *texts), ["ID"])
    assert {r.id: r.failure_reason for r in done.outcomes.collect()} == {
        0: "the text is not a change record", 1: "unsupported op_type: T", 2: "there is no such row",
        3: "the change has no key", 4: "N cannot hold 'many'", 5: "the update has nothing but its key",
        6: "the change has no after image",
    }
    assert [tuple(r) for r in done.target.collect()] == [(6, "kept", None)]
    nothing = settle_changes(base, contents(spark, "x").limit(0), ["ID"])
    assert nothing.target.count() == nothing.outcomes.count() == 0
