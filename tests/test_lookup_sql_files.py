import gzip
import json

import pytest
from pyspark.sql import functions as F

from rivulet.operators import attach_lookup, enrich, enrich_each, sql_to_lookup
from rivulet.sources import ingest_files, remove_sources, run_sql_script, sql_rows, sql_scalar, stream_files, truncate_tables


def test_sql_to_lookup_last_row_wins_and_alias(spark):
    df = spark.createDataFrame([(1, "a", "x", "A"), (2, "a", "y", None), (3, "b", None, "A")], "o int, k string, v string, alias string")
    got = {r.key: r.value for r in sql_to_lookup(df, "k", "v", "alias", ["o"]).collect()}
    assert got == {"a": "y", "b": "", "A": ""}


def test_attach_lookup_never_multiplies(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,), ("",)], "k string")
    lookup = spark.createDataFrame([("1", "a"), ("1", "b"), ("", "never")], "key string, value string")
    got = sorted(((r.k, r.v) for r in attach_lookup(df, lookup, "${k}", "v").collect()), key=str)
    assert got == sorted([("1", "b"), ("2", None), (None, None), ("", None)], key=str)


CELLS = [("1", "f", "n", "one"), ("1", "g", "n", "last"), ("2", "f", "n", "two"), ("3", "f", "n", "two")]


def sources(spark):
    return {
        "cache": spark.createDataFrame([("k-1", "v1"), ("k-2", "")], "key string, value string"),
        "tables": {"t": spark.createDataFrame(CELLS, "row_key string, family string, qualifier string, value string")},
    }


def test_enrich_all_sources(spark):
    df = spark.createDataFrame([(1, "two", "body"), (2, "one", "body"), (3, "zzz", "body")], "id int, word string, content string")
    df.createOrReplaceTempView("enrich_src")
    spec = {
        "extract-to-attributes": {"out.word": "w:${word}", "nothing": None},
        "extract-to-json": {
            "plain": {"value": "${word}"},
            "num": {"value": "4${id}", "to-type": "long"},
            "none": {"value": None, "default": -1, "to-type": "int"},
            "blank": {"value": "${missing}", "default": "2.5", "to-type": "decimal"},
            "cached": {"value": "k-${id}", "type": "CACHE", "default": "dflt"},
            "cell": {"value": "${id}", "type": "HBASE", "hbase-table": "t"},
            "sql": {"type": "SQL", "value": "select word, id from enrich_src", "on": {"id": "id"}, "order-by": ["word"]},
            "one": {"type": "SQL", "value": "select max(id) from enrich_src", "to-type": "int"},
        },
    }
    rows = {r.id: r for r in enrich(df, json.dumps(spec), sources(spark)).collect()}
    assert rows[1]["out.word"] == "w:two" and rows[1].nothing is None
    assert rows[1].content == (
        '{"blank":2.5,"cached":"v1","cell":"last","none":-1,"num":41,"one":3,"plain":"two","sql":"two"}'
    )
    assert json.loads(rows[2].content)["cached"] == "dflt" and json.loads(rows[3].content)["cached"] == "dflt"


def test_enrich_failures(spark):
    df = spark.createDataFrame([(1, "two"), (2, "one"), (3, "nan?")], "id int, word string").withColumn("content", F.lit("body"))
    spec = {"extract-to-json": {"c": {"value": "${word}", "type": "HBASE_FILTER", "hbase-table": "t", "match": {"family": "f", "qualifier": "n"}, "default": "d"}}}
    rows = {r.id: r for r in enrich(df, spec, sources(spark)).collect()}
    assert rows[1].route == "failure" and "several rows" in rows[1].failure_reason and rows[1].content == "body"
    assert rows[2].content == '{"c":"last"}' and rows[3].content == '{"c":"d"}'
    bad = {r.id: r for r in enrich(df, {"extract-to-attributes": {"n": {"value": "${word}", "to-type": "int"}}}).collect()}
    assert bad[1].route == "failure" and "cannot convert 'two'" in bad[1].failure_reason and bad[1].n is None
    assert enrich(df, "{oops").first().route == "failure"
    table = {"value": "1", "type": "HBASE", "hbase-table": "t"}
    broken = {
        "hbase-table argument missing": {"value": "1", "type": "HBASE"}, "no table gone": {**table, "hbase-table": "gone"},
        "no_such_table": {"value": "select x from no_such_table where k = ${id}", "type": "SQL"},
        "no cache": {"value": "1", "type": "CACHE"}, "no column for ${nope}": {"value": "select ${nope}", "type": "SQL"},
        "cannot limit": {"value": "select '${id}' limit 1", "type": "SQL"}, "no_table_2": {"value": "select 1 from no_table_2", "type": "SQL"},
    }
    for said, entry in broken.items():
        rows = enrich(df, {"extract-to-json": {"x": entry}, "extract-to-attributes": {"y": "z"}}, {"tables": sources(spark)["tables"]}).collect()
        assert len(rows) == 3
        for r in rows:
            assert (r.route, r.content, r.y) == ("failure", "body", None) and said in r.failure_reason and "x: " in r.failure_reason


@pytest.mark.parametrize("hot_rows", [10, 10**9])
def test_sql_rows(spark, hot_rows):
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    child = [(k, i, None if i % 5 == 0 else f"t{i}") for k, n in [(1, 300), (2, 3)] for i in range(n)]
    spark.createDataFrame(child, "pk int, seq int, txt string").createOrReplaceTempView("child_rows")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "id int, who string")
    out = sql_rows(df, "select pk as `c.pk`, seq as `c.seq`, txt from child_rows", {"id": "c.pk"}, ["c.seq"], strip_qualifiers=True, hot_rows=hot_rows)
    rows = out.collect()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    for who, n in [("a", 300), ("b", 300), ("c", 3)]:
        mine = sorted((r for r in rows if r.who == who), key=lambda r: r.fragment_index)
        assert [r.fragment_index for r in mine] == list(range(1, n + 1)) and {r.fragment_count for r in mine} == {n}
        assert [r.seq for r in mine] == [str(i) for i in range(n)] and mine[0].txt == "" and mine[1].txt == "t1"
        assert len({r.fragment_identifier for r in mine}) == 1 and {r.route for r in mine} == {"success"}
    assert {(r.who, r.route) for r in rows if r.route == "empty"} == {("d", "empty"), ("e", "empty")}


def test_sql_rows_alone_and_failing(spark):
    spark.range(3).createOrReplaceTempView("three")
    out = sql_rows(None, "select id from three", order_by=["id"], spark=spark).collect()
    assert sorted((r.id, r.fragment_index, r.fragment_count) for r in out) == [("0", 1, 3), ("1", 2, 3), ("2", 3, 3)]
    df = spark.createDataFrame([(1,)], "id int")
    failed = sql_rows(df, "select nope from three", {"id": "id"}, ["id"], block_on_failure=False).first()
    assert failed.route == "failure" and "nope" in failed.failure_reason
    with pytest.raises(Exception):
        sql_rows(df, "select nope from three", {"id": "id"}, ["id"])


def test_sql_scalar(spark):
    spark.createDataFrame([(1, 5, "x"), (1, 4, None), (2, 1, "z")], "pk int, o int, v string").createOrReplaceTempView("sc")
    df = spark.createDataFrame([(1, "c"), (2, "c"), (3, "c")], "id int, content string")
    rows = {r.id: (r.content, r.route) for r in sql_scalar(df, "select v, pk, o from sc", {"id": "pk"}, ["o"]).collect()}
    assert rows == {1: ("", "success"), 2: ("z", "success"), 3: ("c", "empty")}
    one = sql_scalar(df, "select v, o from sc", order_by=["o"], into="first_v").first()
    assert (one.first_v, one.content) == ("z", "c")
    assert sql_scalar(df, "select v from sc where o > 99").first().route == "empty"
    assert sql_scalar(df, "select nope from sc", block_on_failure=False).first().route == "failure"


def test_run_sql_script(spark, tmp_path):
    text = f"create table script_t using parquet location '{tmp_path}/t' as select 1 as x;; insert into script_t values (2);select bad from script_t;drop table script_t"
    rows = run_sql_script(spark, text).collect()
    assert [(r.stmt_no, r.status) for r in rows] == [(1, "success"), (3, "success"), (4, "failure"), (5, "not run")]
    assert "bad" in rows[2].failure_reason and sorted(r.x for r in spark.table("script_t").collect()) == [1, 2]
    with pytest.raises(Exception):
        run_sql_script(spark, "select bad from script_t", raise_on_error=True)
    report = [tuple(r)[:2] for r in truncate_tables(spark, "script_t,none_such,script_t").collect()]
    assert report == [("script_t", "success"), ("none_such", "failure"), ("script_t", "not run")]
    assert spark.table("script_t").count() == 0
    spark.sql("drop table script_t")


def test_ingest_files(spark, tmp_path):
    d = tmp_path / "in dir"
    (d / "sub").mkdir(parents=True)
    (d / "a.txt").write_text("one\ntwo")
    (d / "b.log").write_text("log")
    (d / ".dot.txt").write_text("no")
    (d / "sub" / "c.txt").write_text("deep")
    with gzip.open(d / "z.txt.gz", "wt") as f:
        f.write("zipped")
    dirs = spark.createDataFrame([(1, str(d)), (2, str(tmp_path / "gone")), (3, str(d) + "/")], "id int, directory string")
    rows = ingest_files(spark, dirs).collect()
    got = {(r.id, r.filename, r.content) for r in rows if r.route == "success"}
    files = {("a.txt", "one\ntwo"), ("b.log", "log"), ("z.txt", "zipped")}
    assert got == {(i, *f) for i in (1, 3) for f in files}
    assert [(r.id, r.failure_reason) for r in rows if r.route == "comms.failure"] == [(2, "dir_does_not_exist")]
    assert sorted(r.id for r in rows if r.route == "original") == [1, 3]
    only = ingest_files(spark, dirs.filter("id = 1"), regex=r".*\.txt(\.gz)?", emit_original=False)
    assert sorted(r.filename for r in only.collect()) == ["a.txt", "z.txt"]
    raw = ingest_files(spark, dirs.filter("id = 1"), regex="b.log", as_binary=True, emit_original=False).first()
    assert bytes(raw.content) == b"log" and raw.path == str(d)
    assert remove_sources(spark, only) == 2 and not (d / "a.txt").exists() and (d / "b.log").exists()
    assert ingest_files(spark, dirs.filter("id = 2")).first().route == "comms.failure"


def test_stream_files(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.txt").write_text("one\ntwo")
    (d / "b.csv").write_text("x")
    out = stream_files(spark, str(d), regex=r".*\.txt")
    query = out.writeStream.format("memory").queryName("file_stream").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.filename, r.content) for r in spark.table("file_stream").collect()] == [("a.txt", "one\ntwo")]


def test_sql_rows_without_order_is_the_same_at_any_size(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    children = spark.createDataFrame([(1 + i % 2, f"t{i % 7}") for i in range(60)], "pk int, txt string")
    found = [
        sorted((r.id, r.txt, r.fragment_index, r.fragment_count) for r in sql_rows(df, children, {"id": "pk"}, hot_rows=n).collect())
        for n in (5, 10_000)
    ]
    assert found[0] == found[1] and len(found[0]) == 60


def test_directories_named_twice_give_each_file_once(spark, tmp_path):
    from rivulet.sources.files import ingest_files

    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_text("x")
    names = [str(tmp_path / "d"), f"{tmp_path}/d/", f"file://{tmp_path}/d"]
    rows = ingest_files(spark, spark.createDataFrame([(n,) for n in names], "directory string")).collect()
    assert sorted(r.directory for r in rows if r.route == "success") == sorted(names)


def test_enrich_bad_default_and_order_without_on(spark):
    from rivulet.operators import enrich

    spark.createDataFrame([(1,), (3,), (2,)], "n int").createOrReplaceTempView("ordered_numbers")
    df = spark.createDataFrame([("c",)], "content string")
    bad = enrich(df, {"extract-to-attributes": {"x": {"default": "abc", "to-type": "int"}}}).first()
    assert bad.route == "failure" and bad.x is None and "abc" in bad.failure_reason
    spec = {"extract-to-attributes": {"x": {"value": "select n from ordered_numbers", "type": "SQL", "order-by": ["n"]}}}
    assert enrich(df, spec).first().x == "1"


def test_many_cache_entries_are_one_join(spark):
    df = spark.createDataFrame([(i, f"k-{i % 3}", "dup") for i in range(6)] + [(1, "k-1", "dup"), (9, None, None)], "id int, k string, v string")
    spec = {"extract-to-attributes": {f"c{i}": {"value": "k-${id}" if i % 2 else "${k}", "type": "CACHE", "default": f"d{i}"} for i in range(10)}}
    out = enrich(df, spec, sources(spark))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    rows = out.collect()
    assert len(rows) == 8
    for r in rows:
        for i in range(10):
            key = f"k-{r.id}" if i % 2 else (r.k or "")
            assert r[f"c{i}"] == ({"k-1": "v1"}.get(key) or f"d{i}")


def test_rows_without_a_key_do_not_meet(spark):
    df = spark.range(1000).selectExpr("cast(null as string) as k", "id")
    lookup = spark.createDataFrame([("\x000", "never"), ("a", "b")], "key string, value string")
    out = attach_lookup(df, lookup, "${k}", "found")
    assert out.filter("found is not null").count() == 0 and out.count() == 1000


def test_queries_that_refer_to_the_row(spark):
    spark.createDataFrame([(1, "a", 10), (1, "b", 20), (2, "x-it's-y", 30)], "k int, t string, v int").createOrReplaceTempView("asked")
    df = spark.createDataFrame([(1, "1", "a", "c"), (2, " 2.0 ", "it's", "c"), (3, None, "a", "c"), (1, "zz", "a", "c")], "id int, k string, s string, content string")

    def found(query, **more):
        rows = sql_rows(df, query, order_by=["v"], block_on_failure=False, **more).collect()
        return ((r.id, r.s, r.v, r.fragment_index, r.fragment_count, r.route) for r in rows)

    assert sorted(found("select v from asked where k = ${id}"), key=repr) == sorted([
        (1, "a", "10", 1, 2, "success"), (1, "a", "20", 2, 2, "success"), (1, "a", "10", 1, 2, "success"), (1, "a", "20", 2, 2, "success"),
        (2, "it's", "30", 1, 1, "success"), (3, "a", None, None, None, "empty"),
    ], key=repr)
    # within quotes, next to other text, in a comment, and an unknown name
    quoted = sql_rows(df, "select v, '${nope}' as n from asked where t = 'x-${s}-y' -- ${id}\n;", order_by=["v"]).collect()
    assert {(r.id, r.v, r.n, r.route) for r in quoted} == {(2, "30", "", "success"), (1, None, None, "empty"), (3, None, None, "empty")}
    # text outside quotes has to read as a number
    rows = {(r.id, r.k): r for r in sql_scalar(df, "select v from asked where k = ${k} + 0", into="got").collect()}
    assert rows[1, "1"].got == "10" and rows[2, " 2.0 "].got == "30"
    for bad in (rows[3, None], rows[1, "zz"]):
        assert bad.route == "failure" and "select v from asked where k = ${k}" in bad.failure_reason and bad.got is None
    # aggregates, and the first row of a text's own choice
    assert {r.id: r.content for r in sql_scalar(df, "select count(*) from asked where k >= ${id}").collect()} == {1: "3", 2: "1", 3: "0"}
    assert sql_scalar(df.limit(1), "select v, t from asked where k = ${id}", order_by=["t"]).first().content == "10"
    assert sql_scalar(df.limit(1), 'select v from asked where t = "${s}" or `t` = \'q\'').first().content == "10"
    for text, said in [("select v from ${s}", "select v from ${s}"), ("select ${nope}", "no column"), ("select v from asked where k = ${id} limit 1", "cannot limit")]:
        for operator in (sql_rows, sql_scalar):
            with pytest.raises(Exception):
                operator(df, text)
            rows = operator(df, text, block_on_failure=False).collect()
            assert [r.route for r in rows] == ["failure"] * 4 and all(said in r.failure_reason for r in rows)


def test_a_column_of_the_query_may_have_any_name(spark):
    spark.createDataFrame([(1, "a")], "id int, content string").createOrReplaceTempView("same_names")
    df = spark.createDataFrame([(1, "old"), (2, "old")], "id int, content string")
    rows = {r.content: r.id for r in sql_rows(df, "select * from same_names where id = ${id}").collect()}
    assert rows == {"a": 1, "old": 2}


def test_enrich_with_a_templated_query(spark):
    spark.createDataFrame([(1, "b"), (1, "a"), (2, None)], "k int, v string").createOrReplaceTempView("enrich_asked")
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (None, "x")], "id int, content string")
    spec = {"extract-to-attributes": {"got": {"type": "SQL", "value": "select v, k from enrich_asked where k = ${id}", "default": "none"}}}
    rows = {r.id: r for r in enrich(df, spec).collect()}
    assert (rows[1].got, rows[2].got, rows[3].got) == ("a", "none", "none")
    assert rows[None].route == "failure" and "enrich_asked" in rows[None].failure_reason


def test_a_spec_per_row(spark):
    specs = [
        '{"extract-to-attributes":{"w":"w:${word}","n":null,"c":{"value":"k-${id}","type":"CACHE","default":"d"}}}',
        '{"extract-to-json":{"b":{"value":"4${id}","to-type":"long"},"a":{"value":"","default":2.5,"to-type":"double"},"t":"x${nope}y","z":null}}',
        '{"extract-to-json":{"cell":{"value":"1","type":"HBASE","hbase-table":"t"}},"extract-to-attributes":{"m":{"value":"one","type":"HBASE_FILTER","hbase-table":"t","match":{"family":"f","qualifier":"n"}}}}',
        '{"extract-to-attributes":{"m":{"value":"two","type":"HBASE_FILTER","hbase-table":"t","match":{"family":"f","qualifier":"n"}}}}',
        '{"extract-to-attributes":{"m":{"value":"x","to-type":"int"}}}', "{oops", "[1]", None, "{}",
        '{"extract-to-attributes":{"m":{"value":"1","type":"HBASE","hbase-table":"gone"}}}',
        '{"extract-to-attributes":{"m":{"value":"select 1","type":"SQL"}}}',
        '{"extract-to-attributes":{"m":{"value":"1","type":"HBASE"}}}',
    ]
    df = spark.createDataFrame([(i + 1, "word", s, "body") for i, s in enumerate(specs)], "id int, word string, spec string, content string")
    rows = {r.id: r for r in enrich_each(df, "spec", sources(spark)).collect()}
    assert len(rows) == len(specs)
    assert rows[1].attributes == {"w": "w:word", "n": None, "c": "v1"} and rows[1].content == "body" and rows[1].route == "success"
    assert rows[2].content == '{"a":2.5,"b":42,"t":"xy","z":null}' and rows[2].attributes == {}
    assert rows[3].content == '{"cell":"last"}' and rows[3].attributes == {"m": "last"}
    said = {4: "several rows in t", 5: "cannot convert 'x' to int", 6: "no JSON object", 7: "no JSON object", 8: "no JSON object",
            10: "no table gone", 11: "cannot be planned: select 1", 12: "hbase-table argument missing"}
    for i, text in said.items():
        assert rows[i].route == "failure" and text in rows[i].failure_reason and rows[i].content == "body" and rows[i].attributes is None
    assert rows[9].route == "success" and rows[9].attributes == {} and rows[9].content == "body"
    bare = enrich_each(df.drop("content"), "spec").collect()
    assert {r.id: r.failure_reason for r in bare}[1] == "c: there is no cache to look in"


def test_a_broken_file_fails_alone(spark, tmp_path):
    text = "one\ntwo é\n" * 5000
    packed = gzip.compress(text.encode())
    d = tmp_path / "in"
    d.mkdir()
    (d / "good.txt.gz").write_bytes(packed)
    (d / "cut.txt.gz").write_bytes(packed[:-20])
    (d / "not.txt.gz").write_bytes(b"plain text")
    (d / "cut.txt.zst").write_bytes(b"\x28\xb5\x2f\xfd")
    (d / "bytes.txt").write_bytes(b"a\xffb")
    dirs = spark.createDataFrame([(str(d),)], "directory string")
    rows = {r.filename + r.source_file[-3:]: r for r in ingest_files(spark, dirs, emit_original=False).collect()}
    assert len(rows) == 5
    assert rows["good.txt.gz"].route == "success" and rows["good.txt.gz"].content == text
    assert rows["bytes.txttxt"].content == "a\ufffdb"
    for name in ("cut.txt.gz", "not.txt.gz", "cut.txtzst"):
        assert rows[name].route == "failure" and rows[name].content is None and "cannot read" in rows[name].failure_reason
    raw = ingest_files(spark, dirs, as_binary=True, emit_original=False, regex="cut.*gz").first()
    assert raw.route == "success" and bytes(raw.content) == packed[:-20]


@pytest.mark.parametrize("codec", ["gzip", "bzip2", "deflate", "snappy", "lz4"])
def test_every_codec_is_undone(spark, tmp_path, codec):
    lines = [f"line {i} é " + "x" * (i % 50) for i in range(30_000)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.option("compression", codec).text(str(tmp_path / "out"))
    dirs = spark.createDataFrame([(str(tmp_path / "out"),)], "directory string")
    row = ingest_files(spark, dirs, regex="part.*", emit_original=False).first()
    assert row.route == "success" and row.content.splitlines() == lines and row.filename.endswith(".txt")
