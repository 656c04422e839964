import pytest
from pyspark.sql import functions as F

from rivulet.operators import validate_xml, xml_extract, xml_to_columns


def contents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, content string")


def test_xml_extract(spark):
    df = contents(spark, "<p><who>Ann</who><b>x<i>y</i></b></p>", "<p><who>", None)
    rows = {r.id: r for r in xml_extract(df, {"who": "/p/who", "b": "//b", "none": "/p/z"}).collect()}
    assert (rows[0].who, rows[0].b, rows[0].none, rows[0].route) == ("Ann", "xy", "", "success")
    assert rows[1].route == "failure" and rows[1].who is None
    assert rows[2].route == "failure" and "no XML" in rows[2].failure_reason


def test_xml_extract_sources(spark):
    df = spark.createDataFrame([("k1", "<a>col</a>", "<a>content</a>")], "key string, doc string, content string")
    lookup = spark.createDataFrame([("k1", "<a>stored</a>")], "key string, value string")
    assert xml_extract(df, {"v": "/a"}, source="doc").first().v == "col"
    assert xml_extract(df, {"v": "/a"}, lookup=lookup, lookup_key="${key}").first().v == "stored"
    assert xml_extract(df, {"v": "/a"}).first().v == "content"
    missing = xml_extract(df, {"v": "/a"}, lookup=lookup, lookup_key="other").first()
    assert missing.route == "failure"


def test_xml_to_columns_record_and_table(spark):
    rec = xml_to_columns(contents(spark, "<r><my.name>Ann</my.name><e/></r>"), "/r", "record", prefix="t.").collect()
    good = [r for r in rec if r.route == "success"]
    assert good[0].attributes == {"t.my.name": "Ann", "t.e": ""} and good[0].fragment_index is None
    assert [r.content for r in rec if r.route == "original"] == ["<r><my.name>Ann</my.name><e/></r>"]
    table = xml_to_columns(
        contents(spark, "<r><p><n>A</n></p><p><n>B</n><m>q<x>z</x></m></p></r>", "<r>"),
        "/r", "table", rename={"n": "name", "u": "extra"}, prefix="t.",
    ).collect()
    good = sorted((r for r in table if r.route == "success"), key=lambda r: r.fragment_index)
    assert good[0].attributes == {"name": "", "extra": "", "t.name": "A"}
    assert good[1].attributes == {"name": "", "extra": "", "t.name": "B", "t.m": "qz"}
    assert good[1].fragment_count == 2 and good[0].fragment_identifier == good[1].fragment_identifier
    assert [r.id for r in table if r.route == "failure"] == [1]


@pytest.mark.parametrize("root, parse, tag", [("/r/ps", "table", "p"), ("/r/ps/p", "record", None)])
def test_native_fields_equal_udf(spark, root, parse, tag):
    df = contents(spark, "<r><ps><p><n>A</n></p><p><n>B</n><m>q</m></p></ps></r>", "<r><ps/></r>", "<r>")
    slow = xml_to_columns(df, root, parse).collect()
    fast = xml_to_columns(df, root, parse, fields=["n", "m"], record_tag=tag).collect()
    key = lambda r: (r.id, r.route, r.fragment_index or 0, str(r.asDict()))
    a = sorted((r.id, r.route, r.fragment_index or 0, (r.attributes or {}).get("n"), (r.attributes or {}).get("m")) for r in slow if r.route == "success")
    b = sorted((r.id, r.route, r.fragment_index or 0, r.n, r.m) for r in fast if r.route == "success")
    assert [str(x) for x in a] == [str(x) for x in b]
    assert sorted((r.id, r.route) for r in slow) == sorted((r.id, r.route) for r in fast)


XSD = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="p"><xs:complexType><xs:sequence>
<xs:element name="n" type="xs:string"/><xs:element name="age" type="xs:integer"/>
</xs:sequence></xs:complexType></xs:element></xs:schema>"""


def test_validate_xml(spark, tmp_path):
    df = contents(spark, "<p><n>A</n><age>3</age></p>", "<p><n>A</n><age>x</age></p>", "<p><n>A</n></p>", "<p>", None)
    routes = {r.id: r.route for r in validate_xml(df, xsd_text=XSD).collect()}
    assert routes == {0: "success", 1: "invalid", 2: "invalid", 3: "invalid", 4: "invalid"}
    path = tmp_path / "one.xsd"
    path.write_text(XSD)
    other = tmp_path / "two.xsd"
    other.write_text(XSD.replace('"p"', '"q"'))
    both = validate_xml(df, xsd_path=f"{path},{other}")
    assert {r.id: r.route for r in both.collect()}[0] == "success"
    gone = validate_xml(df, xsd_path=str(tmp_path / "gone.xsd"), xsd_text=XSD).collect()
    assert {r.route for r in gone} == {"failure"} and "gone.xsd" in gone[0].failure_reason
    with pytest.raises(ValueError):
        validate_xml(df)


def test_xml_extract_of_more_than_one_document(spark):
    df = contents(
        spark, "<a>1</a>junk", "<a/><b/>", "junk<a/>", '<?xml version="1.0" encoding="UTF-8"?>\n<a>2</a>\n',
        "<a>3</a> <!-- end -->", "", "  ", "<!-- only -->", "</w><w><a/>",
    )
    rows = {r.id: (r.route, r.v) for r in xml_extract(df, {"v": "/a"}).collect()}
    good = {3: "2", 4: "3"}
    assert rows == {i: ("success", good[i]) if i in good else ("failure", None) for i in range(9)}


DIRTY = [
    "<a><p><n> 1 </n></p></a>", "<a><p><n>1</n></p></a>junk", "<zzz><p><n>1</n></p></zzz>",
    '<a xmlns:n="urn:x"><p><n:x>v</n:x><n>1</n></p></a>', "<a><p><n>q<x>z</x>r</n></p><q><n>other</n></q></a>",
    "<a><p><n>1</n><n>2</n></p></a>", '<a><p n="att"/></a>', "<a><p><n/></p></a>", "<a>", "<a/><a/>", "", None,
    "<a><p><n>&lt;&#233;<![CDATA[<c>]]></n></p></a>", '<a xmlns="urn:d"><p><n>default</n></p></a>',
]


def test_fields_and_map_agree_on_every_document(spark):
    df = contents(spark, *DIRTY)
    for root, parse in (("/a", "table"), ("/a/p", "record"), ("/*", "table"), ("//p", "record")):
        slow = xml_to_columns(df, root, parse, record_tag="p").collect()
        fast = xml_to_columns(df, root, parse, fields=["n", "n:x"], record_tag="p").collect()
        a = [(r.id, r.route, r.fragment_index, (r.attributes or {}).get("n"), (r.attributes or {}).get("n:x")) for r in slow]
        b = [(r.id, r.route, r.fragment_index, r.n, r["n:x"]) for r in fast]
        assert sorted(a, key=repr) == sorted(b, key=repr)
    got = {r.id: (r.route, r.n, r["n:x"]) for r in xml_to_columns(df, "/a", fields=["n", "n:x"], record_tag="p", emit_original=False).collect()}
    assert got[0] == ("success", " 1 ", None) and got[3] == ("success", "1", "v") and got[4] == ("success", "qzr", None)
    assert got[5] == ("success", "2", None) and got[6] == ("success", None, None) and got[7] == ("success", "", None)
    assert got[12] == ("success", "<é<c>", None) and got[13] == ("success", "default", None) and 2 not in got
    assert all(got[i][0] == "failure" for i in (1, 8, 9, 10, 11))
    assert xml_to_columns(df.filter("id = 3"), "/a/p/n:x", "record").filter("route = 'success'").count() == 1


def test_a_path_that_cannot_be_read_fails_every_row(spark):
    for root in ("/a[position()<2]", "/a[", "/a::b"):
        rows = xml_to_columns(contents(spark, *DIRTY), root).collect()
        assert len(rows) == len(DIRTY)
        assert all(r.route == "failure" for r in rows) or root == "/a::b"


def test_schemas_of_several_namespaces(spark, tmp_path):
    def xsd(name, target, root):
        path = tmp_path / name
        ns = f' targetNamespace="{target}" elementFormDefault="qualified"' if target else ""
        path.write_text(f'<?xml version="1.0"?><xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"{ns}><xs:element name="{root}" type="xs:integer"/></xs:schema>')
        return str(path)

    files = [xsd("a.xsd", "urn:a", "one"), xsd("a2.xsd", "urn:a", "two"), xsd("b.xsd", "urn:b", "one"), xsd("none.xsd", "", "one"), xsd("none2.xsd", "", "three")]
    df = contents(
        spark, '<one xmlns="urn:a">1</one>', '<x:two xmlns:x="urn:a">2</x:two>', '<one xmlns="urn:b">3</one>', "<one>4</one>",
        "<three>5</three>", '<two xmlns="urn:b">6</two>', "<two>7</two>", '<one xmlns="urn:a">x</one>',
    )
    routes = {r.id: r.route for r in validate_xml(df, xsd_path=files).collect()}
    assert routes == {i: "success" if i < 5 else "invalid" for i in range(8)}
    assert {r.id: r.route for r in validate_xml(df, xsd_path=files[0]).collect()}[0] == "success"


def test_a_broken_schema_makes_every_row_invalid(spark, tmp_path):
    df = contents(spark, "<p/>", None)
    for text in ("<xs:schema", "no schema", XSD.replace("xs:string", "xs:nothing")):
        rows = validate_xml(df, xsd_text=text).collect()
        assert [r.route for r in rows] == ["invalid"] * 2 and all("schema cannot be read" in r.failure_reason for r in rows)


def test_texts_of_one_element_are_told_from_others(spark):
    from xml.parsers import expat

    from rivulet.operators.xml import ONE_ELEMENT, well_formed

    def plain(text):
        try:
            expat.ParserCreate().Parse(text, True)
        except expat.ExpatError:
            return False
        return True

    ends = ["<a>", "</a>", "<a/>", "<b>", "</b>", "<ab>", "</ab>", "x", " ", "<!--<a>-->", "<!--</a>", "-->", "<![CDATA[</a>", "]]>", "<a k='<'>", "</a >"]
    texts = [x + y + z for x in ends for y in ends for z in ["", *ends]] + ["<a>" * n + "</a>" * m for n in range(4) for m in range(4)]
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    got = table.select("t", well_formed(F.col("t")).alias("ok"), F.col("t").rlike(ONE_ELEMENT).alias("short")).collect()
    assert {r.t: r.ok for r in got} == {t: plain(t) for t in texts}
    assert any(r.ok and r.short for r in got) and any(r.ok and not r.short for r in got)


def test_tasks_that_parse_are_bounded_in_rows(spark):
    from rivulet.plans.registry import TASK_ROWS, spread

    rows = spread(spark.range(0, 12 * TASK_ROWS, 1, 4)).groupBy(F.spark_partition_id()).count().collect()
    assert len(rows) == 12 and max(r["count"] for r in rows) <= 1.1 * TASK_ROWS
