import json

import pytest
from conftest import rows

from plantroom.sources import documents, tables, uploads


def test_json_files_wrapped_and_nested(spark, tmp_path):
    path = tmp_path / "orgs.json"
    path.write_text(json.dumps({"data": [{"id": 1, "info": {"a": {"b": 2}}, "tags": ["x"]}, {"id": 2}]}, indent=1))
    out = documents.read_json(
        spark, str(path), "data array<struct<id: int, info: struct<a: struct<b: int>>, tags: array<string>>>",
        wrapper="data", multiline=True,
    )
    assert out.columns == ["id", "info.a.b", "tags"]
    assert rows(out) == [(1, 2, ["x"]), (2, None, None)]
    inferred = documents.read_json(spark, str(path), wrapper="data", multiline=True, flat=False)
    assert inferred.columns == ["id", "info", "tags"]


def test_json_lines_keep_drifting_columns(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"id": 1, "a": "x"}\n{"id": 2, "b": [1, "t", null]}\n')
    out = documents.read_json(spark, str(path), "id int, a string, b array<string>")
    assert rows(out) == [(1, "x", None), (2, None, ["1", "t", None])]


def test_what_is_no_table_is_refused(table):
    for df in (table("data struct<a: int>", ((1,),)), table("data array<int>", ([1],)), table("x int", (1,))):
        with pytest.raises(ValueError):
            documents.unwrap(df, "data")


def test_rows_to_json_and_back(table):
    df = table("`p.topic` string, n int, l array<int>", ("t", 1, [1, 2]), (None, 2, None))
    payload = documents.rows_to_json(df)
    assert json.loads(payload.first().payload) == {"p.topic": "t", "n": 1, "l": [1, 2]}
    assert rows(documents.parse_json(payload, "payload", df.schema)) == rows(df)


def test_csv_files_and_lines(spark, table, tmp_path):
    path = tmp_path / "upload.csv"
    path.write_text('p.topic,e.equip_id,n\n"t,1",A,5\nt2,,\n"a ""b"" c",B,1\n')
    schema = "`p.topic` string, `e.equip_id` string, n int"
    expected = sorted([("t,1", "A", 5), ("t2", None, None), ('a "b" c', "B", 1)])
    for multiline in (True, False):
        read = uploads.read_upload_csv(spark, str(path), schema, multiline)
        assert rows(read.rows) == expected and read.refused.count() == 0
    lines = table("line string", ('"t,1",A,5',), ("t2,,",), ('"a ""b"" c",B,1',))
    assert rows(uploads.parse_upload_csv(lines, "line", schema).rows) == expected
    parsed_schema = read.rows.schema
    assert rows(uploads.parse_upload_csv(lines, "line", parsed_schema).rows) == expected


def test_csv_records_that_do_not_parse_come_back(spark, table, tmp_path):
    path = tmp_path / "upload.csv"
    path.write_text('p.topic,note,n\nt1,x,abc\nt2,"line one\nline two",2\nt3\nt4,y,4,more\nt5,z,5\n')
    schema = "`p.topic` string, note string, n double"
    read = uploads.read_upload_csv(spark, str(path), schema)
    assert rows(read.rows) == [("t2", "line one\nline two", 2.0), ("t5", "z", 5.0)]
    assert rows(read.refused, "error") == [
        ("does not parse: t1,x,abc",), ("does not parse: t3",), ("does not parse: t4,y,4,more",),
    ]
    assert read.refused.select("error").count() == 3 and read.rows.select("n").count() == 2
    lines = table("line string", ("t1,x,abc",), ("t3",), ("t5,z,5",))
    parsed = uploads.parse_upload_csv(lines, "line", schema)
    assert rows(parsed.rows) == [("t5", "z", 5.0)] and parsed.refused.count() == 2


def test_json_that_does_not_parse_is_reported(spark, table, tmp_path):
    texts = table("no int, text string", (1, '{"a": 1}'), (2, '{"a": '), (3, None), (4, '{"b": 2}'))
    assert rows(documents.unparsed_json(texts, "text", "a int"), "no") == [(2,)]
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        documents.parse_json(texts, "text", "a int").collect()
    assert documents.parse_json(texts, "text", "a int", mode="PERMISSIVE").count() == 4
    path = tmp_path / "lines.json"
    path.write_text('{"id": 1}\n{"id": \n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        documents.read_json(spark, str(path), "id int").collect()
    assert documents.read_json(spark, str(path), "id int", mode="PERMISSIVE").count() == 2


def test_readings_files_of_different_width(spark, table, tmp_path):
    path = f"{tmp_path}/readings"
    table("point_id int, raw double", (1, 1.0)).write.parquet(path)
    table("point_id int, raw double, quality string", (2, 2.0, "good")).write.mode("append").parquet(path)
    expected = sorted([(1, None), (2, "good")], key=repr)
    assert rows(tables.read_table(spark, str(tmp_path), "readings"), "point_id", "quality") == expected
    stated = tables.read_table(spark, str(tmp_path), "readings", "point_id int, raw double, quality string")
    assert rows(stated, "point_id", "quality") == expected


def test_tables_merge_columns_and_are_never_overwritten(spark, table, tmp_path):
    root = str(tmp_path)
    tables.write_new(table("id int, building_id int", (1, 5)), f"{root}/points", ["building_id"])
    table("id int, note string, building_id int", (2, "x", 6)).write.mode("append").partitionBy("building_id").parquet(
        f"{root}/points"
    )
    assert rows(tables.read_table(spark, root, "points"), "id", "note") == sorted([(1, None), (2, "x")], key=repr)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_new(table("id int", (1,)), f"{root}/points")
    with pytest.raises(ValueError):
        tables.read_table(spark, root, "secrets")


def test_json_of_unknown_shape(spark, table):
    texts = table(
        "text string",
        ('{"a": 1, "b": {"c": "x", "d.e": 2.5}, "l": [1, 2], "o": {}, "n": null}',),
        ('{"a": "t", "b": {"c": null, "z": true}, "l": ["y", null]}',),
        ('{"a": {"k": 1}, "big": 12345678901, "m": [{"p": 1}, {"q": "r"}]}',),
        (None,),
    )
    out = documents.flatten_json(texts, "text")
    assert dict(out.dtypes) == {
        "a": "string", "b.c": "string", "b.d.e": "double", "b.z": "boolean", "big": "bigint", "l": "array<string>",
        "m": "array<struct<p:bigint,q:string>>", "n": "string",
    }
    found = {r["a"]: r for r in out.collect()}
    assert (found["1"]["b.c"], found["1"]["b.d.e"], found["1"]["l"]) == ("x", 2.5, ["1", "2"])
    assert (found["t"]["b.z"], found["t"]["l"]) == (True, ["y", None])
    assert (found['{"k":1}']["big"], found['{"k":1}']["m"]) == (12345678901, [(1, None), (None, "r")])
    assert set(found[None]) == {None}
    stated = documents.flatten_json(texts, "text", documents.variant_schema(texts.selectExpr("parse_json(text) as v"), "v"))
    assert rows(stated) == rows(out)


def test_json_that_is_no_table(spark, table):
    bad = table("text string", ('{"a": 1}',), ('{"a": ',))
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        documents.flatten_json(bad, "text").collect()
    assert rows(documents.flatten_json(bad, "text", mode="PERMISSIVE")) == sorted([(1,), (None,)], key=repr)
    with pytest.raises(ValueError, match="no objects"):
        documents.flatten_json(table("text string", ("[1, 2]",)), "text")
    assert documents.flatten_json(bad.where("false"), "text").columns == []
