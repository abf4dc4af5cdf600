"""CSV read in parallel against the reader that gives a file to one task."""

import random

import pytest
from conftest import rows

from plantroom.sources import uploads
from plantroom.sources.csv_records import csv_records

SCHEMA = "`p.topic` string, note string, n int"


@pytest.fixture
def small_splits(spark):
    """Files are split after so many bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "50", "spark.sql.files.minPartitionNum": "64"}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def one_task(spark, path, schema=SCHEMA):
    reader = spark.read.options(**uploads.DIALECT).option("header", True).option("multiLine", True)
    return reader.option("columnPruning", False).schema(f"{schema}, {uploads.BAD_RECORD} string").csv(path)


def field(pick):
    kind = pick.randrange(8)
    if kind == 0:
        return '"' + "\n".join('x""y,' * pick.randrange(3) for _ in range(pick.randrange(1, 6))) + '"'
    if kind == 1:
        return '"' + "long line\n" * pick.randrange(120) + '"'
    if kind == 2:
        return '""'
    if kind == 3:
        return '"""\n"""'
    if kind == 4:
        return 'five" pipe'
    return pick.choice(["plain", "", "é\U0001f600", '"quoted, with comma"'])


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_like_the_reader_of_whole_files(spark, tmp_path, small_splits, seed, end):
    pick = random.Random(seed)
    for name in ("a.csv", "b.csv"):
        lines = [f"t{i},{field(pick)},{pick.choice([i, '', 'abc'])}" + (",more" if pick.random() < 0.1 else "") for i in range(60)]
        # the other reader turns a carriage return within a field into a plain line break
        (tmp_path / name).write_bytes(end.join(["p.topic,note,n", *lines, ""][: None if seed else -1]).encode())
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20
    read = uploads.read_upload_csv(spark, str(tmp_path), SCHEMA).parsed
    expected = one_task(spark, str(tmp_path))
    same = lambda found: sorted((tuple(v.replace("\r\n", "\n") if isinstance(v, str) else v for v in r) for r in found), key=repr)
    assert same(rows(read)) == same(rows(expected)) and read.count() > 100


def test_a_field_over_many_splits_and_one_never_closed(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(400))
    (tmp_path / "a.csv").write_text(f'p.topic,note,n\nt1,"{long}",1\nt2,x,2\nt3,"open\nto the\nend,3\n')
    records = csv_records(spark, str(tmp_path), ["p.topic", "note", "n"])
    assert rows(records) == sorted([(f't1,"{long}",1',), ("t2,x,2",), ('t3,"open\nto the\nend,3',)])


def test_headers(spark, tmp_path, small_splits):
    note = "note " * 100 + "\n" + "more " * 100
    (tmp_path / "a.csv").write_text(f'﻿p.topic,"{note}"\n\n\nt1,x\n')
    (tmp_path / "b.csv").write_text(f'P.Topic,"{note}"\n')
    assert rows(csv_records(spark, str(tmp_path), ["p.topic", note])) == [("t1,x",)]
    for text in ("other,names\nt1,x\n", "p.topic,\"no\nte\"\nt1,x\n", "p.topic\n"):
        (tmp_path / "c.csv").write_text(text)
        with pytest.raises(Exception, match="the header of a CSV file is"):
            csv_records(spark, str(tmp_path / "c.csv"), ["p.topic", "note"]).collect()
    (tmp_path / "empty.csv").write_text("")
    assert rows(csv_records(spark, str(tmp_path / "empty.csv"), ["p.topic"])) == []


def test_records_are_parsed_once(spark, table):
    lines = table("line string", ("t1,x,1",), ("t2,x",))
    parsed = uploads.parse_upload_csv(lines, "line", SCHEMA)
    for df in (parsed.rows, parsed.refused, parsed.rows.where("n > 0").select("note")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1
    kept = parsed.kept()
    assert rows(kept.rows) == rows(parsed.rows) and rows(kept.refused) == rows(parsed.refused)
    assert "from_csv" not in kept.rows._jdf.queryExecution().optimizedPlan().toString()
