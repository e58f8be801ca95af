"""Lines by byte ranges and elements of JSON documents, against plain reading."""

import io
import json
import random
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, plan_text, rows
from statmart.sources.json_records import read_envelope
from statmart.sources.ranges import (json_elements, lines, lines_between, places_of, plan_ranges, sized_files,
                                     xml_elements)
from statmart.sources.sheet import read_sheet_export
from statmart.sources.fixed_width import Layout, read_fixed_width


def plain_lines(data):
    return [m.group(1) for m in re.finditer(rb"([^\r\n]*)(?:\r\n|\n|\r|\Z)", data) if m.group(0) or m.start() < len(data)]


@pytest.mark.parametrize("ends", [b"\n", b"\r\n", b"\r"])
@pytest.mark.parametrize("step", [1, 2, 3, 7, 64, 1000])
def test_every_line_is_in_one_range(ends, step):
    rng = random.Random(step)
    for _ in range(30):
        data = b"".join(rng.choice([b"", b"a", b"bc" * 5, b"d" * 40]) + (ends if rng.random() < .9 else b"\n") for _ in range(20))
        data += rng.choice([b"", b"tail"])
        got = []
        for at in range(0, len(data), step):
            f = io.BytesIO(data)
            for place, part in lines_between(f, at, min(len(data), at + step), len(data)):
                assert data[place:place + len(part[0])] == part[0]
                got += part
        assert got == plain_lines(data)
        f, want, place = io.BytesIO(data), set(), 0
        for i, line in enumerate(data.splitlines(keepends=True)):
            want |= {place} if i in (0, 3, 19, 50) else set()
            place += len(line)
        assert places_of(f, {0, 3, 19, 50}, len(data)) == want


def test_ranges_cover_files_and_small_ones_share_a_task():
    files = [("a", 0), ("b", 10), ("c", 2500), ("d", 10)]
    planned = plan_ranges(files, 1000, 100)
    covered = sorted(p for r in planned for p in r.parts)
    assert covered == [("b", 0, 10, 10), ("c", 0, 1000, 2500), ("c", 1000, 2000, 2500), ("c", 2000, 2500, 2500), ("d", 0, 10, 10)]
    assert len(planned) == 3
    assert [r.parts for r in plan_ranges([("c", 2500)], 1000, 0, whole=True)] == [[("c", 0, 2500, 2500)]]


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lines_source(spark, tmp_path, small_ranges):
    folder = tmp_path / "a b"
    folder.mkdir()
    (folder / "one+%20é.txt").write_bytes("﻿h\nä\nb\n\nc".encode())
    (folder / "two.txt").write_bytes(b"".join(b"x%05d\r\n" % i for i in range(500)))
    (folder / "none.txt").write_bytes(b"")
    (folder / "_hidden").write_text("no")
    files = sized_files(spark, str(folder))
    df = lines(spark, files, skip=[("two", [0, 400]), ("a b", [1])])  # a folder's name is no file's name
    assert df.rdd.getNumPartitions() >= 5
    got = {}
    for value, file in rows(df):
        got.setdefault(file, []).append(value)
    whole = {r[0] for r in spark.read.text(str(folder)).selectExpr("_metadata.file_path").distinct().collect()}
    assert set(got) == whole
    one, two = (sorted(got[f]) for f in sorted(got))
    assert one == sorted(["h", "ä", "b", "", "c"])
    assert two == [f"x{i:05d}" for i in range(500) if i not in (0, 400)]
    wide = tmp_path / "w.txt"
    wide.write_text("k\nä\nü\n" * 300, encoding="utf-16")
    assert sorted(r[0] for r in lines(spark, sized_files(spark, str(wide)), "utf-16", [(None, [0])]).collect()) \
        == sorted(["k"] * 299 + ["ä", "ü"] * 300)
    latin = tmp_path / "l.txt"
    latin.write_bytes("é;ü\nñ".encode("latin-1"))
    assert rows(lines(spark, sized_files(spark, str(latin)), "8859").select("value")) == [("é;ü",), ("ñ",)]


def test_headers_and_skipped_rows_need_no_join(spark, tmp_path, small_ranges):
    (tmp_path / "s.csv").write_text("name,value\nunits,n\n" + "".join(f"r{i},{i}\n" for i in range(900)))
    sheet = read_sheet_export(spark, str(tmp_path / "s.csv"), skip_rows=[1, 500], types={"value": "bigint"})
    (tmp_path / "f.txt").write_text("name  value \n" + "".join(f"r{i:<5d}{i:<6d}\n" for i in range(900)))
    fixed = read_fixed_width(spark, str(tmp_path / "f.txt"), Layout(["name", "value"], [6, 6]), header=True)
    for df in (sheet, fixed):
        plan = plan_text(df)
        assert plan.count("BatchScan") >= 1 and "Join" not in plan and "Exchange" not in plan and "Window" not in plan
        assert df.rdd.getNumPartitions() > 10
    assert sorted(r.value for r in sheet.collect()) == [i for i in range(900) if i != 498]
    assert sorted(int(r.value) for r in fixed.collect()) == list(range(900))


def walked(text, key="value", chunk=3):
    return [json.loads(e) for e in json_elements(io.BytesIO(text.encode()), key, chunk)]


@pytest.mark.parametrize("chunk", [1, 2, 5, 1000])
def test_elements_of_documents(chunk):
    docs = [{"value": [1, "a\"b,]", {"value": [9], "x": {"y": [1, 2]}}, None, [], [1, [2]]], "other": {"value": [5]}},
            {"a": [1, 2], "é\\": 1, "value": []}, {"value": "no array"}, {"value": None}, {"next": "value", "b": ["value", 1]},
            {"value": [{"k": "ü€\U0001F600\\"}], "value2": [7]}]
    want = [x for d in docs for x in (d.get("value") if isinstance(d.get("value"), list) else [])]
    for text in ("".join(json.dumps(d) for d in docs), "\n".join(json.dumps(d, indent=2, ensure_ascii=False) for d in docs),
                 json.dumps(docs), " " + json.dumps(docs, indent=1) + "\n" + json.dumps({"value": []})):
        assert walked(text, chunk=chunk) == want
    assert walked("", chunk=chunk) == [] and walked("[]", chunk=chunk) == []
    for broken in ('{"value": [1', '{"value": ["a', "{}}"):
        with pytest.raises(ValueError):
            walked(broken, chunk=chunk)


def test_envelope_through_the_reader(spark, tmp_path):
    folder = tmp_path / "saved"
    folder.mkdir()
    for i in range(3):
        body = {"odata": "x", "value": [{"Identifier": f"{i}-{k}", "n": k, "inner": {"a": [k]}} for k in range(40)]}
        (folder / f"p{i}.json").write_text(json.dumps(body, indent=2))
    (folder / "empty.json").write_text('{"value": []}')
    inferred = read_envelope(spark, str(folder), multi_line=True)
    assert inferred.count() == 120 and set(inferred.columns) == {"Identifier", "n", "inner"}
    typed = read_envelope(spark, str(folder), element_schema="struct<Identifier: string, n: int>", multi_line=True)
    assert rows(typed) == sorted((f"{i}-{k}", k) for i in range(3) for k in range(40))
    assert "Join" not in plan_text(typed)


def test_a_document_larger_than_the_memory_of_its_reader(tmp_path):
    """One document of 160 MB is walked by a process that may take 64 MB more than it starts with."""
    path = tmp_path / "large.json"
    with open(path, "w") as f:
        f.write('{"meta": {"value": [0]}, "value": [\n')
        for i in range(160):
            f.write(("," if i else "") + json.dumps({"id": i, "text": "x" * 1_000_000}) + "\n")
        f.write("]}")
    code = f"""
import resource, sys
sys.path.insert(0, {ROOT!r})
from statmart.sources.ranges import json_elements
held = int([x for x in open("/proc/self/status") if x.startswith("VmData")][0].split()[1]) * 1024
resource.setrlimit(resource.RLIMIT_DATA, (held + (64 << 20), held + (64 << 20)))
n = size = 0
with open({str(path)!r}, "rb") as f:
    for e in json_elements(f, "value"):
        n, size = n + 1, size + len(e)
print(n, size > 160_000_000)
try:
    open({str(path)!r}, "rb").read()
except MemoryError:
    print("too large at once")
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.stdout.split("\n")[:2] == ["160 True", "too large at once"], out.stderr[-2000:]


# --- XML records ------------------------------------------------------------------------------

RECORDS = (b'<r xmlns:b="u"><!-- <Num>no</Num> --><b:Num id="a>b"><x>1</x></b:Num><Num/><Number>9</Number>'
           b"<Num\n id='2' ><x><![CDATA[</Num>]]></x></Num><Num id='3'><Num id='in'/></Num ></r>")
FOUND = [b'<b:Num id="a>b"><x>1</x></b:Num>', b"<Num/>", b"<Num\n id='2' ><x><![CDATA[</Num>]]></x></Num>",
         b"<Num id='3'><Num id='in'/></Num >"]


def test_xml_elements_by_any_piece():
    for chunk in (1, 2, 3, 7, 1000):
        assert list(xml_elements(io.BytesIO(RECORDS), "Num", 0, None, chunk)) == FOUND
    with pytest.raises(ValueError, match="ends inside"):
        list(xml_elements(io.BytesIO(b"<r><Num><x>"), "Num", 0, None))


def test_xml_ranges_cover_each_record_once():
    body = b"<r>" + b"".join(b"<n:Num id='%d'><x>%s</x></n:Num>" % (i, b"y" * (i % 40)) for i in range(200)) + b"</r>"
    whole = list(xml_elements(io.BytesIO(body), "Num", 0, None))
    assert len(whole) == 200
    for step in (5, 64, 333):
        got = []
        for start in range(0, len(body), step):
            f = io.BytesIO(body)
            f.seek(start)
            got += xml_elements(f, "Num", start, start + step, 16)
        assert got == whole


def test_one_line_xml_document_is_read_by_several_tasks(spark, tmp_path):
    from statmart.sources.xml_records import declared_prefixes, read_xml_records
    body = "".join(f'<c:Num id="{i:05d}"><x>{i % 7}</x>' + ("<y><z>1</z></y>" if i % 3 else "") + "</c:Num>" for i in range(3000))
    path = tmp_path / "one.xml"
    path.write_text('<c:r xmlns:c="http://c">' + body + "</c:r>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert declared_prefixes(spark, str(path)) == ({"c"}, {"id"})
        df = read_xml_records(spark, str(path), "Num")
        assert sorted(df.columns) == ["@id", "x", "y"]
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 4
        got = sorted((r["@id"], r["x"], r["y"] and r["y"]["z"]) for r in df.collect())
        assert got == [(f"{i:05d}", str(i % 7), "1" if i % 3 else None) for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_xml_without_records_and_packed(spark, tmp_path):
    import gzip
    from statmart.sources.xml_records import read_xml_records
    (tmp_path / "none.xml").write_text("<r/>")
    assert read_xml_records(spark, str(tmp_path / "none.xml"), "Num").columns == []
    with gzip.open(tmp_path / "a.xml.gz", "wb") as f:
        f.write(b"<r><Num id='1'><x>7</x></Num></r>")
    got = read_xml_records(spark, str(tmp_path / "a.xml.gz"), "Num").collect()
    assert [(r["@id"], r["x"]) for r in got] == [("1", "7")]
