"""Members without rows as tables, and the switch of a dataset to its new version."""

import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from statmart.sinks import datasets
from statmart.sinks.datasets import drop_dataset, link_files, replace_dataset
from statmart.sources.archives import convert_members, describe_members, expand_archives, header_names


def _archive(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_header_names():
    assert header_names("csv", "a,,A,b", ",") == ["a0", "_c1", "A2", "b"]
    assert header_names("csv", '"x;y";z', ";") == ["x;y", "z"]
    assert header_names("csv", None) == header_names("txt", None) == ["_c0"] == header_names("csv", "")
    assert header_names("txt", "code  naam ") == ["code", "naam"]


MEMBERS = {"full.csv": "code,naam\nGM1,Een\n", "other.csv": "code,naam\r\nGM2,\r\n", "head.csv": "code,naam\n",
           "head2.csv": "﻿id,,id", "none.csv": "", "blank.csv": "\n \n", "late.csv": "\n\nk\n\n1\n", "table.csv": "table,x\n1,2\n",
           "w1.txt": "code naam\nGM1  Een\n", "w2.txt": "code naam\n", "w3.txt": "", "notes.md": "x"}


@pytest.fixture
def converted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    _archive(tmp_path / "in" / "data.zip", MEMBERS)
    members = expand_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    return members, convert_members(spark, members, str(tmp_path / "converted"))


def test_every_member_becomes_a_table(spark, tmp_path, converted):
    members, out = converted
    told = {r["path"].rsplit("/", 1)[1]: (r["head"], r["filled"]) for r in describe_members(members).collect()}
    assert told["late.csv"] == ("k", True) and told["none.csv"] == (None, False) and told["w2.txt"] == ("code naam", False)
    tables = replace_dataset(spark, "zip", "empty_unit", out, location=str(tmp_path / "db"))
    try:
        assert len(tables) == len(MEMBERS) - 1
        got = {t.split(".")[1]: (spark.table(t).columns, rows(spark.table(t))) for t in tables}
    finally:
        drop_dataset(spark, "zip_empty_unit")
    csvs = {t: v for (t, v), (_, _, f) in zip(got.items(), out) if f == "parquet"}
    assert len(csvs) == 8
    by_columns = sorted((tuple(c), tuple(r)) for c, r in got.values())
    assert by_columns == sorted([
        (("code", "naam"), (("GM1", "Een"),)), (("code", "naam"), (("GM2", None),)), (("code", "naam"), ()),
        (("id0", "_c1", "id2"), ()), (("_c0",), ()), (("_c0",), ()), (("k",), (("1",),)), (("table", "x"), (("1", "2"),)),
        (("code", "naam"), (("GM1", "Een"),)), (("code", "naam"), ()), (("_c0",), ())])
    # without the catalog: a table's files alone have its columns
    empty = {t: spark.read.parquet(p).columns for t, p, f in out if f == "parquet"}
    assert ["code", "naam"] in empty.values() and ["id0", "_c1", "id2"] in empty.values() and ["_c0"] in empty.values()


def test_archives_without_any_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    _archive(tmp_path / "in" / "data.zip", {"a.md": "x"})
    members = expand_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert convert_members(spark, members, str(tmp_path / "converted")) == []


def _folders(spark, tmp_path, n, *names):
    for t in names:
        spark.range(n).write.parquet(str(tmp_path / f"{n}" / f"{t}.parquet"))
    return [str(tmp_path / f"{n}" / f"{t}.parquet") for t in names]


def _databases(spark, like):
    return sorted(d.name for d in spark.catalog.listDatabases() if like in d.name)


@pytest.mark.parametrize("step", ["CREATE OR REPLACE VIEW `switch_unit`.`b`", "ALTER DATABASE `switch_unit`", "createTable",
                                  "CREATE DATABASE"])
def test_a_failure_between_steps_keeps_the_old_dataset(spark, tmp_path, monkeypatch, step):
    one, two = _folders(spark, tmp_path, 1, "a", "b"), _folders(spark, tmp_path, 2, "a", "b", "c")
    replace_dataset(spark, "switch", "unit", one)
    try:
        real_sql, real_create = type(spark).sql, type(spark.catalog).createTable
        seen = []

        def sql(self, text, *args, **kw):
            if text.startswith(step) and not seen:
                seen.append(text)
                raise RuntimeError("lost")
            return real_sql(self, text, *args, **kw)

        def create(self, name, *args, **kw):
            if step == "createTable" and "`c`" in name:
                seen.append(name)
                raise RuntimeError("lost")
            return real_create(self, name, *args, **kw)

        monkeypatch.setattr(type(spark), "sql", sql)
        monkeypatch.setattr(type(spark.catalog), "createTable", create)
        with pytest.raises(RuntimeError, match="lost"):
            replace_dataset(spark, "switch", "unit", two)
        monkeypatch.undo()
        assert seen and sorted(t.name for t in spark.catalog.listTables("switch_unit")) == ["a", "b"]
        assert [spark.table(f"switch_unit.{t}").count() for t in "ab"] == [1, 1]
        assert len(_databases(spark, "switch_unit")) == 2  # the names and the old version
        assert replace_dataset(spark, "switch", "unit", two) == [f"switch_unit.{t}" for t in "abc"]
        assert [spark.table(f"switch_unit.{t}").count() for t in "abc"] == [2, 2, 2]
    finally:
        monkeypatch.undo()
        drop_dataset(spark, "switch_unit")
    assert _databases(spark, "switch_unit") == []


def test_a_failed_first_load_leaves_nothing(spark, tmp_path, monkeypatch):
    one = _folders(spark, tmp_path, 1, "a")
    monkeypatch.setattr(datasets, "_point", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        replace_dataset(spark, "first", "unit", one)
    assert _databases(spark, "first_unit") == []


def test_every_name_is_there_during_the_switch(spark, tmp_path, monkeypatch):
    """Between any two steps each old name can be read, in its old or new state."""
    one, two = _folders(spark, tmp_path, 1, "a", "b"), _folders(spark, tmp_path, 2, "a", "b")
    replace_dataset(spark, "steady", "unit", one)
    seen = []
    real = type(spark).sql

    def sql(self, text, *args, **kw):
        out = real(self, text, *args, **kw)
        if not text.startswith("DESCRIBE"):
            seen.append(tuple(spark.table(f"steady_unit.{t}").count() for t in "ab"))
        return out

    monkeypatch.setattr(type(spark), "sql", sql)
    replace_dataset(spark, "steady", "unit", two)
    monkeypatch.undo()
    assert (1, 1) in seen and (2, 1) in seen and seen[-1] == (2, 2)
    drop_dataset(spark, "steady_unit")


def test_linked_tables_are_replaced(spark, tmp_path):
    """A dataset whose tables were registered one by one (K5) becomes one of names, without the tables it lost."""
    spark.sql("CREATE DATABASE linked_unit")
    link_files(spark, "linked_unit", _folders(spark, tmp_path, 1, "a", "gone"))
    replace_dataset(spark, "linked", "unit", _folders(spark, tmp_path, 2, "a"), "told")
    assert [t.name for t in spark.catalog.listTables("linked_unit")] == ["a"]
    assert spark.table("linked_unit.a").agg(F.max("id")).first()[0] == 1
    drop_dataset(spark, "linked_unit")
    assert _databases(spark, "linked_unit") == []


def _check_read(spark, tables, parts):
    from statmart.sinks.datasets import read_tables
    try:
        read = read_tables(spark, tables, "name")
        assert len(read) == parts and sorted(t for names, _ in read for t in names) == sorted(tables)
        got = {t: [] for t in tables}
        for names, df in read:
            for r in df.collect():
                assert r["name"] in names
                got[r["name"]].append(tuple(r)[:-1])
        assert {t: sorted(r) for t, r in got.items()} == {t: sorted(map(tuple, spark.table(t).collect())) for t in tables}
    finally:
        drop_dataset(spark, tables[0].split(".")[0])


def test_tables_of_one_schema_are_read_in_one_scan(spark, tmp_path):
    uris = []
    for i in range(6):
        names = ["k", "v"] if i < 5 else ["z"]
        rows = [(str(10 * i + k),) * len(names) for k in range(i)]
        df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
        df.write.parquet(f"{tmp_path}/odd 50%+ö/p{i}.parquet")
        uris.append(f"{tmp_path}/odd 50%+ö/p{i}.parquet")
        if i:
            df.write.json(f"{tmp_path}/odd 50%+ö/j{i}.json")
            uris.append(f"{tmp_path}/odd 50%+ö/j{i}.json")
    copy = ("copy", uris[1], "parquet")  # a second table of the same files
    _check_read(spark, replace_dataset(spark, "scan", "unit", [*uris, copy]), 4)  # two formats, two schemas
    spark.sql("CREATE DATABASE scan_linked")
    _check_read(spark, link_files(spark, "scan_linked", uris[:4]), 2)


def test_plan_of_zip_members_has_a_scan_per_schema(spark):
    from conftest import plan_text
    from statmart.plans import suite
    for name, most in (("zip_empty_members", 3), ("zip_to_dataset", 4)):
        assert plan_text(suite.QUERIES[name](spark, "/root/testdata/sf0.1")).count("Location: ") <= most


def test_few_tasks_for_many_files(spark):
    from statmart.sources.archives import TASKS_PER_CORE, map_files
    most = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    listing = spark.range(20 * most).selectExpr("concat('f', id) AS path")
    done = map_files(listing, lambda path: iter([{"path": path}]), "path string")
    assert done.rdd.getNumPartitions() == most and done.distinct().count() == 20 * most
