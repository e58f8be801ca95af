import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from statmart.sinks.datasets import (dataset_exists, dataset_name, link_files, replace_dataset,
                                     table_id)
from statmart.sinks.tables import RangeBuckets, read_range, write_ndjson, write_range_partitioned
from statmart.sources.archives import clean_member, expand_archives, list_members
from statmart.sources.dataset import flatten_dataset
from statmart.sources.delimited import read_delimited, read_yearly
from statmart.sources.fixed_width import (REGISTER_LAYOUTS, Layout, infer_layout, read_fixed_width,
                                          read_fixed_width_inferred)
from statmart.sources.json_records import portal_datasets, read_envelope, resource_urls
from statmart.sources.listing import list_files, list_prefix
from statmart.session import local_path
from statmart.sources.sheet import read_sheet_export
from statmart.sources.xml_records import read_xml_records


# --- range partitions ------------------------------------------------------------------

def test_range_bucket_bounds():
    b = RangeBuckets("jaar", 1999, 2030, 1)
    assert (b.last_bound, b.n_partitions) == (2030, 31)
    b3 = RangeBuckets("jaar", 2011, 2019, 3)
    assert (b3.last_bound, b3.n_partitions) == (2017, 2)
    assert [b3.bucket_of(v) for v in (2010, 2011, 2013, 2014, 2016, 2017)] == \
        [None, 2011, 2011, 2014, 2014, None]


def test_range_partition_write_read_prunes(spark, tmp_path):
    df = spark.createDataFrame([(i, 1995 + i % 10) for i in range(100)], "id int, jaar int")
    spec = RangeBuckets("jaar", 1996, 2003, 3)
    path = str(tmp_path / "t")
    write_range_partitioned(df, path, spec)
    write_range_partitioned(df, path, spec)          # overwrite, not append
    assert spark.read.parquet(path).count() == 100
    back = read_range(spark, path, spec, lo=1997, hi=1999)
    assert rows(back.select("jaar").distinct()) == [(1997,), (1998,), (1999,)]
    assert back.count() == 30
    assert "PartitionFilters: [isnotnull(jaar_bucket" in plan_text(back)
    # out-of-range rows sit in the null bucket and are still read
    assert read_range(spark, path, spec, lo=2002).count() == 30   # 2002-2004, null bucket


# --- datasets -----------------------------------------------------------------------

def test_table_id_rule():
    assert table_id("gs://b/x/a.b.parquet") == ("b", "parquet")
    assert table_id("/x/orders.json") == ("orders", "json")


def test_replace_dataset(spark, tmp_path):
    root = str(tmp_path)
    spark.range(5).write.parquet(f"{root}/t_one.parquet")
    write_ndjson(spark.range(3).withColumn("s", F.lit(None).cast("string")), f"{root}/t_two.json")
    lines = [ln for f in sorted(os.listdir(f"{root}/t_two.json")) if f.endswith(".json")
             for ln in open(os.path.join(f"{root}/t_two.json", f)) if ln.strip()]
    assert len(lines) == 3 and json.loads(lines[0])["s"] is None   # null keys kept
    uris = [f"{root}/t_one.parquet", f"{root}/t_two.json", f"{root}/gone.parquet"]
    name = dataset_name("test", "refresh_unit")
    for _ in range(2):
        tables = replace_dataset(spark, "test", "refresh_unit", uris, "unit test",
                                 location=f"{root}/db")
    assert dataset_exists(spark, name)
    assert tables == [f"{name}.t_one", f"{name}.t_two"]
    assert spark.table(f"{name}.t_one").count() == 5 and spark.table(f"{name}.t_two").count() == 3
    with pytest.raises(TypeError):
        link_files(spark, name, [f"{root}/x.csv"])


def test_dataset_group_flatten(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("M", 1.0), ("V", 2.0)], "Geslacht string, Bevolking_1 double") \
        .write.parquet(f"{root}/X1_TypedDataSet.parquet")
    spark.createDataFrame([("M", "Mannen"), ("V", "Vrouwen")], "Key string, Title string") \
        .write.parquet(f"{root}/X1_Geslacht.parquet")
    spark.createDataFrame([("Geslacht", "Geslacht", "Dimension"), ("Bevolking_1", "Bevolking", "Topic")],
                          "Key string, Title string, Type string") \
        .write.parquet(f"{root}/X1_DataProperties.parquet")
    spark.range(1).write.parquet(f"{root}/X2_TypedDataSet.parquet")   # another dataset
    got = flatten_dataset(spark, root, "X1")
    assert rows(got) == [("M", "Mannen", 1.0), ("V", "Vrouwen", 2.0)]


# --- listings -----------------------------------------------------------------------------

def test_listing_and_prefix(spark, tmp_path):
    for rel in ["cbs/kwb/a.csv", "cbs/kwb2/b.csv", "cbs/other/c.txt", "cbs/kwb/_SUCCESS"]:
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("x\n")
    all_csv = list_files(spark, str(tmp_path), "csv").select("relative")
    assert rows(all_csv) == [("cbs/kwb/a.csv",), ("cbs/kwb2/b.csv",)]
    pref = list_prefix(spark, str(tmp_path), "cbs/kwb").select("relative")
    assert rows(pref) == [("cbs/kwb/a.csv",), ("cbs/kwb2/b.csv",)]


# --- fixed width --------------------------------------------------------------------------

def test_register_layout_edge_cases(spark, tmp_path):
    lay = REGISTER_LAYOUTS["zorgverlener_praktijk"]
    def line(nr, toe, uit):
        vals = ["", "22", "01", nr, "12345", toe, uit, "1", "", "01", ""]
        return "".join(v.rjust(w) if i in (5, 6) else v.ljust(w)
                       for i, (v, w) in enumerate(zip(vals, lay.widths)))
    lines = [line("000123", "1012020", "00000000"),
             line("000124", "31022020", ""),
             line("000125", "15062019", "01012021"),
             "0220100012612345"]                           # short line: missing fields → null
    p = tmp_path / "agb.txt"
    p.write_text("\n".join(lines) + "\n")
    df = read_fixed_width(spark, str(p), lay)
    got = df.select("zorgverlenernummer", "datum_toetreding_praktijk",
                    "datum_uittreding_praktijk").collect()
    assert len(got) == 4                                   # first record is kept
    assert [r[0] for r in got] == ["000123", "000124", "000125", "000126"]   # leading zeros kept
    assert str(got[0][1]) == "2020-01-01 00:00:00" and got[0][2] is None
    assert got[1][1] is None and got[1][2] is None
    assert str(got[2][2]) == "2021-01-01 00:00:00"
    assert got[3][1] is None


def test_infer_layout(spark, tmp_path):
    p = tmp_path / "f.txt"
    p.write_text("code  name        amount\n"
                 "A1    first item  12\n"
                 "B22   second      7\n")
    lay = infer_layout(spark, str(p))
    assert list(lay.names) == ["code", "name", "amount"]
    df = read_fixed_width_inferred(spark, str(p))
    assert rows(df) == [("A1", "first item", "12"), ("B22", "second", "7")]


# --- delimited, sheets, yearly ------------------------------------------------------------------

def test_latin1_alias(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_bytes("naam;waarde\nÉén;1\n".encode("latin-1"))
    assert read_delimited(spark, str(p), sep=";", encoding="8859").first() == ("Één", "1")


def test_sheet_skip_rows_and_tokens(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("gemeente,inwoners,aandeel\n"
                 "eenheid,aantal,%\n"
                 "\n"
                 "A,100,5\n"
                 "\n"
                 "B,.,        .\n"
                 "C,\"1,5\",3\n")
    df = read_sheet_export(spark, str(p), skip_rows=[1, 2],
                           types={"inwoners": "double", "aandeel": "double"})
    assert rows(df) == [("A", 100.0, 5.0), ("B", None, None), ("C", None, 3.0)]


def test_yearly_files(spark, tmp_path):
    (tmp_path / "vektis 2018 - gemeente.csv").write_text("GEMEENTE;KOSTEN\nA;1\n")
    (tmp_path / "vektis 2019 - gemeente.csv").write_text("GEMEENTE;KOSTEN;EXTRA\nB;2;x\n")
    df = read_yearly(spark, str(tmp_path))
    assert sorted(df.columns) == ["extra", "gemeente", "jaar", "kosten"]
    assert rows(df.select("gemeente", "extra", "jaar")) == [("A", None, 2018), ("B", "x", 2019)]
    (tmp_path / "zonder jaar.csv").write_text("GEMEENTE;KOSTEN\nC;3\n")
    with pytest.raises(Exception, match="no year"):
        read_yearly(spark, str(tmp_path)).collect()


# --- XML and JSON -----------------------------------------------------------------------

XML = """<?xml version="1.0"?>
<b:root xmlns:b="http://b" xmlns:c="http://c">
<b:Nummeraanduiding xmlns:d="http://d" id="1"><b:postcode>1011AB</b:postcode>
  <b:adres><b:nr>5</b:nr></b:adres></b:Nummeraanduiding>
<b:Nummeraanduiding id="2"><b:postcode>1012CD</b:postcode><b:adres><b:nr>7</b:nr></b:adres></b:Nummeraanduiding>
</b:root>
"""


def test_xml_records_drop_namespace_attributes(spark, tmp_path):
    p = tmp_path / "a.xml"
    p.write_text(XML)
    df = read_xml_records(spark, str(p), "Nummeraanduiding")
    assert sorted(df.columns) == ["@id", "adres", "postcode"]
    assert rows(df.select("`@id`", "postcode", "adres.nr")) == [("1", "1011AB", "5"), ("2", "1012CD", "7")]


def test_xml_prefix_clash_raises(spark, tmp_path):
    p = tmp_path / "b.xml"
    p.write_text('<r xmlns:d="http://d"><Num d="real" id="1"><x>1</x></Num></r>')
    with pytest.raises(ValueError, match="prefix"):
        read_xml_records(spark, str(p), "Num")


def test_envelope_multiline(spark, tmp_path):
    p = tmp_path / "catalog.json"
    p.write_text(json.dumps({"odata.metadata": "x", "value": [
        {"Identifier": "1", "Catalog": "CBS"}, {"Identifier": "2", "Catalog": "MLZ"}]}, indent=2))
    df = read_envelope(spark, str(p), multi_line=True)
    assert rows(df.select("Identifier", "Catalog")) == [("1", "CBS"), ("2", "MLZ")]


def test_portal_strict_and_zip_urls(spark, tmp_path):
    p = tmp_path / "r.json"
    resp = {"success": True, "result": {"results": [
        {"name": "a", "type": "dataset", "resources": [{"url": "http://x/a.zip"}, {"url": "http://x/a.pdf"}]},
        {"name": "b", "type": "harvest", "resources": [{"url": "http://x/b.zip"}]}]}}
    p.write_text(json.dumps(resp) + "\n" + json.dumps({"success": False, "result": None}) + "\n")
    responses = spark.read.json(str(p))
    assert rows(resource_urls(portal_datasets(responses, strict=True, skip_failed=True))) == [("a", "http://x/a.zip")]
    assert resource_urls(portal_datasets(responses, skip_failed=True)).count() == 2
    with pytest.raises(Exception, match="without success"):
        portal_datasets(responses).collect()


# --- archives ---------------------------------------------------------------------------------

def test_zip_expand_and_members(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    with zipfile.ZipFile(src / "data (2020).zip", "w") as z:
        z.writestr("sub dir/a-b.csv", "x,y\n1,2\n")
        z.writestr("sub dir/c.xml", "<r/>")
        z.writestr("t%1.txt", "a\n")
    assert clean_member("sub dir/a-b.c.csv") == "sub dir/a_b_c.csv"
    m = expand_archives(spark, str(src), str(tmp_path / "out"))
    got = {r.member: r.path for r in m.collect()}
    assert set(got) == {"sub dir/a-b.csv", "sub dir/c.xml", "t%1.txt"}
    assert got["sub dir/a-b.csv"].endswith("/data _2020_/sub dir/a_b.csv")
    assert os.path.exists(local_path(got["sub dir/a-b.csv"]))
    assert rows(read_delimited(spark, got["sub dir/a-b.csv"])) == [("1", "2")]
    xml_only = list_members(spark, str(src), ".xml")
    assert [r.member for r in xml_only.collect()] == ["sub dir/c.xml"]


def test_sheet_groups_and_per_file_skips(spark, tmp_path):
    (tmp_path / "nabijheid-2014.csv").write_text("gemeente,afstand\nA,1.5\n")
    (tmp_path / "nabijheid-2015.csv").write_text("gemeente,afstand,extra\nkm,km,-\nnotes,,\nB,.,x\n")
    df = read_sheet_export(spark, str(tmp_path), skip_rows={"2015": [1, 2]},
                           types={"afstand": "double"})
    assert rows(df.select("gemeente", "afstand", "extra")) == [("A", 1.5, None), ("B", None, "x")]


def test_layout_round_trip():
    lay = REGISTER_LAYOUTS["praktijk"]
    assert Layout.from_json(lay.to_json()) == Layout(list(lay.names), list(lay.widths), list(lay.date_cols))


def test_flat_mart_title(spark, tmp_path):
    from statmart.sources.dataset import mart_table_name, write_flat_mart
    assert mart_table_name("Bevolking Per Gemeente") == "bevolking_per_gemeente"
    path = write_flat_mart(spark.range(3), str(tmp_path), "Mijn Mart")
    assert path.endswith("/mijn_mart") and spark.read.parquet(path).count() == 3


def test_header_and_skip_rows_with_many_splits(spark, tmp_path):
    """A file cut into many splits: only its first split holds the header and
    the skipped lines; every other line is kept exactly once."""
    body = "".join(f"r{i:05d},{i}\n" for i in range(3000))
    (tmp_path / "big.csv").write_text("name,value\nunits,n\nnote,\n" + body)
    lay = Layout(["name", "value"], [8, 8])
    (tmp_path / "fw").mkdir()
    (tmp_path / "fw" / "big.txt").write_text(
        "name    value   \n" + "".join(f"r{i:05d}  {i:<8d}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        sheet = read_sheet_export(spark, str(tmp_path / "big.csv"), skip_rows=[1, 2],
                                  types={"value": "bigint"})
        assert spark.read.text(str(tmp_path / "big.csv")).rdd.getNumPartitions() > 10
        got = sheet.collect()
        assert len(got) == 3000 and sorted(r.value for r in got) == list(range(3000))
        fw = read_fixed_width(spark, str(tmp_path / "fw"), lay, header=True)
        got = fw.collect()
        assert len(got) == 3000 and {r.name for r in got} == {f"r{i:05d}" for i in range(3000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_zip_flow_to_dataset(spark, tmp_path):
    """Archive → expand → convert by suffix (csv → parquet, txt → NDJSON) →
    dataset with one file-backed table per output (the zipped-file flow)."""
    from statmart.sources.archives import convert_members
    src = tmp_path / "in"
    src.mkdir()
    with zipfile.ZipFile(src / "open-data (2021).zip", "w") as z:
        z.writestr("deel 1/regio.csv", "code,naam\nGM1,Een\nGM2,Twee\n")
        z.writestr("deel 1/vast.txt", "code naam  \nGM1  Een   \nGM3  Drie  \n")
    members = expand_archives(spark, str(src), str(tmp_path / "out"))
    out = convert_members(spark, members, str(tmp_path / "converted"))
    assert sorted((t, f) for t, _, f in out) == [("regio", "parquet"), ("vast", "json")]
    tables = replace_dataset(spark, "zip", "flow_unit", out, location=str(tmp_path / "it's db"))
    assert sorted(tables) == ["zip_flow_unit.regio", "zip_flow_unit.vast"]
    assert rows(spark.table("zip_flow_unit.regio")) == [("GM1", "Een"), ("GM2", "Twee")]
    assert rows(spark.table("zip_flow_unit.vast").select("code", "naam")) == [("GM1", "Een"), ("GM3", "Drie")]
    with pytest.raises(TypeError):  # bad input leaves the dataset as it is
        replace_dataset(spark, "zip", "flow_unit", ["/x/a.parquet", "/x/b.csv"])
    (tmp_path / "broken.parquet").write_text("not a table")
    with pytest.raises(Exception):
        replace_dataset(spark, "zip", "flow_unit", [str(tmp_path / "broken.parquet")])
    assert spark.table("zip_flow_unit.regio").count() == 2


def _zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_archives_of_one_name_and_members_of_other_headers(spark, tmp_path):
    from statmart.sources.archives import convert_members
    _zip(tmp_path / "in" / "a" / "data.zip", {"one.csv": "id,name\n1,x\n", "two+2.csv": "name,amount,id\ny,5,2\n"})
    _zip(tmp_path / "in" / "b" / "data.zip", {"one.csv": "id,name\n3,z\n", "w.txt": "id name\n4  q\n",
                                              "v.txt": "code  id\nAA    5\n", "skip.md": "x"})
    members = expand_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert members.count() == 6 and members.select("path").distinct().count() == 6
    out = convert_members(spark, members, str(tmp_path / "converted"))
    got = {t: rows(spark.read.format(f).load(p).select("id", *(["name"] if t != "b_data_v" else ["code"])))
           for t, p, f in out}
    assert got == {"a_data_one": [("1", "x")], "a_data_two_2": [("2", "y")], "b_data_one": [("3", "z")],
                   "b_data_w": [("4", "q")], "b_data_v": [("5", "AA")]}


def test_colliding_members_raise(spark, tmp_path):
    _zip(tmp_path / "in" / "x.zip", {"a-b.csv": "x\n", "a_b.csv": "y\n"})
    with pytest.raises(ValueError, match="several archive members"):
        expand_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert not (tmp_path / "out" / "x").exists()


def test_skip_rule_matches_the_file_name_only(spark, tmp_path):
    (tmp_path / "2015").mkdir()
    (tmp_path / "2015" / "a+b 2015.csv").write_text("k,v\nunit,n\nA,1\n")
    (tmp_path / "2015" / "c 2016.csv").write_text("v,k\n2,B\n")
    df = read_sheet_export(spark, str(tmp_path / "2015"), skip_rows={"2015": [1]})
    assert rows(df.select("k", "v")) == [("A", "1"), ("B", "2")]


def test_xml_codes_keep_leading_zeros(spark, tmp_path):
    p = tmp_path / "z.xml"
    p.write_text('<r><Num id="0003200000133985"><x>007</x></Num></r>')
    assert rows(read_xml_records(spark, str(p), "Num").select("`@id`", "x")) == [("0003200000133985", "007")]


def test_folder_to_dataset_with_a_bare_name(spark, tmp_path):
    from statmart.sinks.datasets import drop_dataset, replace_dataset_from_folder
    spark.range(3).write.parquet(str(tmp_path / "cbs" / "kwb" / "one.parquet"))
    (tmp_path / "cbs" / "kwb2").mkdir()
    (tmp_path / "cbs" / "kwb2" / "two.json").write_text('{"a": 1}\n')
    (tmp_path / "cbs" / "other").mkdir()
    (tmp_path / "cbs" / "other" / "three.json").write_text('{"a": 1}\n')
    got = replace_dataset_from_folder(spark, str(tmp_path), "cbs/kwb", "bare_unit", location=str(tmp_path / "db"))
    assert sorted(got) == ["bare_unit.one", "bare_unit.two"]
    assert spark.table("bare_unit.one").count() == 3
    drop_dataset(spark, "bare_unit")


def test_skip_rows_beyond_the_first_split(spark, tmp_path):
    body = "".join(f"r{i:05d},{i}\n" for i in range(3000))
    (tmp_path / "s.csv").write_text("name,value\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        # line 2501 holds row 2500, far past the first split
        df = read_sheet_export(spark, str(tmp_path / "s.csv"), skip_rows=[1, 2501],
                               types={"value": "bigint"})
        got = sorted(r.value for r in df.collect())
        assert got == [i for i in range(3000) if i not in (0, 2500)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_xml_records_with_known_prefixes(spark, tmp_path):
    p = tmp_path / "a.xml"
    p.write_text(XML)
    df = read_xml_records(spark, str(p), "Nummeraanduiding", prefixes={"b", "c", "d"})
    assert sorted(df.columns) == ["@id", "adres", "postcode"]


def test_infer_layout_wide_lines(spark, tmp_path):
    """Lines wider than the first pass covers (504 positions) take the second pass."""
    from statmart.sources.fixed_width import infer_spans, read_lines
    head = "a" * 10 + " " * 600 + "b" * 5
    p = tmp_path / "wide.txt"
    p.write_text(head + "\n" + "x" * 3 + " " * 607 + "yy" + "\n")
    assert infer_spans(read_lines(spark, str(p))) == [(1, 10), (611, 5)]
