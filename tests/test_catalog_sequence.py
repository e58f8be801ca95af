import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from statmart.operators.catalog import (batches, distinct_sources, expect_one, ids_by_source,
                                        latest_catalog, needs_refresh)
from statmart.operators.nesting import map_items, nest, unnest
from statmart.operators.runlog import count_failed, failed_runs, first_last_by
from statmart.operators.sequence import sequence_within


def skewed(spark, n=3000):
    # group "hot" holds well over a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("a")).when(F.col("id") < 2200, F.lit("hot"))
         .otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
        ((F.col("id") * 7919) % 100003).alias("o"))


def brute_seq(df):
    w = Window.partitionBy("g").orderBy("o")
    return df.withColumn("seq", F.row_number().over(w) - 1)


def test_sequence_matches_row_number_under_skew(spark):
    df = skewed(spark)
    got = sequence_within(df, ["g"], ["o"])
    assert rows(got.select("g", "o", "seq")) == rows(brute_seq(df).select("g", "o", "seq"))


def test_sequence_with_many_groups_takes_shuffle_path(spark):
    df = skewed(spark)
    got = sequence_within(df, ["g"], ["o"])
    assert rows(got.select("g", "o", "seq")) == rows(brute_seq(df).select("g", "o", "seq"))


def test_sequence_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("x", 5)], "g string, o int")
    assert rows(sequence_within(df, ["g"], ["o"])) == [("x", 5, 0), (None, 1, 0), (None, 2, 1)]


def test_batches_of_ten(spark):
    df = spark.createDataFrame([("s", i) for i in range(25)] + [("t", i) for i in range(10)],
                               "source string, id int")
    got = batches(df, "source", "id", 10).groupBy("source", "batch").count()
    assert rows(got) == [("s", 0, 10), ("s", 1, 10), ("s", 2, 5), ("t", 0, 10)]


CATALOG = [("83502NED", "CBS"), ("84639NED", "cbs"), ("40060NED", "MLZ"),
           ("40060NED", "Jeugdmonitor"), ("80001NED", "mlz"), ("70000NED", "Politie")]


def test_latest_catalog_and_case_merge(spark):
    cat = spark.createDataFrame(CATALOG, "Identifier string, Catalog string")
    latest = {r[0]: r[1] for r in latest_catalog(cat).collect()}
    assert latest["40060NED"] == "MLZ"         # greatest name wins for a repeated id
    grouped = {r.source: r.ids for r in ids_by_source(cat).collect()}
    assert grouped == {"cbs": ["83502NED", "84639NED"], "mlz": ["40060NED", "80001NED"],
                       "politie": ["70000NED"]}
    only = ids_by_source(cat, source="MLZ").collect()
    assert [(r.source, r.ids) for r in only] == [("mlz", ["40060NED", "80001NED"])]
    assert sorted(r[0] for r in distinct_sources(cat, lower=True).collect()) == \
        ["cbs", "jeugdmonitor", "mlz", "politie"]


def test_ids_by_source_parts_are_bounded(spark):
    cat = spark.createDataFrame([(f"{i:05d}", "big") for i in range(23)] + [("x", "small")],
                                "Identifier string, Catalog string")
    parts = ids_by_source(cat, max_ids=10).orderBy("source", "part").collect()
    assert [(r.source, r.part, r.n_ids) for r in parts] == \
        [("big", 0, 10), ("big", 1, 10), ("big", 2, 3), ("small", 0, 1)]
    assert parts[1].ids[0] == "00010"


def test_expect_one(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert expect_one(df.where("k = 2")).collect()[0].v == "b"
    for bad in (df, df.where("k = 3")):
        with pytest.raises(Exception, match="expected exactly one"):
            expect_one(bad).collect()


def test_needs_refresh_null_safe(spark):
    src = spark.createDataFrame([(1, "2020"), (2, None), (3, "2021"), (4, "2021"), (5, None)],
                                "id int, modified string")
    loaded = spark.createDataFrame([(1, "2020"), (2, None), (3, "2020"), (5, "2020")],
                                   "id int, modified string")
    got = rows(needs_refresh(src, loaded))
    assert got == [(3, "2021", "changed"), (4, "2021", "new"), (5, None, "changed")]
    assert needs_refresh(src, loaded, force=True).count() == 5


def test_failed_runs_report(spark):
    runs = spark.createDataFrame([
        (1, "cbs_v3_a", "Failed", "2021-01-02", "2021-01-02"),
        (2, "CBS_V3_b", "Failed", "2021-01-03", "2021-01-03"),     # no error logs
        (3, "cbs_v3_c", "Success", "2021-01-04", "2021-01-04"),
        (4, "other", "Failed", "2021-01-05", "2021-01-05")],
        "run_id int, name string, state string, start_time string, end_time string")
    logs = spark.createDataFrame([
        (1, "ERROR", "t2", "second"), (1, "ERROR", "t1", "first"), (1, "INFO", "t0", "info"),
        (1, "ERROR", "t3", "last"), (4, "ERROR", "t1", "x")],
        "run_id int, level string, timestamp string, message string")
    rep = failed_runs(runs, logs).collect()
    assert [(r.run_id, r.n_errors, r.first_error, r.last_error) for r in rep] == \
        [(2, 0, None, None), (1, 3, "first", "last")]          # newest start first
    assert count_failed(runs).first().n_failed == 2


def test_first_last_by(spark):
    df = spark.createDataFrame([("u", 2, 1, 20.0), ("u", 1, 9, 10.0), ("u", 2, 0, 15.0)],
                               "user string, ts int, id int, value double")
    r = first_last_by(df, ["user"], ["ts", "id"], ["value"]).first()
    assert (r.n_errors, r.first_value, r.last_value) == (3, 10.0, 20.0)


def test_nest_unnest_round_trip_with_big_parent(spark):
    df = skewed(spark, 600).select(F.col("g").alias("parent"), F.col("o").alias("child"))
    nested = nest(df, ["parent"], ["child"], max_items=50)
    assert nested.agg(F.max("n_items")).first()[0] <= 50
    back = unnest(nested, keep=["parent"])
    assert rows(back) == rows(df)
    # parts are consecutive runs of the ordered children
    w = Window.partitionBy("parent").orderBy("child")
    expect = df.withColumn("part", F.floor((F.row_number().over(w) - 1) / 50))
    got = unnest(nested, keep=["parent", "part"])
    assert rows(got.select("parent", "child", "part")) == rows(expect.select("parent", "child", "part"))


def test_map_items(spark):
    df = spark.createDataFrame([(1, 1.4), (1, 2.6)], "k int, q double")
    nested = map_items(nest(df, ["k"], ["q"]), lambda x: F.round(x["q"]).cast("int"))
    assert nested.first().mapped == [1, 3]


def test_catalog_flow_envelope_to_batches(spark, tmp_path):
    """Saved catalog response → one catalog per id → ids to (re)load → batches
    of ten per source (the catalog mirror flow)."""
    import json
    from statmart.sources.json_records import read_envelope
    rows_ = ([{"Identifier": f"A{i:02d}", "Catalog": "CBS", "Modified": "2021-01-01"} for i in range(10)]
             + [{"Identifier": f"B{i:02d}", "Catalog": "Politie" if i % 2 else "politie",
                 "Modified": "2021-01-01"} for i in range(11)]
             + [{"Identifier": "A00", "Catalog": "Another", "Modified": "2021-01-01"}])   # repeated id
    (tmp_path / "catalog.json").write_text(json.dumps({"odata.metadata": "x", "value": rows_}, indent=1))
    cat = read_envelope(spark, str(tmp_path / "catalog.json"), multi_line=True)
    latest = latest_catalog(cat.select("Identifier", "Catalog"))
    assert {r.Identifier: r.Catalog for r in latest.collect()}["A00"] == "CBS"   # greatest name wins
    meta = cat.groupBy("Identifier").agg(F.max("Modified").alias("modified")) \
              .withColumnRenamed("Identifier", "id")
    loaded = spark.createDataFrame([("A01", "2021-01-01"), ("B03", "2020-12-31")], "id string, modified string")
    todo = needs_refresh(meta, loaded)
    keyed = todo.join(latest.withColumnRenamed("Identifier", "id"), "id") \
                .select("id", F.lower("Catalog").alias("source"))
    got = batches(keyed, "source", "id").groupBy("source", "batch").count()
    # CBS: 10 ids, one already loaded → 9; politie (case merged): 11 → 10 + 1
    assert rows(got) == [("cbs", 0, 9), ("politie", 0, 10), ("politie", 1, 1)]


def test_nest_splits_a_large_null_parent(spark):
    df = spark.createDataFrame([(None, i) for i in range(120)] + [("p", 1)], "parent string, child int")
    nested = nest(df, ["parent"], ["child"], max_items=50)
    got = {(r.parent, r.part): r.n_items for r in nested.collect()}
    assert got == {(None, 0): 50, (None, 1): 50, (None, 2): 20, ("p", 0): 1}


def test_expect_one_with_a_map_column(spark):
    df = spark.createDataFrame([(1, {"a": 1})], "k int, m map<string,int>")
    assert expect_one(df).first().m == {"a": 1}


def test_sequence_with_a_hot_group_of_equal_keys(spark):
    """A third of the rows share group and order value: positions are still a
    gap-free 0..n-1 per group."""
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string")))
         .alias("g"),
        F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id")).alias("o"))
    got = sequence_within(df, ["g"], ["o"]).groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("seq").alias("d"), F.min("seq").alias("lo"),
        F.max("seq").alias("hi"))
    for r in got.collect():
        assert (r.d, r.lo, r.hi) == (r.n, 0, r.n - 1)


def test_sequence_over_many_tasks_and_copies(spark):
    """Keys over many partitions, a third of all rows copies of one, nulls in group and order, a map column."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 900).alias("o"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise((F.col("id") % 2).cast("string")).alias("v"),
        F.create_map(F.lit("k"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 4)).alias("m"))
    out = sequence_within(df, ["g"], ["o"], keys_per_task=150)
    assert out.columns == ["g", "o", "v", "m", "seq"]
    got = sorted(((r.g, r.seq, r.o, r.v, r.m["k"]) for r in out.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    want = {}
    for r in df.collect():
        want.setdefault(r.g, []).append((r.o, r.v, r.m["k"]))
    for g, held in want.items():
        mine = [r for r in got if r[0] == g]
        assert [r[1] for r in mine] == list(range(len(held)))
        assert [r[2] for r in mine] == sorted((o for o, _, _ in held), key=lambda o: (o is not None, o or 0))
        assert sorted((r[2:] for r in mine), key=str) == sorted(held, key=str)


def test_sequence_stores_keys_only(spark):
    """What is written to the shared folder has no column but the keys; partitions follow the number of keys."""
    import glob
    import pyarrow.parquet as pq
    from statmart.session import local_path, shared_root
    root = local_path(shared_root(spark))
    before = set(glob.glob(f"{root}/statmart/seq*"))
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id", F.repeat(F.lit("wide"), 50).alias("payload"))
    assert sequence_within(df, ["g"], ["id"], keys_per_task=100).count() == 1000
    new = sorted(set(glob.glob(f"{root}/statmart/seq*")) - before)
    assert len(new) == 2
    for folder in new:
        names = pq.read_table(folder).column_names
        assert "payload" not in names and {"__h1", "__h2", "__n"} <= set(names)
    assert len({r["__pid"] for r in spark.read.parquet([f for f in new if "ranks" in f][0]).collect()}) == 10
    empty = sequence_within(df.limit(0), ["g"], ["id"])
    assert empty.count() == 0 and empty.columns == ["g", "id", "payload", "seq"]
