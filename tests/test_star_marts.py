import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from statmart.operators.star import (bounded_broadcast, check_join_type, flatten, join_dimension,
                                     split_properties)
from statmart.plans.marts import REFERENCE_MARTS, build_mart
from statmart.plans.sql import run_mart_sql, run_sql


def kt(spark, pairs, extra=None):
    if extra:
        return spark.createDataFrame(pairs, "Key string, Title string, " + extra)
    return spark.createDataFrame(pairs, "Key string, Title string")


@pytest.fixture()
def population(spark):
    fact = spark.createDataFrame([
        ("2018JJ00", "1011", "T001038", "10000", 100.5),   # total sex, total age → dropped
        ("2018JJ00", "1011", "3000", "70100", 10.5),
        ("2019JJ00", "1011", "4000", "70100", 11.49),
        ("2019JJ00", "NL01", "4000", "70100", 999.0),       # national total → dropped
        ("2020JJ00", "9999", "4000", "70100", 5.0),         # unknown postcode → dropped
        ("2020JJ00", "1012", "4000", "70200", -2.5),
    ], "Perioden string, Postcode string, Geslacht string, Leeftijd string, Bevolking_1 double")
    return {
        "83502NED_TypedDataSet": fact,
        "83502NED_Postcode": kt(spark, [("NL01", "Nederland"), ("1011", "1011"), ("1012", "1012")]),
        "83502NED_Geslacht": kt(spark, [("T001038", "Totaal"), ("3000", "Mannen"), ("4000", "Vrouwen")]),
        "83502NED_Leeftijd": kt(spark, [("10000", "Totaal"), ("70100", "0 tot 5 jaar"),
                                        ("70200", "5 tot 10 jaar")]),
    }


EXPECTED_POPULATION = [
    (2018, "1011", "Mannen", "0 tot 5 jaar", 11),
    (2019, "1011", "Vrouwen", "0 tot 5 jaar", 11),
    (2020, "1012", "Vrouwen", "5 tot 10 jaar", -3),
]


def test_population_mart(spark, population):
    df = build_mart(REFERENCE_MARTS["bevolking_p4_leeftijd_geslacht"], population)
    assert df.columns == ["jaar", "pc4", "geslacht", "leeftijd", "bevolking"]
    assert rows(df) == EXPECTED_POPULATION
    plan = plan_text(df)
    # the right-side filters turn the left joins into inner broadcast joins
    assert "LeftOuter" not in plan and "BroadcastHashJoin" in plan


def test_population_mart_as_bound_sql(spark, population):
    df = run_mart_sql(spark, REFERENCE_MARTS["bevolking_p4_leeftijd_geslacht"], population)
    assert rows(df) == EXPECTED_POPULATION


def test_income_mart(spark, tmp_path):
    topics = {f"GestandaardiseerdInkomen{i}e10Groep_{i + 6}": float(i) for i in range(1, 11)}
    base = {"ParticuliereHuishoudens_1": 1.0, "ParticuliereHuishoudensRelatief_2": 2.0,
            "GemiddeldGestandaardiseerdInkomen_3": 3.0, "MediaanGestandaardiseerdInkomen_4": 4.0,
            "GemiddeldBesteedbaarInkomen_5": 5.0, "MediaanBesteedbaarInkomen_6": 6.0, **topics}
    cols = ["Perioden", "Regio", "Populatie", "KenmerkenVanHuishoudens"] + list(base)
    data = [("2019JJ00", "GM0363", "1050010", "1050015"),
            ("2019JJ00", "GM0363", "1050010", "1050055"),     # subtotal → dropped
            ("2019JJ00", "PV27", "1050010", "1050015"),       # province → dropped
            ("2019JJ00", "GM0363", "1050011", "1050015"),     # other population → dropped
            ("2019JJ00", "GM0363", "1050010", "1010000")]     # title not 'Type:%' → dropped
    fact = spark.createDataFrame([d + tuple(base.values()) for d in data],
                                 ", ".join(f"{c} string" if i < 4 else f"{c} double"
                                           for i, c in enumerate(cols)))
    fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    t = {"84639NED_TypedDataSet": fact,
         "84639NED_Regio": kt(spark, [("GM0363", "Amsterdam"), ("PV27", "Noord-Holland")]),
         "84639NED_Populatie": kt(spark, [("1050010", "incl. studenten"), ("1050011", "excl.")]),
         "84639NED_KenmerkenVanHuishoudens": kt(spark, [("1050015", "Type: Eenpersoonshuishouden"),
                                                        ("1050055", "Type: Paar, totaal"),
                                                        ("1010000", "Totaal")])}
    df = build_mart(REFERENCE_MARTS["inkomen_huishouden_gemeente"], t)
    got = df.collect()
    assert len(got) == 1
    r = got[0]
    assert (r.jaar, r.gemeente_code, r.gemeente_naam, r.huishouden_omschrijving) == \
        (2019, "GM0363", "Amsterdam", "Eenpersoonshuishouden")
    assert r.inkomensgroep_deciel_10 == 10.0
    # the prefix filter on the fact key reaches the parquet scan
    assert "StringStartsWith(Regio,GM)" in plan_text(df)


def test_care_use_mart_not_in_and_like(spark):
    fact = spark.createDataFrame([
        ("2019JJ00", "1100", "52020", "1050", "2040", "2050", "GM0014", 5.0, 0.1),
        ("2019JJ00", "1100", "20300", "1050", "2040", "2050", "GM0014", 6.0, 0.2),   # NOT IN
        ("2019KW01", "1100", "52020", "1050", "2040", "2050", "GM0014", 7.0, 0.3),   # not JJ
        ("2019JJ00", "1100", "52020", "1050", "2040", "2050", "NL01", 8.0, 0.4),     # not GM
    ], "Perioden string, Geslacht string, Leeftijd string, Huishouden string, "
       "TypeMaatwerkvoorziening string, LeveringsvormZorg string, RegioS string, "
       "PersonenMetGebruikInJaar_1 double, PersonenMetGebruikInJaar_2 double")
    t = {"40060NED_TypedDataSet": fact,
         "40060NED_Perioden": kt(spark, [("2019JJ00", "2019"), ("2019KW01", "2019 1e kw")]),
         "40060NED_Geslacht": kt(spark, [("1100", "Totaal")]),
         "40060NED_Leeftijd": kt(spark, [("52020", "0-18"), ("20300", "Totaal")]),
         "40060NED_Huishouden": kt(spark, [("1050", "Alleenstaand")]),
         "40060NED_TypeMaatwerkvoorziening": kt(spark, [("2040", "Hulp")]),
         "40060NED_LeveringsvormZorg": kt(spark, [("2050", "PGB")]),
         "40060NED_RegioS": kt(spark, [("GM0014", "Groningen"), ("NL01", "Nederland")])}
    df = build_mart(REFERENCE_MARTS["gebruik_wmo_pgb_gemeente"], t)
    assert [(r.jaar, r.gemeente_code, r.leefijd, r.gebruik_aantal_personen) for r in df.collect()] == \
        [(2019, "GM0014", "0-18", 5.0)]


def test_district_marts_trim_and_order(spark):
    from statmart.plans.marts import DISTRICT_TOPICS
    dim = kt(spark, [("WK036300  ", "\tBurgwallen ", "GM0363"), ("BU03630000", "x", "GM0363"),
                     ("WK001400", "Centrum", "GM0014")], "Municipality string")
    cols = ["Codering_3"] + [src for _, src in DISTRICT_TOPICS]
    fact = spark.createDataFrame(
        [("WK036300  ",) + tuple(float(i) for i in range(len(DISTRICT_TOPICS))),
         ("WK001400",) + tuple(1.0 for _ in DISTRICT_TOPICS),
         ("BU03630000",) + tuple(2.0 for _ in DISTRICT_TOPICS)],
        ", ".join(f"{c} string" if i == 0 else f"{c} double" for i, c in enumerate(cols)))
    t = {"84286NED_TypedDataSet": fact, "84286NED_WijkenEnBuurten": dim}
    df = build_mart(REFERENCE_MARTS["kerncijfers_wijken_en_buurten"], t)
    got = [(r.jaar, r.gemeente_code, r.wijk_code) for r in df.collect()]
    assert got == [(2018, "GM0014", "WK001400"), (2018, "GM0363", "WK036300")]
    dims = build_mart(REFERENCE_MARTS["dim_wijken_2018"], t)
    assert [tuple(r) for r in dims.collect()] == [("WK001400", "Centrum"), ("WK036300", "Burgwallen")]


PROPS = [("Geslacht", "Geslacht", "Dimension"), ("Leeftijd", "Leeftijd groep", "Dimension"),
         ("Perioden", "Perioden", "TimeDimension"), ("Regio", "Regio's", "GeoDimension"),
         ("Bevolking_1", "Bevolking (aantal)", "Topic"), ("Aandeel_2", "Aandeel %", "Topic")]


@pytest.fixture()
def dataset(spark):
    fact = spark.createDataFrame([
        ("M", "A1", "2018JJ00", "GM1", 10.0, 0.5),
        ("V", "A1", "2018JJ00", "GM1", 12.0, 0.6),
        ("X", "A2", "2018JJ00", "GM1", 1.0, 0.1),    # sex code missing in the dimension
    ], "Geslacht string, Leeftijd string, Perioden string, Regio string, Bevolking_1 double, Aandeel_2 double")
    dims = {"Geslacht": kt(spark, [("M", "Mannen"), ("V", "Vrouwen"), ("T", "Totaal")]),
            "Leeftijd": kt(spark, [("A1", "0-10"), ("A2", "10-20")]),
            "Perioden": kt(spark, [("2018JJ00", "2018")]),
            "Regio": kt(spark, [("GM1", "Gemeente 1")])}
    props = spark.createDataFrame(PROPS, "Key string, Title string, Type string")
    return fact, dims, props


def test_split_properties(spark, dataset):
    meta = split_properties(dataset[2])
    assert meta["Dimension"] == [("Geslacht", "Geslacht"), ("Leeftijd", "Leeftijd groep")]
    assert meta["TimeDimension"] == [("Perioden", "Perioden")]
    assert meta["Topic"] == [("Aandeel_2", "Aandeel %"), ("Bevolking_1", "Bevolking (aantal)")]


def test_flatten_inner(spark, dataset):
    fact, dims, props = dataset
    df = flatten(fact, dims, props)
    assert df.columns == ["geslacht_code", "geslacht", "leeftijd_groep_code", "leeftijd_groep",
                          "aandeel_per", "bevolking_aantal"]
    assert rows(df) == [("M", "Mannen", "A1", "0-10", 0.5, 10.0), ("V", "Vrouwen", "A1", "0-10", 0.6, 12.0)]


@pytest.mark.parametrize("how,n", [("LEFT", 3), ("right", 3), ("Full", 4), ("inner", 2)])
def test_flatten_join_types(spark, dataset, how, n):
    fact, dims, props = dataset
    df = flatten(fact, dims, props, how=how)
    assert df.count() == n


def test_flatten_kinds_and_errors(spark, dataset):
    fact, dims, props = dataset
    df = flatten(fact, dims, props, kinds=("Dimension", "TimeDimension", "GeoDimension"))
    assert {"perioden_code", "regio's_code"} <= set(df.columns)
    with pytest.raises(ValueError):
        flatten(fact, dims, props, how="cross")
    dup = props.union(props.limit(1).withColumn("Key", F.lit("Other")))
    with pytest.raises(ValueError, match="duplicate"):
        flatten(fact.withColumn("Other", F.col("Geslacht")), {**dims, "Other": dims["Geslacht"]}, dup)
    topics_only = props.where(F.col("Type") == "Topic")
    assert flatten(fact, dims, topics_only).columns == ["aandeel_per", "bevolking_aantal"]


def test_check_join_type():
    assert check_join_type("Inner") == "inner"
    for bad in ("cross", "semi", "", None):
        with pytest.raises(ValueError):
            check_join_type(bad)


def test_duplicate_dimension_keys_multiply_rows(spark):
    fact = spark.createDataFrame([("a", 1.0)], "k string, v double")
    dim = kt(spark, [("a", "x"), ("a", "y")])
    assert join_dimension(fact, dim, ("k", "Key")).count() == 2


def test_broadcast_only_when_bounded(spark):
    fact = spark.range(1000).withColumn("k", F.col("id") % 10)
    dim = spark.range(10).withColumnRenamed("id", "dk")
    small = fact.join(bounded_broadcast(dim, max_rows=100), F.col("k") == F.col("dk"))
    assert "BroadcastHashJoin" in plan_text(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = fact.join(bounded_broadcast(dim, max_rows=5), F.col("k") == F.col("dk"))
        assert "BroadcastHashJoin" not in plan_text(big)
        assert big.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["right", "full", "left", "inner"])
@pytest.mark.parametrize("n_dims", [1, 2, 3])
def test_flatten_outer_chains_match_sql(spark, how, n_dims):
    """Random fact with keys missing on both sides, null keys and duplicate
    dimension keys; flatten must equal the plain SQL join chain."""
    import random
    rnd = random.Random(n_dims * 7 + len(how))
    names = ["A", "B", "C"][:n_dims]
    fact_rows = [tuple([rnd.choice(["1", "2", "3", "4", None]) for _ in names]) + (float(i),)
                 for i in range(40)]
    fact = spark.createDataFrame(fact_rows, ", ".join(f"{n} string" for n in names) + ", T_1 double")
    dims = {}
    for n in names:
        keys = rnd.sample(["2", "3", "4", "5", "6"], 3) + ["3", None]     # duplicate and null keys
        dims[n] = spark.createDataFrame([(k, f"{n}{i}") for i, k in enumerate(keys)], "Key string, Title string")
    props = spark.createDataFrame([(n, f"dim {n}", "Dimension") for n in names] + [("T_1", "Total", "Topic")],
                                  "Key string, Title string, Type string")
    got = flatten(fact, dims, props, how=how)
    fact.createOrReplaceTempView("ofct")
    for n in names:
        dims[n].createOrReplaceTempView(f"odim_{n}")
    cols = ", ".join(f"{n}.Key AS dim_{n.lower()}_code, {n}.Title AS dim_{n.lower()}" for n in names)
    joins = " ".join(f"{how.upper()} JOIN odim_{n} AS {n} ON {n}.Key = fct.{n}" for n in names)
    want = spark.sql(f"SELECT {cols}, fct.T_1 AS total FROM ofct AS fct {joins}")
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.select(*sorted(got.columns))) == rows(want.select(*sorted(want.columns)))


def test_snowflake_broadcast_proof_uses_key_multiplicity(spark):
    from statmart.operators.star import max_key_multiplicity
    from statmart.plans.marts import Dim, MartSpec
    fact = spark.createDataFrame([(i, i % 5) for i in range(100)], "f_id int, o_key int")
    orders = spark.createDataFrame([(k, k % 2) for k in range(5)], "o_key int, c_key int")
    uniq = spark.createDataFrame([(0, "a"), (1, "b")], "c_key int, name string")
    dup = spark.createDataFrame([(0, "a"), (0, "a2"), (0, "a3"), (1, "b")], "c_key int, name string")
    assert max_key_multiplicity([uniq, dup], ["c_key", "c_key"]) == [1, 3]
    spec = MartSpec(name="t", fact="f", dims=[Dim("o", "o", "o_key", "o_key"), Dim("c", "c", "o.c_key", "c_key")],
                    select=[("f_id", "fct.f_id"), ("name", "c.name")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        # 5 orders × multiplicity 1 = 5 rows ≤ 8: the whole branch is broadcast
        small = build_mart(spec, {"f": fact, "o": orders, "c": uniq}, max_rows=8)
        assert "SortMergeJoin" not in plan_text(small)
        # 5 orders × multiplicity 3 = 15 rows > 8: the branch is not broadcast
        big = build_mart(spec, {"f": fact, "o": orders, "c": dup}, max_rows=8)
        assert "SortMergeJoin" in plan_text(big)
        assert big.count() == 60 * 3 + 40 and small.count() == 100   # 3 names for c_key 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_broadcast_proof_counts_real_bytes(spark):
    from statmart.operators.star import fits_broadcast, table_sizes
    wide = spark.range(200).select(F.col("id"), F.repeat(F.lit("é"), 1000).alias("title"),
                                   F.array(F.lit("x" * 50)).alias("nested"))
    size = table_sizes([wide])[0]
    assert size.rows == 200 and size.bytes > 200 * 2050 and size.widest > 2050
    assert not fits_broadcast(wide, max_bytes=200 * 200) and fits_broadcast(wide, max_bytes=10**6)
    assert not fits_broadcast(wide, max_rows=199)


def test_mart_build_runs_two_jobs_at_most(spark):
    from statmart.plans.suite import INNER_STAR, load
    tables = load(spark, "/root/testdata/sf0.001", "lineitem", "orders", "customer", "nation", "region")
    calls = []
    original = type(tables["orders"]).collect
    try:
        type(tables["orders"]).collect = lambda self: calls.append(1) or original(self)
        build_mart(INNER_STAR, tables)
    finally:
        type(tables["orders"]).collect = original
    assert len(calls) <= 2


def test_fill_leaves_other_braces(spark):
    from statmart.plans.marts import fill
    assert fill("x rlike 'a{2}' and d > {day} and s = {none}", {"day": __import__("datetime").date(2020, 1, 2), "none": None}) \
        == "x rlike 'a{2}' and d > DATE '2020-01-02' and s = NULL"
