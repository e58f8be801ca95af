"""Flat datamarts as declarative specs.

A mart is one fact table, a list of dimension joins, filters, an output
projection and optionally a range-bucket partition layout. ``build_mart`` turns
the spec into one DataFrame plan; Catalyst pushes the filters to the scans,
prunes unused columns and turns a left join whose right side is filtered into an
inner join. Expressions are SQL text over the aliases, as in a hand-written
mart, so a spec reads like its SQL.

``REFERENCE_MARTS`` holds the statistical marts (population by postcode, income
by municipality, care use by municipality, district key figures, district
dimension). They run on a dataset loaded with
:func:`statmart.sources.dataset.load_dataset` or any dict of DataFrames named
like ``{id}_TypedDataSet`` / ``{id}_{Dimension}``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart.operators.star import (BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, check_join_type,
                                     join_dimension, max_key_multiplicity, table_sizes)
from statmart.sinks.tables import RangeBuckets


@dataclass(frozen=True)
class Dim:
    alias: str
    table: str
    fact_key: str
    dim_key: str = "Key"
    how: str = "inner"


@dataclass(frozen=True)
class MartSpec:
    name: str
    fact: str
    select: Sequence[tuple[str, str]]          # (output name, SQL expression)
    dims: Sequence[Dim] = ()
    where: Sequence[str] = ()
    order_by: Sequence[str] = ()
    partition: RangeBuckets | None = None
    fact_alias: str = "fct"
    params: Mapping[str, object] = field(default_factory=dict)


def build_mart(spec: MartSpec, tables: Mapping[str, DataFrame],
               params: Mapping[str, object] | None = None, **bounds) -> DataFrame:
    """One DataFrame plan for ``spec`` over ``tables``.

    ``params`` fill ``{name}`` placeholders in the filter and select texts
    (values are inlined as SQL literals).
    """
    values = {**spec.params, **(params or {})}
    fa = spec.fact_alias
    children: dict[str, list[Dim]] = {}
    for d in spec.dims:
        check_join_type(d.how)
        parent = d.fact_key.split(".", 1)[0] if "." in d.fact_key else fa
        children.setdefault(parent, []).append(d)

    def key_of(d: Dim) -> str:
        return d.fact_key if "." in d.fact_key else f"{fa}.{d.fact_key}"

    # Broadcast decisions, proven in at most two small jobs and without running any
    # join: (1) rows and bytes of every dimension's base table; (2) for snowflake
    # children on small bases, the largest number of rows sharing one join-key
    # value. A branch d ⋈ c1 ⋈ … then has at most rows(d) × Π mult(c) rows, with
    # mult(c) = max(1, maxdup(c)) × Π mult(g), none wider than the widest rows together.
    max_rows = bounds.get("max_rows", BROADCAST_MAX_ROWS)
    max_bytes = bounds.get("max_bytes", BROADCAST_MAX_BYTES)
    sizes = dict(zip([d.alias for d in spec.dims], table_sizes([_used(tables[d.table], d, spec) for d in spec.dims])))
    base_ok = {a: z.rows <= max_rows and z.bytes <= max_bytes for a, z in sizes.items()}
    snow = [d for d in spec.dims if "." in d.fact_key and base_ok[d.alias]]
    dups = dict(zip([d.alias for d in snow],
                    max_key_multiplicity([tables[d.table] for d in snow], [d.dim_key for d in snow])))

    def mult(c: Dim) -> float:
        if c.alias not in dups:
            return float("inf")
        m = max(1, dups[c.alias])
        for g in children.get(c.alias, []):
            m *= mult(g)
        return m

    def widest(d: Dim) -> int:
        return sizes[d.alias].widest + sum(widest(c) for c in children.get(d.alias, []))

    def bound_ok(d: Dim) -> bool:
        if not base_ok[d.alias] or not children.get(d.alias):
            return base_ok[d.alias]
        rows = sizes[d.alias].rows
        for c in children[d.alias]:
            rows *= mult(c)
        return rows <= max_rows and rows * widest(d) <= max_bytes

    small = {d.alias: bound_ok(d) for d in spec.dims}

    def branch(d: Dim) -> DataFrame:
        # A snowflake dimension (joined on another dimension's column) is
        # joined to its parent first, so the fact meets each branch once.
        df = tables[d.table].alias(d.alias)
        for c in children.get(d.alias, []):
            df = join_dimension(df, branch(c), (key_of(c), f"{c.alias}.{c.dim_key}"), c.how,
                                broadcast=small[c.alias])
        return df

    out = tables[spec.fact].alias(fa)
    for d in children.get(fa, []):
        out = join_dimension(out, branch(d), (key_of(d), f"{d.alias}.{d.dim_key}"), d.how,
                             broadcast=small[d.alias])
    for w in spec.where:
        out = out.where(F.expr(fill(w, values)))
    cols = [F.expr(fill(e, values)).alias(n) for n, e in spec.select]
    out = out.select(cols)
    if spec.order_by:
        out = out.orderBy(*[F.expr(o) for o in spec.order_by])
    return out


def _used(df: DataFrame, dim: Dim, spec: MartSpec) -> DataFrame:
    """The dimension's columns that the mart reads: those a broadcast would carry."""
    text = " ".join([*(e for _, e in spec.select), *spec.where, *(d.fact_key for d in spec.dims)])
    used = [c for c in df.columns if c == dim.dim_key or re.search(rf"\b{re.escape(dim.alias)}\.`?{re.escape(c)}\b", text)]
    return df.select(*[F.col(f"`{c}`") for c in used])


def fill(text: str, values: Mapping[str, object]) -> str:
    if not values:
        return text
    # only the names that were given are placeholders; other braces belong to the text
    return re.sub("|".join(r"\{%s\}" % re.escape(k) for k in values), lambda m: _literal(values[m[0][1:-1]]), text)


def _literal(v: object) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, (list, tuple)):
        return ", ".join(_literal(x) for x in v)
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, date):
        return f"DATE '{v.isoformat()}'"
    return repr(v)


# --- the statistical marts ---------------------------------------------------
# Dataset ids, subtotal codes and partition ranges of the marts.

POPULATION_PC4 = MartSpec(
    name="bevolking_p4_leeftijd_geslacht",
    fact="83502NED_TypedDataSet",
    dims=[Dim("pc", "83502NED_Postcode", "Postcode", how="left"),
          Dim("gsl", "83502NED_Geslacht", "Geslacht", how="left"),
          Dim("lft", "83502NED_Leeftijd", "Leeftijd", how="left")],
    select=[("jaar", "cast(substr(fct.Perioden, 1, 4) as bigint)"),
            ("pc4", "pc.Title"),
            ("geslacht", "gsl.Title"),
            ("leeftijd", "lft.Title"),
            ("bevolking", "cast(round(fct.Bevolking_1) as bigint)")],
    where=["pc.Key != 'NL01'", "gsl.Key != 'T001038'", "lft.Key != '10000'"],
    partition=RangeBuckets("jaar", 1999, 2030, 1),
)

INCOME_MUNICIPALITY = MartSpec(
    name="inkomen_huishouden_gemeente",
    fact="84639NED_TypedDataSet",
    dims=[Dim("regio", "84639NED_Regio", "Regio"),
          Dim("pop", "84639NED_Populatie", "Populatie"),
          Dim("kvh", "84639NED_KenmerkenVanHuishoudens", "KenmerkenVanHuishoudens")],
    select=[("jaar", "cast(substr(fct.Perioden, 1, 4) as bigint)"),
            ("gemeente_code", "regio.Key"),
            ("gemeente_naam", "regio.Title"),
            ("huishouden_code", "kvh.Key"),
            ("huishouden_omschrijving", "substr(kvh.Title, 7)"),
            ("particuliere_huishoudens_aantal", "fct.ParticuliereHuishoudens_1"),
            ("particuliere_huishoudens_relatief", "fct.ParticuliereHuishoudensRelatief_2"),
            ("inkomen_gestandaardiseerd_gemiddeld", "fct.GemiddeldGestandaardiseerdInkomen_3"),
            ("inkomen_gestandaardiseerd_mediaan", "fct.MediaanGestandaardiseerdInkomen_4"),
            ("inkomen_besteedbaar_gemiddeld", "fct.GemiddeldBesteedbaarInkomen_5"),
            ("inkomen_besteedbaar_mediaan", "fct.MediaanBesteedbaarInkomen_6")]
    + [(f"inkomensgroep_deciel_{i}", f"fct.GestandaardiseerdInkomen{i}e10Groep_{i + 6}")
       for i in range(1, 11)],
    where=["fct.Regio LIKE 'GM%'", "fct.Populatie = '1050010'",
           "kvh.Title LIKE 'Type:%'", "fct.KenmerkenVanHuishoudens != '1050055'"],
    partition=RangeBuckets("jaar", 2011, 2020, 1),
)

CARE_USE_MUNICIPALITY = MartSpec(
    name="gebruik_wmo_pgb_gemeente",
    fact="40060NED_TypedDataSet",
    dims=[Dim("Perioden", "40060NED_Perioden", "Perioden"),
          Dim("Geslacht", "40060NED_Geslacht", "Geslacht"),
          Dim("Leeftijd", "40060NED_Leeftijd", "Leeftijd"),
          Dim("Huishouden", "40060NED_Huishouden", "Huishouden"),
          Dim("Type", "40060NED_TypeMaatwerkvoorziening", "TypeMaatwerkvoorziening"),
          Dim("LeveringsvormZorg", "40060NED_LeveringsvormZorg", "LeveringsvormZorg"),
          Dim("RegioS", "40060NED_RegioS", "RegioS")],
    select=[("jaar", "cast(substr(fct.Perioden, 1, 4) as bigint)"),
            ("gemeente_code", "RegioS.Key"),
            ("gemeente_naam", "RegioS.Title"),
            ("geslacht", "Geslacht.Title"),
            ("leefijd", "Leeftijd.Title"),
            ("huishouden_code", "Huishouden.Key"),
            ("huishouden_omschrijving", "Huishouden.Title"),
            ("voorziening", "Type.Title"),
            ("leveringsvorm", "LeveringsvormZorg.Title"),
            ("gebruik_aantal_personen", "fct.PersonenMetGebruikInJaar_1"),
            ("gebruik_percentage", "fct.PersonenMetGebruikInJaar_2")],
    where=["fct.Perioden LIKE '%JJ%'", "fct.RegioS LIKE 'GM%'",
           "fct.Geslacht != 'T001038'",
           "fct.Leeftijd NOT IN ('20300', '90120', '90200')",
           "fct.Huishouden != 'T001139'",
           "fct.TypeMaatwerkvoorziening != 'T001024'",
           "fct.LeveringsvormZorg != 'T001306'"],
    partition=RangeBuckets("jaar", 2011, 2020, 1),
)

# Fixed values: (output name, topic column) of the district key-figure mart.
DISTRICT_TOPICS = [
    ("aantal_inwoners", "AantalInwoners_5"),
    ("aantal_mannen", "Mannen_6"),
    ("aantal_vrouwen", "Vrouwen_7"),
    ("aantal_0_15_jaar", "k_0Tot15Jaar_8"),
    ("aantal_15_25_jaar", "k_15Tot25Jaar_9"),
    ("aantal_25_45_jaar", "k_25Tot45Jaar_10"),
    ("aantal_45_65_jaar", "k_45Tot65Jaar_11"),
    ("aantal_65_jaar_en_ouder", "k_65JaarOfOuder_12"),
    ("aantal_ongehuwd", "Ongehuwd_13"),
    ("aantal_gehuwd", "Gehuwd_14"),
    ("aantal_gescheiden", "Gescheiden_15"),
    ("aantal_verweduwd", "Verweduwd_16"),
    ("aantal_westers", "WestersTotaal_17"),
    ("aantal_niet_westers", "NietWestersTotaal_18"),
    ("aantal_marokaans", "Marokko_19"),
    ("aantal_antillen", "NederlandseAntillenEnAruba_20"),
    ("aantal_surinaams", "Suriname_21"),
    ("aantal_turks", "Turkije_22"),
    ("aantal_overige_niet_westers", "OverigNietWesters_23"),
    ("aantal_huishoudens", "HuishoudensTotaal_28"),
    ("aantal_eenpersoons_huishoudens", "Eenpersoonshuishoudens_29"),
    ("aantal_huishoudens_zonder_kinderen", "HuishoudensZonderKinderen_30"),
    ("aantal_huishoudens_met_kinderen", "HuishoudensMetKinderen_31"),
    ("aantal_koopwoningen", "Koopwoningen_40"),
    ("aantal_inkomensontvangers", "AantalInkomensontvangers_64"),
    ("gemiddeld_inkomen_per_ontvanger", "GemiddeldInkomenPerInkomensontvanger_65"),
    ("gemiddeld_inkomen_per_inwoner", "GemiddeldInkomenPerInwoner_66"),
    ("aantal_personenautos", "PersonenautoSTotaal_89"),
    ("aantal_personen_bijstand", "PersonenPerSoortUitkeringBijstand_74"),
    ("aantal_personen_ao", "PersonenPerSoortUitkeringAO_75"),
    ("aantal_personen_ww", "PersonenPerSoortUitkeringWW_76"),
    ("aantal_personen_aow", "PersonenPerSoortUitkeringAOW_77"),
]

DISTRICT_KEY_FIGURES = MartSpec(
    name="kerncijfers_wijken_en_buurten",
    fact="84286NED_TypedDataSet",
    dims=[Dim("wkbu", "84286NED_WijkenEnBuurten", "Codering_3")],
    select=[("jaar", "2018"),
            ("gemeente_code", "wkbu.Municipality"),
            ("wijk_code", "regexp_replace(fct.Codering_3, '(?U)^\\\\s+|\\\\s+$', '')")]
    + [(out, f"fct.{src}") for out, src in DISTRICT_TOPICS],
    where=["fct.Codering_3 LIKE 'WK%'"],
    order_by=["gemeente_code", "wijk_code"],
)

DISTRICT_DIMENSION = MartSpec(
    name="dim_wijken_2018",
    fact="84286NED_WijkenEnBuurten",
    fact_alias="kwb",
    select=[("wijk_code", "regexp_replace(kwb.Key, '(?U)^\\\\s+|\\\\s+$', '')"),
            ("wijk_naam", "regexp_replace(kwb.Title, '(?U)^\\\\s+|\\\\s+$', '')")],
    where=["kwb.Key LIKE 'WK%'"],
    order_by=["kwb.Key"],
)

REFERENCE_MARTS = {m.name: m for m in (POPULATION_PC4, INCOME_MUNICIPALITY,
                                       CARE_USE_MUNICIPALITY, DISTRICT_KEY_FIGURES,
                                       DISTRICT_DIMENSION)}


def write_mart(spec: MartSpec, df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the mart's table (K6), range-partitioned when the spec says so (K9)."""
    from statmart.sinks.tables import replace_table, write_range_partitioned
    if spec.partition is not None:
        write_range_partitioned(df, path, spec.partition, mode="overwrite", fmt=fmt)
    else:
        replace_table(df, path, fmt=fmt)
