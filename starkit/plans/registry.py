"""The vehicle-registry / municipality warehouse, built from the operators.

Input: the raw layer (all-string parquet, one dataset per source, the
municipality area files as a yearly family).  Output: staging (lazy),
warehouse (dims, bridge, facts), marts, and the data-quality suite.

Every model is a function of DataFrames; ``build`` wires them, materialises
the warehouse and mart layers in a run folder under the shared checkpoint
location, and evaluates the checks.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.operators import checks as chk
from starkit.operators import quality as dq
from starkit.operators.calendar import calendar_dim, year_bounds
from starkit.operators.dims import (
    UNKNOWN_KEY,
    bridge,
    lookup_attribute,
    scd2_from_snapshots,
    type1_dim,
    type1_from_values,
    with_unknown,
)
from starkit.operators.facts import coverage_floor, lookup, temporal_lookup
from starkit.operators.marts import compare_shares, rank_within, restate_series
from starkit.operators.staging import Spec, classify, decode, dedup, long_to_wide, typed_projection
from starkit.sources.landing import read_family, source
from starkit.functions.casts import numeric_text_to_int

# ---------------------------------------------------------------------------
# Fixed values (must equal the source warehouse): dataset names, measure
# codes, labels, classification lists and the calendar range.
# ---------------------------------------------------------------------------
RDW, CBS = "rdw", "cbs"
VEHICLES, FUEL, DEFECTS_FOUND, DEFECT_CODES = (
    "gekentekende_voertuigen", "brandstof", "geconstateerde_gebreken", "gebreken")
FLEET = "70072ned_motorvoertuigen_gemeente"
AREAS_GLOB = "cbs_gebieden_[0-9][0-9][0-9][0-9].parquet"
AREA_YEAR_PATTERN = r"gebieden_(\d{4})\.parquet"
AREA_MEASURES = {"GM000C_1": "gemeente_naam", "AM0002": "agglomeratie_naam", "AR0002": "arbeidsmarktregio"}
FLEET_MEASURES = {
    "A018943_1": "Personenauto",
    "A018930": "Bedrijfsmotorvoertuig",
    "A018944_1": "Motorfiets",
    "A018934_1": "Bromfiets",
}
MUNICIPALITY_PREFIX = "GM"
FUEL_CLASSES = {
    "Fossiel": ["Benzine", "Diesel", "LPG", "CNG", "LNG"],
    "Emissievrij": ["Elektriciteit", "Waterstof"],
    "Biobrandstof": ["Alcohol"],
}
VEHICLE_TO_FLEET_CLASS = {
    "Personenauto": ["Personenauto"],
    "Bedrijfsmotorvoertuig": ["Bedrijfsauto", "Bus"],
    "Motorfiets": ["Motorfiets", "Motorfiets met zijspan"],
    "Bromfiets": ["Bromfiets"],
    "(niet vergelijkbaar)": [
        "Aanhangwagen", "Middenasaanhangwagen", "Oplegger", "Autonome aanhangwagen",
        "Driewielig motorrijtuig", "Land- of bosbouwtrekker", "Motorrijtuig met beperkte snelheid",
    ],
}
NOT_COMPARABLE = "(niet vergelijkbaar)"
CALENDAR_FIRST_YEAR, CALENDAR_LAST_YEAR = 1990, 2029
UNKNOWN_CODE = "(onbekend)"
OPEN_END = _dt.date(9999, 12, 31)
UNKNOWN_DATE = _dt.date(1900, 1, 1)

VEHICLE_SPECS = [
    Spec("kenteken"), Spec("voertuigsoort"), Spec("merk"), Spec("handelsbenaming"), Spec("inrichting"),
    Spec("eerste_kleur"), Spec("tweede_kleur"), Spec("europese_voertuigcategorie"),
    Spec("aantal_zitplaatsen", "int"), Spec("aantal_deuren", "int"), Spec("aantal_wielen", "int"),
    Spec("aantal_cilinders", "int"), Spec("cilinderinhoud", "int"), Spec("massa_ledig_voertuig", "int"),
    Spec("massa_rijklaar", "int"), Spec("toegestane_maximum_massa_voertuig", "int", "toegestane_maximum_massa"),
    Spec("maximale_constructiesnelheid", "int"), Spec("catalogusprijs", "int"), Spec("bruto_bpm", "int"),
    Spec("datum_eerste_toelating_dt", "date", "datum_eerste_toelating"),
    Spec("datum_tenaamstelling_dt", "date", "datum_tenaamstelling"),
    Spec("vervaldatum_apk_dt", "date", "vervaldatum_apk"),
    Spec("datum_eerste_tenaamstelling_in_nederland_dt", "date", "datum_eerste_tenaamstelling_nl"),
    Spec("export_indicator", "indicator", "is_geexporteerd"),
    Spec("tenaamstellen_mogelijk", "indicator", "is_tenaamstellen_mogelijk"),
    Spec("taxi_indicator", "indicator", "is_taxi"),
    Spec("openstaande_terugroepactie_indicator", "indicator", "heeft_openstaande_terugroepactie"),
    Spec("wam_verzekerd", "string", "wam_verzekerd_status"),
]
FUEL_SPECS = [
    Spec("kenteken"), Spec("brandstof_volgnummer", "int"), Spec("brandstof_omschrijving"),
    Spec("brandstofverbruik_gecombineerd", "double"), Spec("co2_uitstoot_gecombineerd", "double"),
    Spec("co2_uitstoot_gewogen", "double"), Spec("nettomaximumvermogen", "double"),
    Spec("geluidsniveau_rijdend", "int"), Spec("geluidsniveau_stationair", "int"),
    Spec("emissiecode_omschrijving"), Spec("uitlaatemissieniveau"), Spec("milieuklasse_eg_goedkeuring_licht"),
]
DEFECT_CODE_SPECS = [
    Spec("gebrek_identificatie"), Spec("gebrek_omschrijving"), Spec("gebrek_artikel_nummer"),
    Spec("gebrek_paragraaf_nummer"), Spec("ingangsdatum_gebrek_dt", "date", "ingangsdatum_gebrek"),
    Spec("einddatum_gebrek_dt", "date", "einddatum_gebrek"),
]

DEFECT_FOUND_COLUMNS = ["kenteken", "meld_datum_door_keuringsinstantie_dt", "meld_tijd_door_keuringsinstantie", "gebrek_identificatie",
                        "soort_erkenning_omschrijving", "aantal_gebreken_geconstateerd"]
FLEET_COLUMNS = ["RegioS", "Perioden", "Measure", "Value"]


# ---------------------------------------------------------------- raw sources

def raw_sources(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """The raw layer under ``raw_dir`` (swappable: full snapshot or fixtures).
    The schema is declared, all text: the columns that staging needs, which are
    null where a file lacks them, and whatever else the files have."""
    def needed(specs: list[Spec]) -> list[str]:
        return [s.src for s in specs]

    return {
        "voertuigen": source(spark, raw_dir, RDW, VEHICLES, at_least=needed(VEHICLE_SPECS)),
        "brandstof": source(spark, raw_dir, RDW, FUEL, at_least=needed(FUEL_SPECS)),
        "gebrek_constateringen": source(spark, raw_dir, RDW, DEFECTS_FOUND, at_least=DEFECT_FOUND_COLUMNS),
        "gebreken": source(spark, raw_dir, RDW, DEFECT_CODES, at_least=needed(DEFECT_CODE_SPECS)),
        "voertuigpark": source(spark, raw_dir, CBS, FLEET, at_least=FLEET_COLUMNS),
        "gebieden": read_family(spark, f"{raw_dir.rstrip('/')}/{AREAS_GLOB}"),
    }


# ---------------------------------------------------------------- staging (lazy)

def stg_voertuigen(raw: DataFrame) -> DataFrame:
    return typed_projection(raw, VEHICLE_SPECS)


def stg_brandstof(raw: DataFrame) -> DataFrame:
    return typed_projection(raw, FUEL_SPECS)


def stg_gebrek_constateringen(raw: DataFrame) -> DataFrame:
    """Typed, 3-character times left-padded, one row per plate x date x time
    x defect (the source has a fully duplicated row)."""
    typed = raw.select(
        "kenteken",
        F.col("meld_datum_door_keuringsinstantie_dt").cast("date").alias("meld_datum"),
        F.lpad("meld_tijd_door_keuringsinstantie", 4, "0").alias("meld_tijd"),
        "gebrek_identificatie",
        F.col("soort_erkenning_keuringsinstantie").alias("soort_erkenning_code"),
        "soort_erkenning_omschrijving",
        F.col("aantal_gebreken_geconstateerd").cast("int").alias("aantal_gebreken_keuring"),
    )
    return dedup(typed, ["kenteken", "meld_datum", "meld_tijd", "gebrek_identificatie"],
                 ["soort_erkenning_code"])


def stg_gebreken(raw: DataFrame) -> DataFrame:
    return typed_projection(raw, DEFECT_CODE_SPECS)


def stg_gemeenten(raw_areas: DataFrame) -> DataFrame:
    """Yearly area files -> one row per year x code with name, agglomeration,
    labour-market region (values trimmed: the source pads them)."""
    bron = raw_areas.select(
        F.regexp_extract("source_file", AREA_YEAR_PATTERN, 1).cast("int").alias("peiljaar"),
        F.col("regios").alias("gemeente_code"), F.col("measure"),
        F.trim(F.col("stringvalue")).alias("waarde"))
    return long_to_wide(bron, ["peiljaar", "gemeente_code"], "measure", "waarde", AREA_MEASURES)


def stg_voertuigpark_gemeente(raw: DataFrame) -> DataFrame:
    """Municipality x year x vehicle kind; the filter is on raw text so it
    reaches the parquet scan."""
    bron = raw.where(F.col("regios").startswith(MUNICIPALITY_PREFIX)
                     & F.col("measure").isin(list(FLEET_MEASURES)) & F.col("value").isNotNull())
    return bron.select(
        F.col("regios").alias("gemeente_code"),
        F.left(F.col("perioden"), F.lit(4)).cast("int").alias("peiljaar"),
        decode("measure", FLEET_MEASURES).alias("voertuigsoort"),
        numeric_text_to_int("value").alias("aantal"))


# ---------------------------------------------------------------- warehouse

def dim_datum(spark: SparkSession) -> DataFrame:
    return calendar_dim(year_bounds(spark, CALENDAR_FIRST_YEAR, CALENDAR_LAST_YEAR))


def dim_gemeente(stg_gem: DataFrame) -> DataFrame:
    v = scd2_from_snapshots(stg_gem, "gemeente_code", "peiljaar", tracked=["gemeente_naam"],
                            carried=["agglomeratie_naam", "arbeidsmarktregio"], key_col="gemeente_key",
                            version_col="versienummer", from_col="geldig_van", to_col="geldig_tot",
                            current_col="is_actueel")
    v = v.select("gemeente_key", "gemeente_code", "gemeente_naam", "agglomeratie_naam", "arbeidsmarktregio",
                 "versienummer", "geldig_van", "geldig_tot", "is_actueel")
    return with_unknown(v, {"gemeente_key": UNKNOWN_KEY, "gemeente_code": UNKNOWN_CODE,
                            "gemeente_naam": "Onbekende gemeente", "versienummer": 1,
                            "geldig_van": UNKNOWN_DATE, "geldig_tot": OPEN_END, "is_actueel": False})


def dim_voertuig(stg_vt: DataFrame, stg_bs: DataFrame) -> DataFrame:
    base = lookup_attribute(stg_vt, stg_bs, "kenteken", {"hoofdbrandstof": "brandstof_omschrijving"},
                            child_filter=F.col("brandstof_volgnummer") == 1)
    return type1_dim(base, ["kenteken"], "voertuig_key", [
        "kenteken", F.upper(F.trim("merk")).alias("merk"),
        F.upper(F.trim("handelsbenaming")).alias("handelsbenaming"), "voertuigsoort", "inrichting",
        "eerste_kleur", "catalogusprijs", "massa_ledig_voertuig", "datum_eerste_toelating", "hoofdbrandstof",
    ], {"kenteken": UNKNOWN_CODE, "merk": "ONBEKEND", "handelsbenaming": "ONBEKEND", "voertuigsoort": "Onbekend"})


def dim_brandstof(stg_bs: DataFrame) -> DataFrame:
    return type1_from_values(stg_bs, "brandstof_omschrijving", "brandstof_key", FUEL_CLASSES,
                             "energiedrager", unknown_value=UNKNOWN_CODE)


def dim_gebrek(stg_gb: DataFrame) -> DataFrame:
    return type1_dim(stg_gb, ["gebrek_identificatie"], "gebrek_key", [
        "gebrek_identificatie", "gebrek_omschrijving", "gebrek_artikel_nummer", "gebrek_paragraaf_nummer",
        "ingangsdatum_gebrek", "einddatum_gebrek", F.col("einddatum_gebrek").isNull().alias("is_actueel"),
    ], {"gebrek_identificatie": UNKNOWN_CODE, "gebrek_omschrijving": "Onbekend gebrek", "is_actueel": False})


def bridge_voertuig_brandstof(stg_bs: DataFrame) -> DataFrame:
    return bridge(stg_bs, ["kenteken"], ["brandstof_omschrijving"], "brandstof_volgnummer",
                  "voertuig_key", "brandstof_key", seq_alias="volgnummer", main_col="is_hoofdbrandstof",
                  carry=["kenteken"])


def fct_gebrek_constatering(stg_gc: DataFrame, d_datum: DataFrame, d_voertuig: DataFrame,
                            d_gebrek: DataFrame) -> DataFrame:
    """Transaction fact: one row per defect found; the per-inspection total
    of the source is non-additive and dropped; measure is a constant 1.
    The calendar and the defect-code list, once counted, are broadcast; the
    vehicle dimension is plate-sized and left to a sort-merge join / AQE."""
    f = lookup(stg_gc, d_datum, "meld_datum", "datum", "datum_key", out_col="meld_datum_key",
               unknown=-1, bounded_dim=True)
    grain = ["kenteken", "meld_datum", "meld_tijd", "gebrek_identificatie"]
    f = lookup(f, d_voertuig, "kenteken", "kenteken", "voertuig_key", grain=grain)
    # the defect codes are a reference list (about a thousand codes): counted, then broadcast
    f = lookup(f, d_gebrek, "gebrek_identificatie", "gebrek_identificatie", "gebrek_key", bounded_dim="counted", grain=grain)
    return f.select("meld_datum_key", "voertuig_key", "gebrek_key", "kenteken", "meld_datum", "meld_tijd",
                    "gebrek_identificatie", "soort_erkenning_omschrijving", F.lit(1).alias("aantal_gebreken"))


def fct_voertuigpark_gemeente(stg_vp: DataFrame, d_gemeente: DataFrame, d_datum: DataFrame) -> DataFrame:
    """Periodic snapshot fact: coverage floor derived from the municipality
    dimension, the version valid on 1 Jan of the year, period date key."""
    start = F.make_date(F.col("peiljaar"), F.lit(1), F.lit(1))
    kept = coverage_floor(stg_vp, start, d_gemeente, "geldig_van", key_col="gemeente_key")
    f = temporal_lookup(kept, d_gemeente, "gemeente_code", start, "gemeente_code", "gemeente_key",
                        from_col="geldig_van", to_col="geldig_tot", grain=["gemeente_code", "peiljaar", "voertuigsoort"])
    f = lookup(f.withColumn("__start", start), d_datum, "__start", "datum", "datum_key",
               out_col="peildatum_key", unknown=-1, bounded_dim=True)
    return f.select("peildatum_key", "gemeente_key", "gemeente_code", "peiljaar", "voertuigsoort", "aantal")


# ---------------------------------------------------------------- marts

def defects_per_kind(fct: DataFrame, d_voertuig: DataFrame) -> DataFrame:
    """Defects per code, vehicle kind and year of first admission.

    Facts of known vehicles meet their vehicle in the co-located join (both
    tables are bucketed on the key).  Those of the unknown vehicle, which may be
    most of them, share one key: they are aggregated first, a row a code, and
    only then get the attributes of the unknown member."""
    veh = d_voertuig.select("voertuig_key", "voertuigsoort",
                            F.year("datum_eerste_toelating").alias("jaar_eerste_toelating"))
    kind = ["gebrek_key", "voertuigsoort", "jaar_eerste_toelating"]
    total = F.sum("aantal_gebreken").cast("bigint").alias("aantal_gebreken")
    is_unknown = F.col("voertuig_key") == UNKNOWN_KEY
    known = fct.where(~is_unknown).join(veh, "voertuig_key", "inner").groupBy(*kind).agg(total)
    unknown = fct.where(is_unknown).groupBy("voertuig_key", "gebrek_key").agg(total)
    unknown = unknown.join(veh.where(is_unknown), "voertuig_key", "inner").select(*kind, "aantal_gebreken")
    return known.unionByName(unknown).groupBy(*kind).agg(total)


def mart_gebrek_top(fct: DataFrame, d_gebrek: DataFrame, d_voertuig: DataFrame) -> DataFrame:
    """Defects per code x vehicle kind x first-admission year, ranked per
    kind x year (count desc, code desc).  The fact is aggregated on the defect
    key before the small defect-code dimension is joined."""
    per = defects_per_kind(fct, d_voertuig)
    codes = d_gebrek.select("gebrek_key", "gebrek_identificatie", "gebrek_omschrijving")
    agg = per.join(codes, "gebrek_key", "inner").drop("gebrek_key")
    ranked = rank_within(agg, ["voertuigsoort", "jaar_eerste_toelating"],
                         ["-aantal_gebreken", "-gebrek_identificatie"], "rang")
    return ranked.select("gebrek_identificatie", "gebrek_omschrijving", "voertuigsoort",
                         "jaar_eerste_toelating", "aantal_gebreken", "rang")


def mart_voertuigpark_herindeling(fct: DataFrame, d_gemeente: DataFrame) -> DataFrame:
    out = restate_series(fct, d_gemeente, "gemeente_key", "gemeente_code",
                         then_cols={"naam_destijds": "gemeente_naam"},
                         now_cols={"gemeente_naam_nu": "gemeente_naam", "bestaat_nog": "is_actueel"},
                         from_col="geldig_van")
    return out.select("gemeente_naam_nu", "naam_destijds", "bestaat_nog", "gemeente_code", "peiljaar",
                      "voertuigsoort", "aantal")


def mart_rdw_cbs_aansluiting(d_voertuig: DataFrame, fct_park: DataFrame) -> DataFrame:
    rdw = (d_voertuig.where(F.col("voertuig_key") != UNKNOWN_KEY)
           .groupBy(classify("voertuigsoort", VEHICLE_TO_FLEET_CLASS).alias("voertuigsoort_cbs"))
           .agg(F.count(F.lit(1)).alias("aantal_steekproef")))
    latest = fct_park.agg(F.max("peiljaar")).scalar()
    cbs = (fct_park.where(F.col("peiljaar") == latest)
           .groupBy(F.col("voertuigsoort").alias("voertuigsoort_cbs"))
           .agg(F.sum("aantal").cast("bigint").alias("aantal_park")))
    return compare_shares(rdw, cbs, "voertuigsoort_cbs", "aantal_steekproef", "aantal_park",
                          NOT_COMPARABLE, "aandeel_rdw", "aandeel_cbs")


# ---------------------------------------------------------------- wiring

def models(spark: SparkSession, raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All 17 models as lazy DataFrames (staging inlined like a view)."""
    m: dict[str, DataFrame] = {}
    m["stg_rdw__voertuigen"] = stg_voertuigen(raw["voertuigen"])
    m["stg_rdw__brandstof"] = stg_brandstof(raw["brandstof"])
    m["stg_rdw__gebrek_constateringen"] = stg_gebrek_constateringen(raw["gebrek_constateringen"])
    m["stg_rdw__gebreken"] = stg_gebreken(raw["gebreken"])
    m["stg_cbs__gemeenten"] = stg_gemeenten(raw["gebieden"])
    m["stg_cbs__voertuigpark_gemeente"] = stg_voertuigpark_gemeente(raw["voertuigpark"])
    m["dim_datum"] = dim_datum(spark)
    m["dim_gemeente"] = dim_gemeente(m["stg_cbs__gemeenten"])
    m["dim_voertuig"] = dim_voertuig(m["stg_rdw__voertuigen"], m["stg_rdw__brandstof"])
    m["dim_brandstof"] = dim_brandstof(m["stg_rdw__brandstof"])
    m["dim_gebrek"] = dim_gebrek(m["stg_rdw__gebreken"])
    m["bridge_voertuig_brandstof"] = bridge_voertuig_brandstof(m["stg_rdw__brandstof"])
    m["fct_gebrek_constatering"] = fct_gebrek_constatering(
        m["stg_rdw__gebrek_constateringen"], m["dim_datum"], m["dim_voertuig"], m["dim_gebrek"])
    m["fct_voertuigpark_gemeente"] = fct_voertuigpark_gemeente(
        m["stg_cbs__voertuigpark_gemeente"], m["dim_gemeente"], m["dim_datum"])
    add_marts(m)
    return m


def add_marts(m: dict[str, DataFrame]) -> None:
    m["mart_gebrek_top"] = mart_gebrek_top(m["fct_gebrek_constatering"], m["dim_gebrek"], m["dim_voertuig"])
    m["mart_voertuigpark_herindeling"] = mart_voertuigpark_herindeling(
        m["fct_voertuigpark_gemeente"], m["dim_gemeente"])
    m["mart_rdw_cbs_aansluiting"] = mart_rdw_cbs_aansluiting(m["dim_voertuig"], m["fct_voertuigpark_gemeente"])


WAREHOUSE = ["dim_datum", "dim_gemeente", "dim_voertuig", "dim_brandstof", "dim_gebrek",
             "bridge_voertuig_brandstof", "fct_gebrek_constatering", "fct_voertuigpark_gemeente"]
MARTS = ["mart_gebrek_top", "mart_voertuigpark_herindeling", "mart_rdw_cbs_aansluiting"]

FLEET_KINDS = list(FLEET_MEASURES.values())

# The declared column tests, (model, test, column or columns, argument).
DECLARED_TESTS = [
    ("mart_gebrek_top", "unique_combination", ["gebrek_identificatie", "voertuigsoort", "jaar_eerste_toelating"], None),
    ("mart_gebrek_top", "not_null", "gebrek_identificatie", None),
    ("mart_gebrek_top", "not_null", "voertuigsoort", None),
    ("mart_gebrek_top", "not_null", "rang", None),
    ("mart_voertuigpark_herindeling", "unique_combination", ["gemeente_code", "peiljaar", "voertuigsoort"], None),
    ("mart_voertuigpark_herindeling", "not_null", "gemeente_naam_nu", None),
    ("mart_voertuigpark_herindeling", "not_null", "naam_destijds", None),
    ("mart_voertuigpark_herindeling", "not_null", "bestaat_nog", None),
    ("mart_voertuigpark_herindeling", "not_null", "aantal", None),
    ("mart_rdw_cbs_aansluiting", "unique", "voertuigsoort_cbs", None),
    ("mart_rdw_cbs_aansluiting", "not_null", "voertuigsoort_cbs", None),
    ("stg_cbs__voertuigpark_gemeente", "unique_combination", ["gemeente_code", "peiljaar", "voertuigsoort"], None),
    ("stg_cbs__voertuigpark_gemeente", "not_null", "gemeente_code", None),
    ("stg_cbs__voertuigpark_gemeente", "not_null", "peiljaar", None),
    ("stg_cbs__voertuigpark_gemeente", "not_null", "voertuigsoort", None),
    ("stg_cbs__voertuigpark_gemeente", "accepted_values", "voertuigsoort", FLEET_KINDS),
    ("stg_cbs__voertuigpark_gemeente", "not_null", "aantal", None),
    ("stg_cbs__gemeenten", "unique_combination", ["gemeente_code", "peiljaar"], None),
    ("stg_cbs__gemeenten", "not_null", "gemeente_code", None),
    ("stg_cbs__gemeenten", "not_null", "peiljaar", None),
    ("stg_cbs__gemeenten", "not_null", "gemeente_naam", None),
    ("stg_rdw__voertuigen", "unique", "kenteken", None),
    ("stg_rdw__voertuigen", "not_null", "kenteken", None),
    ("stg_rdw__brandstof", "unique_combination", ["kenteken", "brandstof_volgnummer"], None),
    ("stg_rdw__brandstof", "not_null", "kenteken", None),
    ("stg_rdw__brandstof", "relationships", "kenteken", ("stg_rdw__voertuigen", "kenteken")),
    ("stg_rdw__brandstof", "not_null", "brandstof_volgnummer", None),
    ("stg_rdw__gebrek_constateringen", "unique_combination",
     ["kenteken", "meld_datum", "meld_tijd", "gebrek_identificatie"], None),
    ("stg_rdw__gebrek_constateringen", "not_null", "kenteken", None),
    ("stg_rdw__gebrek_constateringen", "relationships", "kenteken", ("stg_rdw__voertuigen", "kenteken")),
    ("stg_rdw__gebrek_constateringen", "not_null", "meld_tijd", None),
    ("stg_rdw__gebrek_constateringen", "not_null", "gebrek_identificatie", None),
    ("stg_rdw__gebrek_constateringen", "relationships", "gebrek_identificatie",
     ("stg_rdw__gebreken", "gebrek_identificatie")),
    ("stg_rdw__gebreken", "unique", "gebrek_identificatie", None),
    ("stg_rdw__gebreken", "not_null", "gebrek_identificatie", None),
    ("dim_datum", "unique", "datum_key", None),
    ("dim_datum", "not_null", "datum_key", None),
    ("dim_datum", "unique", "datum", None),
    ("dim_datum", "not_null", "datum", None),
    ("dim_datum", "not_null", "is_feestdag", None),
    ("dim_brandstof", "unique", "brandstof_key", None),
    ("dim_brandstof", "not_null", "brandstof_key", None),
    ("dim_brandstof", "unique", "brandstof_omschrijving", None),
    ("dim_brandstof", "not_null", "brandstof_omschrijving", None),
    ("dim_gebrek", "unique", "gebrek_key", None),
    ("dim_gebrek", "not_null", "gebrek_key", None),
    ("dim_gebrek", "unique", "gebrek_identificatie", None),
    ("dim_gebrek", "not_null", "gebrek_identificatie", None),
    ("dim_gebrek", "not_null", "gebrek_omschrijving", None),
    ("dim_gebrek", "not_null", "is_actueel", None),
    ("dim_voertuig", "unique", "voertuig_key", None),
    ("dim_voertuig", "not_null", "voertuig_key", None),
    ("dim_voertuig", "unique", "kenteken", None),
    ("dim_voertuig", "not_null", "kenteken", None),
    ("bridge_voertuig_brandstof", "unique_combination", ["voertuig_key", "volgnummer"], None),
    ("bridge_voertuig_brandstof", "not_null", "voertuig_key", None),
    ("bridge_voertuig_brandstof", "relationships", "voertuig_key", ("dim_voertuig", "voertuig_key")),
    ("bridge_voertuig_brandstof", "not_null", "brandstof_key", None),
    ("bridge_voertuig_brandstof", "relationships", "brandstof_key", ("dim_brandstof", "brandstof_key")),
    ("bridge_voertuig_brandstof", "not_null", "volgnummer", None),
    ("bridge_voertuig_brandstof", "not_null", "is_hoofdbrandstof", None),
    ("dim_gemeente", "unique_combination", ["gemeente_code", "versienummer"], None),
    ("dim_gemeente", "unique", "gemeente_key", None),
    ("dim_gemeente", "not_null", "gemeente_key", None),
    ("dim_gemeente", "not_null", "gemeente_code", None),
    ("dim_gemeente", "not_null", "gemeente_naam", None),
    ("dim_gemeente", "not_null", "geldig_van", None),
    ("dim_gemeente", "not_null", "geldig_tot", None),
    ("dim_gemeente", "not_null", "is_actueel", None),
    ("dim_gemeente", "not_null", "versienummer", None),
    ("fct_gebrek_constatering", "unique_combination",
     ["kenteken", "meld_datum", "meld_tijd", "gebrek_identificatie"], None),
    ("fct_gebrek_constatering", "not_null", "meld_datum_key", None),
    ("fct_gebrek_constatering", "relationships", "meld_datum_key", ("dim_datum", "datum_key")),
    ("fct_gebrek_constatering", "not_null", "voertuig_key", None),
    ("fct_gebrek_constatering", "relationships", "voertuig_key", ("dim_voertuig", "voertuig_key")),
    ("fct_gebrek_constatering", "not_null", "gebrek_key", None),
    ("fct_gebrek_constatering", "relationships", "gebrek_key", ("dim_gebrek", "gebrek_key")),
    ("fct_gebrek_constatering", "not_null", "meld_tijd", None),
    ("fct_gebrek_constatering", "not_null", "aantal_gebreken", None),
    ("fct_voertuigpark_gemeente", "unique_combination", ["gemeente_code", "peiljaar", "voertuigsoort"], None),
    ("fct_voertuigpark_gemeente", "not_null", "peildatum_key", None),
    ("fct_voertuigpark_gemeente", "relationships", "peildatum_key", ("dim_datum", "datum_key")),
    ("fct_voertuigpark_gemeente", "not_null", "gemeente_key", None),
    ("fct_voertuigpark_gemeente", "relationships", "gemeente_key", ("dim_gemeente", "gemeente_key")),
    ("fct_voertuigpark_gemeente", "not_null", "voertuigsoort", None),
    ("fct_voertuigpark_gemeente", "accepted_values", "voertuigsoort", FLEET_KINDS),
    ("fct_voertuigpark_gemeente", "not_null", "aantal", None),
]


def declared_checks() -> list[chk.Check]:
    make = {
        "unique": lambda model, col, _: chk.unique(model, col),
        "not_null": lambda model, col, _: chk.not_null(model, col),
        "accepted_values": chk.accepted_values,
        "unique_combination": lambda model, cols, _: chk.unique_combination(
            model, cols, f"unique_combination_{model}_{'_'.join(cols)}"),
        "relationships": lambda model, col, parent: chk.relationships(
            model, col, *parent, name=f"relationships_{model}_{col}__{parent[0]}"),
    }
    return [make[test](model, col, arg) for model, test, col, arg in DECLARED_TESTS]


def invariant_checks(m: Mapping[str, DataFrame]) -> list[chk.Check]:
    """The six singular invariants of the warehouse."""
    gem = m["dim_gemeente"]
    return [
        chk.unmapped("assert_brandstof_energiedrager_bekend", "dim_brandstof", "energiedrager", "brandstof_key"),
        chk.complete("assert_gebrek_constatering_volledig", "fct_gebrek_constatering", m["stg_rdw__gebrek_constateringen"],
                     {"meld_datum_key": -1, "voertuig_key": UNKNOWN_KEY, "gebrek_key": UNKNOWN_KEY}),
        chk.no_rows("assert_gemeente_aaneengesloten_peiljaren", dq.gaps(m["stg_cbs__gemeenten"], "gemeente_code", "peiljaar")),
        chk.no_rows("assert_gemeente_geen_overlappende_perioden",
                    dq.overlaps(gem, "gemeente_code", "gemeente_key", "geldig_van", "geldig_tot")),
        chk.no_rows("assert_gemeente_hoogstens_een_actuele_versie", dq.at_most_one_current(gem, "gemeente_code", "is_actueel")),
        chk.unknown_member("assert_voertuigpark_geen_onbekende_gemeente", "fct_voertuigpark_gemeente", "gemeente_key"),
    ]


def build(spark: SparkSession, raw_dir: str, out_dir: str | None = None,
          fail_on_error: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """Build everything: staging stays lazy, warehouse and marts are written
    under ``out_dir`` (default: a fresh run folder in the shared checkpoint
    location) and read back; returns the models and the check results."""
    from starkit.sources.export import materialise, run_folder

    m = models(spark, raw_sources(spark, raw_dir))
    base = out_dir or run_folder(spark, "warehouse")
    # The defect fact and the plate-sized vehicle dimension are bucketed alike
    # on the vehicle key, so the ranking mart joins them without a shuffle;
    # facts of the unknown vehicle are spread over all writers.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    co_located = {"dim_voertuig": (n, ["voertuig_key"]),
                  "fct_gebrek_constatering": (n, ["voertuig_key"], F.col("voertuig_key") == UNKNOWN_KEY)}
    # dependency order: dimensions + bridge, then facts from the written
    # dimensions, then marts from the written facts (nothing computed twice)
    # the deduplicated defects are written once too: the fact is built from the
    # files, and the completeness check takes the staged count from their footers
    staged = {k: m[k] for k in ("stg_rdw__gebrek_constateringen",)}
    m.update(materialise(staged | {k: m[k] for k in WAREHOUSE if not k.startswith("fct_")}, base, bucket_by=co_located))
    m["fct_gebrek_constatering"] = fct_gebrek_constatering(
        m["stg_rdw__gebrek_constateringen"], m["dim_datum"], m["dim_voertuig"], m["dim_gebrek"])
    m["fct_voertuigpark_gemeente"] = fct_voertuigpark_gemeente(
        m["stg_cbs__voertuigpark_gemeente"], m["dim_gemeente"], m["dim_datum"])
    m.update(materialise({k: m[k] for k in WAREHOUSE if k.startswith("fct_")}, base, bucket_by=co_located))
    add_marts(m)
    m.update(materialise({k: m[k] for k in MARTS}, base))
    result = chk.run_checks(m, declared_checks() + invariant_checks(m))
    if fail_on_error:
        dq.assert_suite(result)
    return m, result


def export_warehouse(m: Mapping[str, DataFrame], target: str) -> DataFrame:
    """The eight star tables (not the marts) to parquet, row counts."""
    from starkit.sources.export import export_report, materialise

    return export_report(materialise({k: m[k] for k in WAREHOUSE}, target, compression="snappy"))


FIXTURE_REPORT = "fixture_report.json"

#: Files that fixtures hold whole.
VERBATIM = [f"{RDW}_gebreken", "cbs_70072ned_measurecodes", "cbs_70072ned_regiocodes", "cbs_70072ned_periodencodes",
            "cbs_gebieden_measurecodes", "cbs_85237ned_measurecodes", "cbs_85237ned_personenautos_brandstof"]


def raw_names(spark: SparkSession, raw_dir: str) -> list[str]:
    """Names of all parquet files of the raw folder, by a listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{raw_dir.rstrip('/')}/*.parquet")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(x.getPath().getName().removesuffix(".parquet") for x in found or [])


def whole_files(spark: SparkSession, raw_dir: str, names) -> dict[str, DataFrame]:
    """Those of ``names`` that the raw folder has, unchanged."""
    return {n: spark.read.parquet(f"{raw_dir.rstrip('/')}/{n}.parquet") for n in raw_names(spark, raw_dir) if n in names}


def area_files(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    years = [n for n in raw_names(spark, raw_dir) if re.fullmatch(r"cbs_gebieden_[0-9]{4}", n)]
    return whole_files(spark, raw_dir, years)


def make_fixtures(spark: SparkSession, raw_dir: str, target: str, n_plates: int = 5000,
                  extra_plates=("02BND8",), first_year: int = 2015) -> DataFrame:
    """A referentially consistent fixture set.  The first
    ``n_plates`` plates in order plus explicit extra plates select the
    vehicle, fuel and defect rows; the fleet file keeps municipalities from
    ``first_year``; the files of ``VERBATIM`` that the raw folder has and the
    yearly area files are copied whole; no column is ever dropped.  Returns the
    row report; the whole report (plates asked for and taken, extra plates, the
    limit plate, first year, rows per file) is the JSON of ``FIXTURE_REPORT``
    beside the files."""
    from starkit.sources.sample import first_keys, restrict_to, sample_report

    raw = raw_sources(spark, raw_dir)
    plates = first_keys(raw["voertuigen"], "kenteken", n_plates, list(extra_plates))
    out = {
        f"{RDW}_{VEHICLES}": restrict_to(raw["voertuigen"], "kenteken", plates, "kenteken"),
        f"{RDW}_{FUEL}": restrict_to(raw["brandstof"], "kenteken", plates, "kenteken"),
        f"{RDW}_{DEFECTS_FOUND}": restrict_to(raw["gebrek_constateringen"], "kenteken", plates, "kenteken"),
        f"{RDW}_{DEFECT_CODES}": raw["gebreken"],
        f"{CBS}_{FLEET}": raw["voertuigpark"].where(
            F.col("RegioS").startswith(MUNICIPALITY_PREFIX)
            & (F.left(F.col("Perioden"), F.lit(4)).cast("int") >= first_year)),
    }
    out |= whole_files(spark, raw_dir, VERBATIM) | area_files(spark, raw_dir)
    from starkit.sources.export import export_report, materialise
    written = materialise(out, target)
    report = sample_report(n_plates, list(extra_plates), plates, "kenteken", written, {"first_year": F.lit(first_year)})
    counted = [F.struct(F.lit(n).alias("file"), F.col(f"{n}_rows").alias("n_rows")) for n in sorted(written)]
    (report.select("n_requested", "extra_keys", "n_keys", "limit_key", "max_key", "first_year", F.array(*counted).alias("files"))
     .coalesce(1).write.mode("overwrite").json(f"{target.rstrip('/')}/{FIXTURE_REPORT}"))
    return export_report(written)


def range_sample(spark: SparkSession, raw_dir: str, target: str, size: int = 500_000) -> DataFrame:
    """One plate range fixed on the vehicle file (its first and its
    ``size``-th plate in order) and applied to the vehicle, fuel and defect
    files, so the three samples describe one vehicle population; code lists
    and the municipality files, the yearly ones too, are copied whole.  Returns the row report."""
    from starkit.sources.export import export_report, materialise
    from starkit.sources.sample import fixed_bounds, in_range, key_range

    raw = raw_sources(spark, raw_dir)
    bounds = fixed_bounds(key_range(raw["voertuigen"], "kenteken", size))
    out = {
        f"{RDW}_{VEHICLES}": in_range(raw["voertuigen"], "kenteken", bounds),
        f"{RDW}_{FUEL}": in_range(raw["brandstof"], "kenteken", bounds),
        f"{RDW}_{DEFECTS_FOUND}": in_range(raw["gebrek_constateringen"], "kenteken", bounds),
        f"{RDW}_{DEFECT_CODES}": raw["gebreken"],
        f"{CBS}_{FLEET}": raw["voertuigpark"],
    }
    out |= whole_files(spark, raw_dir, [n for n in VERBATIM if n.endswith("codes")]) | area_files(spark, raw_dir)
    return export_report(materialise(out, target))
