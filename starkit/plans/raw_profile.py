"""Profiling of the registry's raw layer (R1-R12 applied to the landed
vehicle-registry and municipality files): every report is a DataFrame
computed on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.functions.scalars import count_of
from starkit.operators import profile as prof
from starkit.operators import quality as dq
from starkit.plans import registry as reg
from starkit.sources.landing import read_family, source

# Candidate keys per raw file, references between raw files, the
# columns staging hard-casts, and the indicator columns read as booleans.
GRAIN_CANDIDATES = {
    "rdw_gekentekende_voertuigen": ["kenteken"],
    "rdw_brandstof": ["kenteken", "brandstof_volgnummer"],
    "rdw_gebreken": ["gebrek_identificatie"],
    "rdw_geconstateerde_gebreken": ["kenteken", "meld_datum_door_keuringsinstantie",
                                    "meld_tijd_door_keuringsinstantie", "gebrek_identificatie"],
    "cbs_70072ned_motorvoertuigen_gemeente": ["RegioS", "Perioden", "Measure"],
    "cbs_85237ned_personenautos_brandstof": ["Measure", "Perioden", "Bouwjaar"],
    "cbs_70072ned_regiocodes": ["Identifier"],
    "cbs_70072ned_periodencodes": ["Identifier"],
    "cbs_70072ned_measurecodes": ["Identifier"],
    "cbs_85237ned_measurecodes": ["Identifier"],
    "cbs_gebieden_measurecodes": ["Identifier"],
}
REFERENCES = [
    ("rdw_brandstof", "kenteken", "rdw_gekentekende_voertuigen", "kenteken"),
    ("rdw_geconstateerde_gebreken", "kenteken", "rdw_gekentekende_voertuigen", "kenteken"),
    ("rdw_geconstateerde_gebreken", "gebrek_identificatie", "rdw_gebreken", "gebrek_identificatie"),
    ("cbs_70072ned_motorvoertuigen_gemeente", "RegioS", "cbs_70072ned_regiocodes", "Identifier"),
    ("cbs_70072ned_motorvoertuigen_gemeente", "Measure", "cbs_70072ned_measurecodes", "Identifier"),
    ("cbs_70072ned_motorvoertuigen_gemeente", "Perioden", "cbs_70072ned_periodencodes", "Identifier"),
]
CASTS = {
    "aantal_zitplaatsen": "int", "aantal_deuren": "int", "aantal_wielen": "int", "aantal_cilinders": "int",
    "cilinderinhoud": "int", "massa_ledig_voertuig": "int", "massa_rijklaar": "int",
    "toegestane_maximum_massa_voertuig": "int", "maximale_constructiesnelheid": "int",
    "catalogusprijs": "int", "bruto_bpm": "int", "datum_eerste_toelating_dt": "date",
    "datum_tenaamstelling_dt": "date", "vervaldatum_apk_dt": "date",
    "datum_eerste_tenaamstelling_in_nederland_dt": "date",
}
INDICATORS = ["export_indicator", "tenaamstellen_mogelijk", "taxi_indicator",
              "openstaande_terugroepactie_indicator", "wam_verzekerd"]


def _raw(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{raw_dir.rstrip('/')}/{name}.parquet")


def inventory(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Rows, columns, size, row groups per raw file (footers only)."""
    return prof.parquet_inventory(spark, f"{raw_dir.rstrip('/')}/*.parquet")


def column_profile(spark: SparkSession, raw_dir: str, name: str = "rdw_geconstateerde_gebreken") -> DataFrame:
    """R2: the SUMMARIZE-style profile of one raw file (HyperLogLog distinct)."""
    return prof.column_profile(_raw(spark, raw_dir, name), exact=False)


def grain(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Is each candidate key unique?  Missing columns become remarks, those
    of a file that the raw folder lacks too."""
    there = set(reg.raw_names(spark, raw_dir))
    nothing = spark.range(0).select()
    return prof.grain({n: (_raw(spark, raw_dir, n) if n in there else nothing, k) for n, k in GRAIN_CANDIDATES.items()})


def full_duplicates(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Fully duplicated rows per raw file, of all that the folder has."""
    return prof.duplicate_count({n: _raw(spark, raw_dir, n) for n in reg.raw_names(spark, raw_dir)})


def duplicate_defect_rows(spark: SparkSession, raw_dir: str) -> DataFrame:
    """The duplicated defect rows with multiplicity."""
    return prof.duplicate_rows(source(spark, raw_dir, reg.RDW, reg.DEFECTS_FOUND))


def coverage(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Referential coverage of fuel and defects on vehicles and codes, and
    of the fleet file on its three code lists; pairs whose files the raw folder
    has."""
    there = set(reg.raw_names(spark, raw_dir))
    out = None
    for child, col, parent, parent_col in REFERENCES:
        if {child, parent} <= there:
            part = prof.coverage(_raw(spark, raw_dir, child), col, _raw(spark, raw_dir, parent), parent_col, child, parent)
            out = part if out is None else out.unionByName(part)
    return out


def area_series(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Per yearly area file: rows, regions, municipalities, measures."""
    fam = read_family(spark, f"{raw_dir.rstrip('/')}/{reg.AREAS_GLOB}")
    year = F.regexp_extract("source_file", reg.AREA_YEAR_PATTERN, 1).cast("int")
    return (fam.groupBy(year.alias("peiljaar"))
               .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("RegioS").alias("n_regions"),
                    F.count_distinct(F.when(F.col("RegioS").startswith(reg.MUNICIPALITY_PREFIX), F.col("RegioS")))
                     .alias("n_municipalities"),
                    F.count_distinct("Measure").alias("n_measures")))


def municipality_changes(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Municipalities appearing / vanishing between consecutive years."""
    fam = read_family(spark, f"{raw_dir.rstrip('/')}/{reg.AREAS_GLOB}")
    per = fam.where(F.col("RegioS").startswith(reg.MUNICIPALITY_PREFIX)).select(
        F.regexp_extract("source_file", reg.AREA_YEAR_PATTERN, 1).cast("int").alias("peiljaar"),
        F.trim("RegioS").alias("gemeente"))
    return prof.membership_change(per, "peiljaar", "gemeente")


def padding(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Fixed-width padding of the area values per measure."""
    fam = read_family(spark, f"{raw_dir.rstrip('/')}/{reg.AREAS_GLOB}")
    return prof.padding(fam, "Measure", "StringValue", 15)


def castability(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Values each hard staging cast would fail on."""
    return prof.castability(source(spark, raw_dir, reg.RDW, reg.VEHICLES), CASTS)


def indicator_census(spark: SparkSession, raw_dir: str) -> DataFrame:
    """The values that occur in the indicator columns."""
    return prof.value_census(source(spark, raw_dir, reg.RDW, reg.VEHICLES), INDICATORS)


def fixture_checks(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Orphan counts, duplicate defect groups, 3-character times."""
    veh = source(spark, raw_dir, reg.RDW, reg.VEHICLES)
    fuel = source(spark, raw_dir, reg.RDW, reg.FUEL)
    found = source(spark, raw_dir, reg.RDW, reg.DEFECTS_FOUND)
    codes = source(spark, raw_dir, reg.RDW, reg.DEFECT_CODES)
    return prof.orphan_counts({"fuel": fuel, "found": found, "veh": veh, "codes": codes}, {
        "fuel_without_vehicle": ("fuel", "kenteken", "veh", "kenteken"),
        "defects_without_vehicle": ("found", "kenteken", "veh", "kenteken"),
        "defects_without_code": ("found", "gebrek_identificatie", "codes", "gebrek_identificatie")}).select(
        "*", count_of(dq.unique_combination(found, ["kenteken", "meld_datum_door_keuringsinstantie",
                                               "meld_tijd_door_keuringsinstantie", "gebrek_identificatie"]))
        .alias("duplicate_defects"),
        found.agg(F.count_if(F.length("meld_tijd_door_keuringsinstantie") == 3)).scalar()
        .alias("three_character_times"))


REPORTS = {
    "inventory": inventory, "column_profile": column_profile, "grain": grain,
    "full_duplicates": full_duplicates, "duplicate_defect_rows": duplicate_defect_rows,
    "coverage": coverage, "area_series": area_series, "municipality_changes": municipality_changes,
    "padding": padding, "castability": castability, "indicator_census": indicator_census,
    "fixture_checks": fixture_checks,
}
