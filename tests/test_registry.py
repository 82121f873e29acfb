"""End-to-end build of the vehicle / municipality warehouse on synthetic raw
files (all columns text, the source file names) that contain every trap
listed for the fixtures."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from starkit.plans import registry

VEH_COLS = [
    "kenteken", "voertuigsoort", "merk", "handelsbenaming", "inrichting", "eerste_kleur", "tweede_kleur",
    "europese_voertuigcategorie", "aantal_zitplaatsen", "aantal_deuren", "aantal_wielen", "aantal_cilinders",
    "cilinderinhoud", "massa_ledig_voertuig", "massa_rijklaar", "toegestane_maximum_massa_voertuig",
    "maximale_constructiesnelheid", "catalogusprijs", "bruto_bpm", "datum_eerste_toelating_dt",
    "datum_tenaamstelling_dt", "vervaldatum_apk_dt", "datum_eerste_tenaamstelling_in_nederland_dt",
    "export_indicator", "tenaamstellen_mogelijk", "taxi_indicator", "openstaande_terugroepactie_indicator",
    "wam_verzekerd", "unused_extra_column",
]
FUEL_COLS = [
    "kenteken", "brandstof_volgnummer", "brandstof_omschrijving", "brandstofverbruik_gecombineerd",
    "co2_uitstoot_gecombineerd", "co2_uitstoot_gewogen", "nettomaximumvermogen", "geluidsniveau_rijdend",
    "geluidsniveau_stationair", "emissiecode_omschrijving", "uitlaatemissieniveau",
    "milieuklasse_eg_goedkeuring_licht",
]
DEF_COLS = ["kenteken", "meld_datum_door_keuringsinstantie", "meld_datum_door_keuringsinstantie_dt",
            "meld_tijd_door_keuringsinstantie", "gebrek_identificatie", "soort_erkenning_keuringsinstantie",
            "soort_erkenning_omschrijving", "aantal_gebreken_geconstateerd"]
CODE_COLS = ["gebrek_identificatie", "gebrek_omschrijving", "gebrek_artikel_nummer", "gebrek_paragraaf_nummer",
             "ingangsdatum_gebrek_dt", "einddatum_gebrek_dt"]
OBS = ["Id", "Measure", "ValueAttribute", "Value", "StringValue"]


def vehicle(plate, kind, admitted, export="Nee", wam="Ja"):
    row = {c: None for c in VEH_COLS}
    row.update(kenteken=plate, voertuigsoort=kind, merk=" volkswagen ", handelsbenaming="golf ",
               aantal_zitplaatsen="5", catalogusprijs="25000", massa_ledig_voertuig="1200",
               datum_eerste_toelating_dt=admitted, export_indicator=export, wam_verzekerd=wam)
    return tuple(row[c] for c in VEH_COLS)


def fuel(plate, seq, desc, use="7.3"):
    row = {c: None for c in FUEL_COLS}
    row.update(kenteken=plate, brandstof_volgnummer=str(seq), brandstof_omschrijving=desc,
               brandstofverbruik_gecombineerd=use, geluidsniveau_rijdend="70")
    return tuple(row[c] for c in FUEL_COLS)


def write(spark, base, name, cols, rows):
    schema = ", ".join(f"`{c}` string" for c in cols)
    spark.createDataFrame(rows, schema).write.parquet(f"{base}/{name}.parquet")


@pytest.fixture(scope="module")
def built(spark):
    from starkit.sources.export import run_folder

    raw = run_folder(spark, "raw")
    write(spark, raw, "rdw_gekentekende_voertuigen", VEH_COLS, [
        vehicle("P1", "Personenauto", "2019-05-01T00:00:00.000"),
        vehicle("P2", "Personenauto", "2019-06-01T00:00:00.000", export="N.v.t."),
        vehicle("P3", "Aanhangwagen", "2001-01-01T00:00:00.000", wam=None),
        vehicle("P4", "Motorfiets", "1915-06-30T00:00:00.000", wam="N.v.t."),
        vehicle("P5", "Bedrijfsauto", None, export=None),
        vehicle("P6", "Zweefauto", "2020-01-01T00:00:00.000"),
        vehicle("02BND8", "Personenauto", "2019-05-01T00:00:00.000"),
    ])
    write(spark, raw, "rdw_brandstof", FUEL_COLS, [
        fuel("P1", 1, "Benzine"), fuel("P1", 2, "Elektriciteit"),
        fuel("P2", 1, "Diesel"), fuel("P2", 2, "Waterstof-2"), fuel("P2", 3, "LPG"),
        fuel("P4", 1, "Benzine"), fuel("02BND8", 1, "Benzine"), fuel("P6", 1, "Benzine", use=None),
    ])
    d = "2026-03-03T00:00:00.000"
    write(spark, raw, "rdw_geconstateerde_gebreken", DEF_COLS, [
        ("02BND8", "20260303", d, "1639", "205", "2", "Garage", "1"),
        ("02BND8", "20260303", d, "1639", "205", "2", "Garage", "1"),   # fully duplicated row
        ("P1", "20260303", d, "953", "205", "2", "Garage", "2"),        # 3-character time
        ("P1", "20260303", d, "953", "AC1", "2", "Garage", "2"),
        ("P4", "20250101", "2025-01-01T00:00:00.000", "1200", "AC1", "1", "RDW", "1"),
        ("P2", "20250101", "2025-01-01T00:00:00.000", "1200", "205", "1", "RDW", "1"),
    ])
    write(spark, raw, "rdw_gebreken", CODE_COLS, [
        ("205", "Band versleten", "5.1", "1", "2010-01-01T00:00:00.000", None),
        ("AC1", "Roest", "6.2", "3", "2000-01-01T00:00:00.000", "2020-01-01T00:00:00.000"),
        ("X99", "Ongebruikt", "9.9", "9", "2000-01-01T00:00:00.000", None),
    ])
    fleet = []
    for code in ["GM0001", "GM0004", "GM0005"]:
        for year in range(2014, 2019):
            fleet.append((f"{code}{year}", "A018943_1", None, "268240.0", None, code, f"{year}JJ00"))
            fleet.append((f"{code}{year}m", "A018944_1", None, "10.5", None, code, f"{year}JJ00"))
    fleet += [("x1", "A018943_1", None, "5", None, "NL01", "2018JJ00"),        # not a municipality
              ("x2", "A999999", None, "5", None, "GM0001", "2018JJ00"),        # other measure
              ("x3", "A018930", None, None, None, "GM0001", "2018JJ00"),       # null value
              ("x4", "A018930", None, "3.0", None, "GM0002", "2016JJ00")]      # dissolved later
    write(spark, raw, "cbs_70072ned_motorvoertuigen_gemeente", OBS + ["RegioS", "Perioden"], fleet)
    names = {
        "GM0001": {2015: "Oudstad", 2016: "Oudstad" + " " * 43, 2017: "Nieuwstad", 2018: "Nieuwstad"},
        "GM0002": {2015: "Weg", 2016: "Weg"},
        "GM0003": {2017: "Later", 2018: "Later"},
        "GM0004": {2015: "A", 2016: "B", 2017: "A", 2018: "A"},
        "GM0005": {y: "Zelfde" for y in range(2015, 2019)},
        "GM0006": {2015: "Gat", 2017: "Gat"},
    }
    for year in range(2015, 2019):
        rows = []
        for code, per in names.items():
            if year in per:
                rows.append((f"{code}n", "GM000C_1", None, None, per[year], code))
                rows.append((f"{code}a", "AM0002", None, None, f"Agglo {year}", code))
        write(spark, raw, f"cbs_gebieden_{year}", OBS + ["RegioS"], rows)
    write(spark, raw, "cbs_gebieden_measurecodes", ["Identifier", "Title"], [("GM000C_1", "Naam")])
    m, result = registry.build(spark, raw)
    m["__raw_dir__"] = raw
    return m, {r.check_name: r.failing_rows for r in result.collect()}


def test_expected_checks_fail_and_others_pass(built):
    _, checks = built
    failing = {k for k, v in checks.items() if v}
    assert failing == {"assert_brandstof_energiedrager_bekend", "assert_gemeente_aaneengesloten_peiljaren",
                       "not_null_mart_rdw_cbs_aansluiting_voertuigsoort_cbs"}
    assert len(checks) == len(registry.DECLARED_TESTS) + 6


def test_staging_dedup_and_time_padding(built):
    m, _ = built
    gc = m["stg_rdw__gebrek_constateringen"]
    assert gc.count() == 5
    assert gc.where("kenteken = 'P1'").select("meld_tijd").distinct().first()[0] == "0953"


def test_municipality_versions(built):
    m, _ = built
    g = {}
    for r in m["dim_gemeente"].collect():
        g.setdefault(r.gemeente_code, []).append(r)
    assert len(g["GM0001"]) == 2 and len(g["GM0004"]) == 3 and len(g["GM0005"]) == 1
    assert [r.is_actueel for r in g["GM0002"]] == [False]
    assert g["GM0003"][0].geldig_van == dt.date(2017, 1, 1)
    assert g["(onbekend)"][0].gemeente_key == "-1"
    assert all(r.geldig_tot == dt.date(9999, 12, 31) for r in g["GM0005"])


def test_fleet_fact_floor_and_temporal_join(built):
    m, _ = built
    f = m["fct_voertuigpark_gemeente"]
    assert f.agg(F.min("peiljaar")).first()[0] == 2015          # 2014 dropped by the coverage floor
    assert f.where("gemeente_key = '-1'").count() == 0
    names = dict(m["dim_gemeente"].select("gemeente_key", "gemeente_naam").collect())
    got = {(r.gemeente_code, r.peiljaar): names[r.gemeente_key]
           for r in f.where("voertuigsoort = 'Personenauto'").collect()}
    assert got[("GM0001", 2016)] == "Oudstad" and got[("GM0001", 2017)] == "Nieuwstad"
    assert f.where("gemeente_code = 'GM0001' AND peiljaar = 2015 AND voertuigsoort = 'Personenauto'") \
        .first().aantal == 268240
    h = m["mart_voertuigpark_herindeling"].where("gemeente_code = 'GM0001' AND peiljaar = 2015").first()
    assert (h.gemeente_naam_nu, h.naam_destijds, h.bestaat_nog) == ("Nieuwstad", "Oudstad", True)


def test_vehicle_dimension_and_bridge(built):
    m, _ = built
    v = {r.kenteken: r for r in m["dim_voertuig"].collect()}
    assert v["P1"].hoofdbrandstof == "Benzine" and v["P3"].hoofdbrandstof is None
    assert v["P1"].merk == "VOLKSWAGEN" and v["(onbekend)"].voertuig_key == "-1"
    br = m["bridge_voertuig_brandstof"]
    assert br.count() == 8 and br.where("is_hoofdbrandstof").count() == 5
    assert br.join(m["dim_brandstof"], "brandstof_key", "left_anti").count() == 0
    assert br.join(m["dim_voertuig"], "voertuig_key", "left_anti").count() == 0


def test_defect_fact_and_ranking_mart(built):
    m, _ = built
    f = m["fct_gebrek_constatering"]
    assert f.count() == 5 and f.where("voertuig_key = '-1' OR gebrek_key = '-1' OR meld_datum_key = -1").count() == 0
    top = {(r.voertuigsoort, r.jaar_eerste_toelating, r.gebrek_identificatie): (r.aantal_gebreken, r.rang)
           for r in m["mart_gebrek_top"].collect()}
    assert top[("Personenauto", 2019, "205")] == (3, 1)
    assert top[("Personenauto", 2019, "AC1")] == (1, 2)
    assert top[("Motorfiets", 1915, "AC1")] == (1, 1)


def test_share_mart(built):
    m, _ = built
    s = {r.voertuigsoort_cbs: r for r in m["mart_rdw_cbs_aansluiting"].collect()}
    assert s["Personenauto"].aantal_steekproef == 3 and s["Personenauto"].aandeel_rdw == 0.6
    assert s["(niet vergelijkbaar)"].aandeel_rdw is None and s[None].aandeel_rdw is None
    assert s["Motorfiets"].aantal_park == 30 and s["Personenauto"].aantal_park == 804720
    assert s["Personenauto"].aandeel_cbs == round(804720 / 804750, 4)


def test_export_and_fixtures(built, spark):
    from starkit.sources.export import run_folder

    m, _ = built
    rep = {r.table_name: r.n_rows for r in registry.export_warehouse(m, run_folder(spark, "export")).collect()}
    assert set(rep) == set(registry.WAREHOUSE) and rep["dim_datum"] == 14611


def test_make_fixtures_keeps_references_consistent(built, spark):
    from starkit.sources.export import run_folder

    m, _ = built
    target = run_folder(spark, "fixtures")
    rep = {r.table_name: r.n_rows for r in
           registry.make_fixtures(spark, m["__raw_dir__"], target, n_plates=3, extra_plates=("P5",)).collect()}
    # first three plates in order (02BND8, P1, P2) plus the explicit extra plate P5
    assert rep["rdw_gekentekende_voertuigen"] == 4
    assert rep["rdw_brandstof"] == 6
    assert rep["rdw_geconstateerde_gebreken"] == 5          # the duplicated row is kept verbatim
    assert rep["rdw_gebreken"] == 3                         # code list copied whole
    assert rep["cbs_70072ned_motorvoertuigen_gemeente"] == 27  # municipalities from 2015 on
    assert {k for k in rep if re.fullmatch(r"cbs_gebieden_[0-9]{4}", k)} == {f"cbs_gebieden_{y}" for y in range(2015, 2019)}
    assert rep["cbs_gebieden_measurecodes"] == spark.read.parquet(f"{m['__raw_dir__']}/cbs_gebieden_measurecodes.parquet").count()
    doc = spark.read.json(f"{target}/{registry.FIXTURE_REPORT}").first()
    assert (doc.n_requested, doc.extra_keys, doc.n_keys, doc.limit_key, doc.first_year) == (3, "P5", 4, "P2", 2015)
    assert {f.file: f.n_rows for f in doc.files} == rep
    back = spark.read.parquet(f"{target}/rdw_brandstof.parquet")
    assert len(back.columns) == 12  # no column dropped


def test_raw_profile_reports(built, spark):
    from starkit.plans import raw_profile as rp

    raw = built[0]["__raw_dir__"]
    fx = rp.fixture_checks(spark, raw).first()
    assert (fx.fuel_without_vehicle, fx.defects_without_vehicle, fx.defects_without_code,
            fx.duplicate_defects, fx.three_character_times) == (0, 0, 0, 1, 2)
    dups = {r.table_name: r.n_duplicates for r in rp.full_duplicates(spark, raw).collect()}
    assert dups["rdw_geconstateerde_gebreken"] == 1 and dups["rdw_gekentekende_voertuigen"] == 0
    g = {r.table_name: r.is_unique for r in rp.grain(spark, raw).collect()}
    assert g["rdw_gekentekende_voertuigen"] is True and g["rdw_geconstateerde_gebreken"] is False
    series = {r.peiljaar: r.n_municipalities for r in rp.area_series(spark, raw).collect()}
    assert series == {2015: 5, 2016: 4, 2017: 5, 2018: 4}  # GM0003 from 2017, GM0006 skips 2016
    changes = {r.peiljaar: (r.n_new, r.n_vanished) for r in rp.municipality_changes(spark, raw).collect()}
    assert changes == {2016: (0, 1), 2017: (1, 1)}  # GM0002 last seen 2016; GM0003 new, GM0006 last 2017
    census = {(r.column_name, r.value): r.n for r in rp.indicator_census(spark, raw).collect()}
    assert census[("wam_verzekerd", "N.v.t.")] == 1 and census[("wam_verzekerd", "(null)")] == 1
    pad = {r.Measure: r.n_padded for r in rp.padding(spark, raw).collect()}
    assert pad == {"GM000C_1": 1}
    assert all(r.n_unparseable == 0 for r in rp.castability(spark, raw).collect())
    for name, fn in rp.REPORTS.items():
        assert fn(spark, raw).count() >= 0, name


def test_cli_build_and_profile(built, spark, capsys):
    from starkit.__main__ import main

    raw = built[0]["__raw_dir__"]
    assert main(["build", "--raw", raw]) == 0
    assert main(["profile", "--raw", raw, "fixture_checks"]) == 0
    out = capsys.readouterr().out
    assert "assert_gemeente_aaneengesloten_peiljaren" in out and "three_character_times" in out


def test_ranking_mart_joins_fact_and_vehicles_without_a_shuffle(built, spark):
    m, _ = built
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        per = registry.defects_per_kind(m["fct_gebrek_constatering"], m["dim_voertuig"])
        p = spark._jvm.PythonSQLUtils.explainString(per._jdf.queryExecution(), "formatted")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # the co-located join has no exchange below it; only aggregated rows are exchanged
    lines = p.split("\n\n(1)")[0].split("\n")
    first = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line)
    at, under = lines[first].index("SortMergeJoin"), []
    for line in lines[first + 1:]:
        name = re.search(r"[A-Z]", line)
        if not name or name.start() < at:
            break
        under.append(line)
    assert sum("Scan parquet" in line for line in under) == 2 and not any("Exchange" in line for line in under), p


def test_half_of_the_facts_on_the_unknown_vehicle(built, spark):
    """Rows of the unknown member are spread over all writers, in files of their
    own; the mart aggregates them beside the co-located join."""
    from starkit.sources.export import materialise, run_folder

    n = 16
    known = spark.range(40_000).selectExpr("cast(id % 5000 as string) AS voertuig_key", "cast(id % 7 as string) AS gebrek_key", "1 AS aantal_gebreken", "id")
    missed = spark.range(40_000).selectExpr(f"'{registry.UNKNOWN_KEY}' AS voertuig_key", "cast(id % 7 as string) AS gebrek_key", "1 AS aantal_gebreken", "id")
    facts = known.unionByName(missed)
    vehicles = spark.range(5000).selectExpr("cast(id as string) AS voertuig_key", "if(id % 2 = 0, 'A', 'B') AS voertuigsoort", "date'2001-02-03' AS datum_eerste_toelating")
    vehicles = vehicles.unionByName(spark.createDataFrame([(registry.UNKNOWN_KEY, "?", None)], "voertuig_key string, voertuigsoort string, datum_eerste_toelating date"))
    w = materialise({"facts": facts, "vehicles": vehicles}, run_folder(spark, "hot-unknown"),
                    bucket_by={"facts": (n, ["voertuig_key"], F.col("voertuig_key") == registry.UNKNOWN_KEY), "vehicles": (n, ["voertuig_key"])})
    files = {r.f: (r.n, r.u) for r in w["facts"].groupBy(F.input_file_name().alias("f")).agg(
        F.count("*").alias("n"), F.count_if(F.col("voertuig_key") == registry.UNKNOWN_KEY).alias("u")).collect()}
    sizes = sorted(c for c, _ in files.values())
    assert sum(c for c, _ in files.values()) == 80_000 and all(u in (0, c) for c, u in files.values())
    assert sizes[-1] < 3 * sizes[len(sizes) // 2] and sum(u > 0 for _, u in files.values()) >= n // 2
    settings = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "64k"}
    old = {k: spark.conf.get(k) for k in settings}
    try:  # a task's rows on the branch of the unknown member: no task has them all
        for k, v in settings.items():
            spark.conf.set(k, v)
        tasks = [r["count"] for r in w["facts"].where(F.col("voertuig_key") == registry.UNKNOWN_KEY).groupBy(F.spark_partition_id()).count().collect()]
        got = {(r.gebrek_key, r.voertuigsoort, r.jaar_eerste_toelating): r.aantal_gebreken
               for r in registry.defects_per_kind(w["facts"], w["vehicles"]).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(tasks) > 4 and max(tasks) < 3 * sorted(tasks)[len(tasks) // 2]
    expected = facts.join(vehicles, "voertuig_key").groupBy("gebrek_key", "voertuigsoort", F.year("datum_eerste_toelating").alias("y")).agg(F.sum("aantal_gebreken").alias("n"))
    assert got == {(r.gebrek_key, r.voertuigsoort, r.y): r.n for r in expected.collect()} and len(got) == 21


def test_range_sample_applies_one_plate_range(built, spark):
    from starkit.sources.export import run_folder

    m, _ = built
    rep = {r.table_name: r.n_rows for r in
           registry.range_sample(spark, m["__raw_dir__"], run_folder(spark, "range"), size=3).collect()}
    # plates in order: 02BND8, P1, P2 -> range [02BND8, P2]
    assert rep["rdw_gekentekende_voertuigen"] == 3
    assert rep["rdw_brandstof"] == 6 and rep["rdw_geconstateerde_gebreken"] == 5


def test_cli_land_and_sample(built, spark, capsys):
    import json
    import os

    from starkit.__main__ import main
    from starkit.sources.export import run_folder

    src = run_folder(spark, "cli-src")
    os.makedirs(src)
    with open(f"{src}/page1.json", "w") as fh:
        fh.write(json.dumps({"kenteken": "AA", "merk": "X"}) + "\n")
    target = run_folder(spark, "cli-land")
    assert main(["land", "--source", src, "--columns", "kenteken,merk,extra", "--target", target]) == 0
    assert spark.read.parquet(target).columns == ["kenteken", "merk", "extra"]
    assert main(["sample", "--raw", built[0]["__raw_dir__"], "--target", run_folder(spark, "cli-sample"),
                 "--size", "2"]) == 0
    out = capsys.readouterr().out
    assert "1 rows landed in total" in out and "rdw_brandstof" in out


def test_build_fails_on_error_when_checks_fail(built, spark):
    with pytest.raises(AssertionError) as err:
        registry.build(spark, built[0]["__raw_dir__"], fail_on_error=True)
    msg = str(err.value)
    assert "assert_brandstof_energiedrager_bekend" in msg and "assert_gemeente_aaneengesloten_peiljaren" in msg


def test_whole_files_grain_and_duplicates_of_all_raw_files(built, spark):
    import shutil

    from starkit.plans import raw_profile as rp
    from starkit.sources.export import run_folder

    raw = run_folder(spark, "raw-whole")
    # the code list that the raw folder has already is written again below, with a repeated row
    shutil.copytree(built[0]["__raw_dir__"], raw, ignore=shutil.ignore_patterns("cbs_gebieden_measurecodes.parquet"))
    lists = [n for n in rp.GRAIN_CANDIDATES if n.endswith("codes")]
    for n in lists:
        write(spark, raw, n, ["Identifier", "Title"], [("a", "x"), ("b", "y"), ("b", "y")])
    write(spark, raw, "cbs_85237ned_personenautos_brandstof", ["Measure", "Perioden", "Bouwjaar"], [("m", "p", "1"), ("m", "p", "2")])
    areas = {f"cbs_gebieden_{y}" for y in range(2015, 2019)}
    rep = {r.table_name: r.n_rows for r in registry.make_fixtures(spark, raw, run_folder(spark, "whole"), n_plates=3).collect()}
    assert len(lists) == 5 and all(rep[n] == 3 for n in lists) and rep["cbs_85237ned_personenautos_brandstof"] == 2
    assert areas <= set(rep) and rep["rdw_gebreken"] == 3
    assert areas | set(lists) <= {r.table_name for r in registry.range_sample(spark, raw, run_folder(spark, "whole-range"), size=3).collect()}
    pairs = {(r.child_ref, r.parent_ref) for r in rp.coverage(spark, raw).collect()}
    assert len(pairs) == 6 and ("cbs_70072ned_motorvoertuigen_gemeente.RegioS", "cbs_70072ned_regiocodes.Identifier") in pairs
    grain = {r.table_name: r.is_unique for r in rp.grain(spark, raw).collect()}
    assert len(grain) == 11 and all(grain[n] is False for n in lists) and grain["cbs_85237ned_personenautos_brandstof"] is True
    dups = {r.table_name: r.n_duplicates for r in rp.full_duplicates(spark, raw).collect()}
    assert len(dups) == 15 and all(dups[n] == 1 for n in lists)
