import json
import os

import pytest
from pyspark.sql import functions as F

from starkit.sources import landing


def test_read_landed_json_missing_and_nested(spark, scratch):
    os.makedirs(scratch, exist_ok=True)
    with open(f"{scratch}/page.json", "w") as fh:
        fh.write(json.dumps({"a": "x", "b": 1, "c": {"n": [1, 2]}}) + "\n")
        fh.write(json.dumps({"a": "y"}) + "\n")
    df = landing.read_landed_json(spark, f"{scratch}/page.json", ["a", "b", "c", "d"])
    rows = [r.asDict() for r in df.collect()]
    assert rows[0]["b"] == "1" and rows[0]["c"] == '{"n": [1, 2]}' and rows[0]["d"] is None
    assert rows[1] == {"a": "y", "b": None, "c": None, "d": None}


def test_write_landing_empty_keeps_schema(spark, scratch):
    df = spark.createDataFrame([], "a long, b string")
    n = landing.write_landing(df, f"{scratch}/empty.parquet", ["a", "b", "c"])
    back = spark.read.parquet(f"{scratch}/empty.parquet")
    assert n == 0 and back.columns == ["a", "b", "c"]
    assert all(f.dataType.simpleString() == "string" for f in back.schema)


def test_upsert_manifest_replaces_and_sorts(spark):
    old = spark.createDataFrame([("b.parquet", "2026-01-01", 5), ("a.parquet", "2026-01-01", 1)],
                                "file_name string, snapshot_date string, n_rows long")
    new = spark.createDataFrame([("b.parquet", "2026-02-01", 7), ("c.parquet", "2026-02-01", 3)],
                                "file_name string, snapshot_date string, n_rows long")
    out = [(r.file_name, r.n_rows) for r in landing.upsert_manifest(old, new).collect()]
    assert out == [("a.parquet", 1), ("b.parquet", 7), ("c.parquet", 3)]


def test_selection_errors_when_empty(spark):
    codes = spark.createDataFrame([("A1", "Personenauto's totaal")], "Identifier string, Title string")
    assert landing.select_by_title(codes, "Title", ["personenauto"]).count() == 1
    with pytest.raises(ValueError):
        landing.select_by_title(codes, "Title", ["bromfiets"])
    df = spark.createDataFrame([(2015,), (2016,)], "y int")
    with pytest.raises(ValueError):
        landing.year_window(df, "y", 2020, 2021)
    regions = spark.createDataFrame([("GM0363",), ("PV27",), ("NL01",), ("LD01",)], "r string")
    assert regions.where(landing.prefix_or_equal("r", ["GM", "PV"], ["NL01"])).count() == 3


def test_read_family_file_name_and_union(spark, scratch):
    spark.createDataFrame([("GM1", "N", "A ")], "RegioS string, Measure string, StringValue string") \
        .write.parquet(f"{scratch}/cbs_gebieden_2015.parquet")
    spark.createDataFrame([("GM1", "N", "A", "extra")], "RegioS string, Measure string, StringValue string, X string") \
        .write.parquet(f"{scratch}/cbs_gebieden_2016.parquet")
    spark.createDataFrame([("M", "t")], "Identifier string, Title string").write.parquet(
        f"{scratch}/cbs_gebieden_measurecodes.parquet")
    fam = landing.read_family(spark, f"{scratch}/cbs_gebieden_[0-9][0-9][0-9][0-9].parquet")
    assert sorted(r[0] for r in fam.select(landing.dataset_name("source_file")).collect()) == [
        "cbs_gebieden_2015", "cbs_gebieden_2016"]
    years = sorted(r[0] for r in fam.select(F.regexp_extract("source_file", r"gebieden_(\d{4})\.parquet", 1)).collect())
    assert years == ["2015", "2016"] and "X" in fam.columns and "Identifier" not in fam.columns


def test_code_list_sorted_columns_and_empty(spark):
    records = spark.createDataFrame([('{"Title": "t", "Identifier": "A1"}',), ('{"Key": 5, "Title": null, "Nested": {"a": [1]}}',), (None,)], "r string")
    codes = landing.code_list(records.where("r is not null"), "r")
    assert codes.columns == ["Identifier", "Key", "Nested", "Title"]
    assert {tuple(r) for r in codes.collect()} == {("A1", None, None, "t"), (None, "5", '{"a":[1]}', None)}
    assert landing.code_list(records.where("false"), "r") is None


def test_code_list_landing_and_its_manifest_entry(spark, scratch):
    records = spark.createDataFrame([('{"b": "1"}',), ('{"a": "2", "b": "3"}',)], "r string")
    entry = landing.land_code_list(records, "r", f"{scratch}/codes.parquet", "2026-03-01")
    assert [tuple(r) for r in entry.collect()] == [("codes.parquet", "2026-03-01", 2, 2, 2)]
    assert spark.read.parquet(f"{scratch}/codes.parquet").columns == ["a", "b"]
    assert landing.land_code_list(records.limit(0), "r", f"{scratch}/none.parquet", "2026-03-01") is None
    assert not os.path.exists(f"{scratch}/none.parquet")


def test_reconciliation_warns_for_a_damaged_file(spark, scratch):
    """Expected rows are observed by the write, written rows counted in the files."""
    import glob
    import warnings

    df = spark.range(1000).repartition(4)
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        landed = {n: landing.land(df.where(f"id % {n} = 0"), f"{scratch}/by{n}.parquet") for n in (1, 2, 2000)}
        assert {n: (x.n_columns, x.expected, x.written) for n, x in landed.items()} == {1: (1, 1000, 1000), 2: (1, 500, 500), 2000: (1, 1, 1)}
        entries = landing.manifest_entries(spark, [(f"by{n}.parquet", "2026-01-01", x) for n, x in landed.items()])
        assert all(r.reconciled for r in landing.reconciled(spark, entries, scratch).collect())
    os.remove(glob.glob(f"{scratch}/by1.parquet/part-*.parquet")[0])
    bad = glob.glob(f"{scratch}/by2.parquet/part-*.parquet")[0]
    with open(bad, "wb") as f:
        f.write(b"no parquet")
    spark.catalog.clearCache()
    with pytest.warns(UserWarning) as said:
        got = {r.file_name: (r.expected_rows, r.n_rows, r.reconciled) for r in landing.reconciled(spark, entries, scratch).collect()}
    assert {m.message.args[0].split(":")[0] for m in said if m.category is UserWarning} == {"by1.parquet", "by2.parquet"}
    assert got["by2000.parquet"] == (1, 1, True)
    assert all(not got[f][2] and got[f][1] < got[f][0] for f in ("by1.parquet", "by2.parquet"))


def test_declared_schema_gives_null_for_a_column_that_a_file_lacks(spark, scratch):
    spark.createDataFrame([("1", "x")], "a string, more string").write.parquet(f"{scratch}/g_n.parquet")
    df = landing.source(spark, scratch, "g", "n", at_least=["A", "b"])
    assert df.columns == ["a", "more", "b"] and [tuple(r) for r in df.collect()] == [("1", "x", None)]
    assert set(t for _, t in df.dtypes) == {"string"}


def test_footers_give_counts_and_exact_bounds(spark, scratch):
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq

    from starkit.sources.footers import column_bounds, footers

    os.makedirs(f"{scratch}/d.parquet")
    days = [dt.datetime(2001, 2, 3) + dt.timedelta(hours=i) for i in range(50)]
    for k, stats in enumerate((True, False)):  # the second file has no statistics
        table = pa.table({"t": pa.array([*days[k * 25: k * 25 + 25], None], pa.timestamp("us")), "v": list(range(26))})
        pq.write_table(table, f"{scratch}/d.parquet/part-{k}.parquet", row_group_size=10, write_statistics=stats)
    got = footers(spark, f"{scratch}/d.parquet", ["t"]).collect()
    assert sorted((r.n_rows, r.n_columns, r.row_groups) for r in got) == [(26, 2, 3), (26, 2, 3)]
    assert {(r.lo_0, r.hi_0) for r in got} == {(days[0], days[24]), (days[25], days[49])}
    assert tuple(column_bounds(spark, f"{scratch}/d.parquet", "t").first()) == (days[0], days[49])
    with_plan = column_bounds(spark, f"{scratch}/d.parquet", "t")
    assert "parquet" not in with_plan._jdf.queryExecution().executedPlan().toString().split("Scan")[-1].split("Location")[0]


def test_reconcile(spark):
    df = spark.createDataFrame([(5, 5), (5, 4)], "e long, w long")
    assert [r[0] for r in df.select(landing.reconcile(F.col("e"), F.col("w"))).collect()] == [True, False]


def test_manifest_json_roundtrip_with_upsert(spark, scratch):
    os.makedirs(scratch, exist_ok=True)
    doc = {"datasets": [
        {"bestand": "b.parquet", "snapshotdatum": "2026-01-01", "rijen": 5, "kolommen": 3,
         "selectiequery": {"$where": "kenteken >= 'A'"}},
        {"bestand": "a.parquet", "snapshotdatum": "2026-01-01", "rijen": 1, "kolommen": 2,
         "selectiequery": {"$filter": None}},
    ]}
    with open(f"{scratch}/_manifest.json", "w") as fh:
        json.dump(doc, fh, indent=2)
    m = landing.read_manifest(spark, f"{scratch}/_manifest.json")
    assert sorted(r.bestand for r in m.collect()) == ["a.parquet", "b.parquet"]
    assert json.loads(m.where("bestand = 'b.parquet'").first().selectiequery) == {"$where": "kenteken >= 'A'"}
    new = spark.createDataFrame([{"bestand": "b.parquet", "snapshotdatum": "2026-02-01", "rijen": 7,
                                  "kolommen": 3, "selectiequery": None}], m.schema)
    up = landing.upsert_manifest(m, new, file_col="bestand", order_col="snapshotdatum")
    landing.write_manifest(up, f"{scratch}/manifest_out", file_col="bestand")
    back = landing.read_manifest(spark, f"{scratch}/manifest_out")
    assert [(r.bestand, r.rijen) for r in back.collect()] == [("a.parquet", 1), ("b.parquet", 7)]
