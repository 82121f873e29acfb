import json
import os

from starkit.sources.landing import string_schema
from starkit.streaming import land_available, landed_stream


def test_incremental_landing_lands_each_file_once(spark, scratch):
    src, out, ckpt = f"{scratch}/src", f"{scratch}/raw.parquet", f"{scratch}/_ckpt"
    os.makedirs(src)

    def page(name, rows):
        with open(f"{src}/{name}.json", "w") as fh:
            fh.writelines(json.dumps(r) + "\n" for r in rows)

    schema = string_schema(["kenteken", "merk", "extra"])
    page("p1", [{"kenteken": "AA", "merk": "X"}, {"kenteken": "BB"}])
    land_available(landed_stream(spark, src, "json", schema, ["kenteken", "merk", "missing"]), out, ckpt)
    assert spark.read.parquet(out).count() == 2
    page("p2", [{"kenteken": "CC", "merk": "Y", "extra": "z"}])
    land_available(landed_stream(spark, src, "json", schema, ["kenteken", "merk", "missing"]), out, ckpt)
    back = spark.read.parquet(out)
    assert sorted(r.kenteken for r in back.collect()) == ["AA", "BB", "CC"]
    assert back.columns == ["kenteken", "merk", "missing"]
    assert all(f.dataType.simpleString() == "string" for f in back.schema)
