import datetime as dt

import pytest

from pyspark.sql import functions as F

from starkit.functions import date_key, indicator, numeric_text_to_int, surrogate_key
from starkit.operators.staging import Spec, classify, decode, dedup, land_as_strings, long_to_wide, typed_projection


def test_two_step_numeric_rounds_half_even(spark):
    df = spark.createDataFrame([("268240.0",), ("7.3",), ("2.5",), ("3.5",), ("2.7",), (None,)], "v string")
    assert [r[0] for r in df.select(numeric_text_to_int("v")).collect()] == [268240, 7, 2, 4, 3, None]


def test_indicator_keeps_null(spark):
    df = spark.createDataFrame([("Ja",), ("Nee",), ("N.v.t.",), (None,)], "v string")
    assert [r[0] for r in df.select(indicator("v")).collect()] == [True, False, False, None]


def test_typed_projection_casts_and_renames(spark):
    raw = spark.createDataFrame([("AB12", "5", "2026-03-03T00:00:00.000", "Ja", "N.v.t.")],
                                "k string, n string, d string, i string, s string")
    out = typed_projection(raw, [Spec("k"), Spec("n", "int", "aantal"), Spec("d", "date", "datum"),
                                 Spec("i", "indicator", "is_x"), Spec("s", "string", "status")]).first()
    assert out.asDict() == {"k": "AB12", "aantal": 5, "datum": dt.date(2026, 3, 3), "is_x": True,
                            "status": "N.v.t."}


def test_land_as_strings_adds_missing_columns(spark):
    df = spark.createDataFrame([(1, 2.5)], "a long, b double")
    out = land_as_strings(df, ["a", "b", "c"])
    assert [f.dataType.simpleString() for f in out.schema] == ["string"] * 3
    assert out.first().asDict() == {"a": "1", "b": "2.5", "c": None}


def test_dedup_keeps_first_with_nulls_last(spark):
    df = spark.createDataFrame([("K", "a", None), ("K", "a", "2"), ("K", "a", "1"), ("L", "b", None)],
                               "k string, t string, o string")
    out = {r.k: r.o for r in dedup(df, ["k", "t"], ["o"]).collect()}
    assert out == {"K": "1", "L": None}


def test_dedup_removes_full_duplicate_and_pads_time(spark):
    rows = [("02BND8", "2026-03-03", "1639", "205", "x"), ("02BND8", "2026-03-03", "1639", "205", "x"),
            ("02BND8", "2026-03-03", "953", "205", "x")]
    df = spark.createDataFrame(rows, "k string, d string, t string, g string, s string")
    df = df.withColumn("t", F.lpad("t", 4, "0"))
    out = dedup(df, ["k", "d", "t", "g"], ["s"])
    assert sorted(r.t for r in out.collect()) == ["0953", "1639"]


def test_long_to_wide(spark):
    df = spark.createDataFrame([(2020, "GM1", "N", "A"), (2020, "GM1", "R", "X"), (2020, "GM2", "N", "B"),
                                (2020, "GM2", "Z", "ignored")], "y int, c string, m string, v string")
    out = {(r.y, r.c): (r.naam, r.regio) for r in
           long_to_wide(df, ["y", "c"], "m", "v", {"N": "naam", "R": "regio"}).collect()}
    assert out == {(2020, "GM1"): ("A", "X"), (2020, "GM2"): ("B", None)}


def test_decode_and_classify_have_no_else(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "v string")
    out = df.select(decode("v", {"a": "A"}).alias("d"), classify("v", {"AB": ["a", "b"]}).alias("c")).collect()
    assert [(r.d, r.c) for r in out] == [("A", "AB"), (None, "AB"), (None, None), (None, None)]


def test_surrogate_key_matches_md5_text_and_null_placeholder(spark):
    import hashlib
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    ph = "_dbt_utils_surrogate_key_null_"
    assert keys == [hashlib.md5(f"a-{ph}".encode()).hexdigest(), hashlib.md5(f"{ph}-a".encode()).hexdigest()]


def test_date_key(spark):
    df = spark.createDataFrame([(dt.date(2029, 12, 31),), (None,)], "d date")
    assert [r[0] for r in df.select(date_key("d")).collect()] == [20291231, None]


def test_scale_settings():
    from starkit.session import scale_settings

    big = scale_settings(100 * 1024 ** 4, cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 40000    # 2.6 GB each: no more blocks than the driver can track
    small = scale_settings(10 * 1024 ** 2, cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16      # at least 2 per core


def test_dedup_and_long_to_wide_match_python_models(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    rows_st = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None]),
                                 st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 99)),
                       min_size=1, max_size=30)

    @settings(max_examples=15, deadline=None)
    @given(rows_st)
    def check(rows):
        rows = [(k, m, o, i) for i, (k, m, o, _) in enumerate(rows)]  # i makes the order total
        df = spark.createDataFrame(rows, "k int, m string, o int, i int")
        got = {r.k: (r.o, r.i) for r in dedup(df, ["k"], ["o", "i"]).collect()}
        expect = {}
        for k, m, o, i in sorted(rows, key=lambda r: (r[2] is None, r[2] if r[2] is not None else 0, r[3])):
            expect.setdefault(k, (o, i))
        assert got == expect
        wide = {r.k: (r.va, r.vb) for r in long_to_wide(df, ["k"], "m", "o", {"a": "va", "b": "vb"}).collect()}
        model = {}
        for k, m, o, i in rows:
            va, vb = model.get(k, (None, None))
            if m == "a" and o is not None:
                va = o if va is None else max(va, o)
            if m == "b" and o is not None:
                vb = o if vb is None else max(vb, o)
            model[k] = (va, vb)
        assert wide == model

    check()


def test_range_of_too_few_keys_raises(spark):
    from starkit.sources.sample import fixed_bounds, key_range

    df = spark.createDataFrame([(i,) for i in range(5)], "k long")
    assert fixed_bounds(key_range(df, "k", 5)) == (0, 4)
    with pytest.raises(ValueError):
        fixed_bounds(key_range(df, "k", 6))


def test_profile_of_an_empty_table(spark):
    from starkit.operators.profile import column_profile

    rows = column_profile(spark.createDataFrame([], "a string, b int")).collect()
    assert {r.column_name for r in rows} == {"a", "b"}
    assert all(r.null_pct is None and r.empty_pct is None for r in rows)


def test_shares_of_a_zero_total(spark):
    from starkit.operators.marts import compare_shares

    a = spark.createDataFrame([("x", 0)], "cls string, n long")
    b = spark.createDataFrame([("x", 0)], "cls string, m long")
    rows = compare_shares(a, b, "cls", "n", "m", "z", "n_share", "m_share").collect()
    assert [(r.n_share, r.m_share) for r in rows] == [(None, None)]
