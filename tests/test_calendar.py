import datetime as dt

from pyspark.sql import functions as F

from starkit.operators.calendar import calendar_dim, easter_sunday, nl_holidays, year_bounds


def test_holiday_and_workday_counts_1990_2029(spark):
    b = year_bounds(spark, 1990, 2029)
    cal = calendar_dim(b, unknown_member=False)
    r = cal.agg(F.count(F.lit(1)).alias("days"), F.count_if("is_feestdag").alias("hol"),
                F.count_if("is_werkdag").alias("work")).first()
    assert (r.days, r.hol, r.work) == (14610, 438, 10134)
    assert nl_holidays(b).count() == 438


def test_two_holidays_on_one_date(spark):
    h = {r.datum: r.feestdag for r in nl_holidays(year_bounds(spark, 2005, 2016)).collect()}
    assert h[dt.date(2005, 5, 5)] == "Bevrijdingsdag en Hemelvaartsdag"
    assert h[dt.date(2016, 5, 5)] == "Bevrijdingsdag en Hemelvaartsdag"


def test_kings_and_queens_day_sunday_rule(spark):
    h = {r.datum: r.feestdag for r in nl_holidays(year_bounds(spark, 2000, 2030)).collect()}
    assert h[dt.date(2014, 4, 26)] == "Koningsdag"      # 27 April 2014 was a Sunday
    assert h[dt.date(2006, 4, 29)] == "Koninginnedag"   # 30 April 2006 was a Sunday
    assert h[dt.date(2013, 4, 30)] == "Koninginnedag"
    assert h[dt.date(2025, 4, 26)] == "Koningsdag"      # 27 April 2025 was a Sunday


def test_easter_known_years(spark):
    known = {1990: dt.date(1990, 4, 15), 2000: dt.date(2000, 4, 23), 2019: dt.date(2019, 4, 21),
             2024: dt.date(2024, 3, 31), 2029: dt.date(2029, 4, 1)}
    df = spark.createDataFrame([(y,) for y in known], "y int").select("y", easter_sunday("y").alias("e"))
    assert {r.y: r.e for r in df.collect()} == known


def test_iso_week_pair_and_unknown_member(spark):
    cal = calendar_dim(year_bounds(spark, 2029, 2029))
    r = cal.where(F.col("datum") == dt.date(2029, 12, 31)).first()
    assert (r.weeknummer, r.iso_jaar, r.jaar, r.dag_naam, r.maand_naam) == (1, 2030, 2029, "maandag", "december")
    u = cal.where(F.col("datum_key") == -1).first()
    assert u.datum == dt.date(1900, 1, 1) and u.is_werkdag is False and u.feestdag_naam is None
    assert cal.count() == 366  # 365 days + unknown


def test_year_bounds_of_a_date_column(spark):
    from starkit.operators.calendar import year_bounds_of

    df = spark.createDataFrame([(dt.date(1997, 3, 1),), (dt.date(2001, 12, 31),), (None,)], "d date")
    r = year_bounds_of(df, "d").first()
    assert (r.first_year, r.last_year) == (1997, 2001)
    assert calendar_dim(year_bounds_of(df, "d"), unknown_member=False).count() == 365 * 5 + 1  # 2000 is a leap year
