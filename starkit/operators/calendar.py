"""Calendar dimension and Dutch public holidays.

Both are generated from a one-row ``bounds`` DataFrame, so the calendar can
be derived lazily from the facts it serves (first/last year of the data)
without a driver round trip.  The output is bounded by the number of days in
the range (366 rows per year), which is what makes it safe to broadcast.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.operators.dims import with_unknown

# Dutch month and weekday names (ISO order, Monday first),
# the public holidays as offsets from Easter Sunday and as fixed dates, the
# name of the April holiday and the year it changed, and the separator used
# when two holidays fall on one date.
MONTH_NAMES = [
    "januari", "februari", "maart", "april", "mei", "juni", "juli",
    "augustus", "september", "oktober", "november", "december",
]
DAY_NAMES = ["maandag", "dinsdag", "woensdag", "donderdag", "vrijdag", "zaterdag", "zondag"]
EASTER_OFFSETS = {
    "Goede Vrijdag": -2,
    "Eerste Paasdag": 0,
    "Tweede Paasdag": 1,
    "Hemelvaartsdag": 39,
    "Eerste Pinksterdag": 49,
    "Tweede Pinksterdag": 50,
}
FIXED_DATES = {
    "Nieuwjaarsdag": (1, 1),
    "Bevrijdingsdag": (5, 5),
    "Eerste Kerstdag": (12, 25),
    "Tweede Kerstdag": (12, 26),
}
KINGS_DAY, KINGS_DAY_DATE = "Koningsdag", (4, 27)
QUEENS_DAY, QUEENS_DAY_DATE = "Koninginnedag", (4, 30)
KINGS_DAY_FROM_YEAR = 2014
HOLIDAY_SEPARATOR = " en "
UNKNOWN_DATE = _dt.date(1900, 1, 1)


def year_bounds(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One-row DataFrame ``(first_year, last_year)`` for a literal range."""
    return spark.range(1).select(F.lit(first_year).cast("int").alias("first_year"),
                                 F.lit(last_year).cast("int").alias("last_year"))


def year_bounds_of(df: DataFrame, date_col: str) -> DataFrame:
    """One-row bounds covering every year present in ``df[date_col]``."""
    return df.agg(F.min(F.year(date_col)).alias("first_year"),
                  F.max(F.year(date_col)).alias("last_year"))


def years(bounds: DataFrame) -> DataFrame:
    """One row per year ``jaar`` in [first_year, last_year]."""
    return bounds.select(F.explode(F.sequence("first_year", "last_year")).alias("jaar"))


def _easter_text(year: str) -> str:
    """Easter Sunday of a year (SQL text) by the anonymous Gregorian algorithm;
    every division is an integer division (``div``)."""
    golden, century, of_century = f"({year} % 19)", f"({year} div 100)", f"({year} % 100)"
    moon = f"({century} - ({century} + 8) div 25 + 1) div 3"
    epact = f"((19 * {golden} + {century} - {century} div 4 - {moon} + 15) % 30)"
    to_sunday = f"((32 + 2 * ({century} % 4) + 2 * ({of_century} div 4) - {epact} - {of_century} % 4) % 7)"
    late = f"(({golden} + 11 * {epact} + 22 * {to_sunday}) div 451)"
    day = f"({epact} + {to_sunday} - 7 * {late} + 114)"
    return f"make_date({year}, int({day} div 31), int({day} % 31 + 1))"


def easter_sunday(year: str) -> Column:
    """Easter Sunday of the year in a column."""
    return F.expr(_easter_text(f"int(`{year}`)"))


def _april_text(year: str) -> tuple[str, str]:
    """(date, name) of the April holiday as SQL texts: King's Day from 2014,
    Queen's Day before; when the day is a Sunday it moves to the Saturday before."""
    def on(m: int, d: int) -> str:
        day = f"make_date({year}, {m}, {d})"
        return f"if(weekday({day}) = 6, date_sub({day}, 1), {day})"
    kings = f"{year} >= {KINGS_DAY_FROM_YEAR}"
    return (f"if({kings}, {on(*KINGS_DAY_DATE)}, {on(*QUEENS_DAY_DATE)})", f"if({kings}, '{KINGS_DAY}', '{QUEENS_DAY}')")


def nl_holidays(bounds: DataFrame) -> DataFrame:
    """Dutch public holidays for every year in ``bounds``: one row per date
    (``datum``, ``feestdag``); two holidays on one date are joined with
    ``' en '`` in name order.  Every year yields one struct per holiday
    from the fixed tables above, exploded once; the expressions are one SQL
    text, so building the plan is one call."""
    fixed = [(f"make_date(jaar, {m}, {d})", f"'{name}'") for name, (m, d) in FIXED_DATES.items()]
    moving = [(f"date_add(easter, {off})", f"'{name}'") for name, off in EASTER_OFFSETS.items()]
    listed = ", ".join(f"named_struct('datum', {d}, 'feestdag', {name})" for d, name in [*moving, *fixed, _april_text("jaar")])
    rows = years(bounds).selectExpr("jaar", f"{_easter_text('jaar')} AS easter").selectExpr(f"inline(array({listed}))")
    # At most a handful of names per date, so the per-date list is bounded.
    return rows.groupBy("datum").agg(F.expr(f"array_join(array_sort(collect_list(feestdag)), '{HOLIDAY_SEPARATOR}') AS feestdag"))


def calendar_days(bounds: DataFrame) -> DataFrame:
    """Day spine from 1 Jan of ``first_year`` to 31 Dec of ``last_year``.

    Exploded per year (not one array for the whole range) so no single row
    carries the full spine.
    """
    y = F.col("jaar")
    return years(bounds).select(F.explode(F.sequence(
        F.make_date(y, F.lit(1), F.lit(1)), F.make_date(y, F.lit(12), F.lit(31)),
        F.expr("INTERVAL 1 DAY"))).alias("datum"))


def calendar_dim(bounds: DataFrame, unknown_member: bool = True) -> DataFrame:
    """Calendar dimension (K4): 16 attributes, ISO week with its ISO year,
    weekend / holiday / workday flags and Dutch names; plus the unknown
    member (key -1, 1900-01-01) when requested."""
    def names(values: list[str]) -> str:
        return "array(" + ", ".join(f"'{x}'" for x in values) + ")"

    # The holiday list is bounded by 11 rows per calendar year.
    hol = nl_holidays(bounds).withColumnRenamed("datum", "op")
    days = calendar_days(bounds).withColumn("dag_van_week", F.expr("weekday(datum) + 1"))  # ISO: Monday = 1
    cal = days.join(F.broadcast(hol), days["datum"] == hol["op"], "left").selectExpr(
        "int(date_format(datum, 'yyyyMMdd')) AS datum_key", "datum", "year(datum) AS jaar", "quarter(datum) AS kwartaal", "month(datum) AS maand",
        f"element_at({names(MONTH_NAMES)}, month(datum)) AS maand_naam", "day(datum) AS dag", "dayofyear(datum) AS dag_van_jaar",
        "dag_van_week", f"element_at({names(DAY_NAMES)}, dag_van_week) AS dag_naam", "weekofyear(datum) AS weeknummer",
        "int(extract(YEAROFWEEK FROM datum)) AS iso_jaar", "dag_van_week > 5 AS is_weekend", "op IS NOT NULL AS is_feestdag",
        "feestdag AS feestdag_naam", "dag_van_week < 6 AND op IS NULL AS is_werkdag")
    if not unknown_member:
        return cal
    return with_unknown(cal, {
        "datum_key": -1, "datum": UNKNOWN_DATE, "jaar": 1900, "kwartaal": 1, "maand": 1,
        "maand_naam": "onbekend", "dag": 1, "dag_van_jaar": 1, "dag_van_week": 1,
        "dag_naam": "onbekend", "weeknummer": 1, "iso_jaar": 1900, "is_weekend": False,
        "is_feestdag": False, "feestdag_naam": None, "is_werkdag": False,
    })
