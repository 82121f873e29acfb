"""The star schema over the TPC-H-style test tables.

Mapping of the warehouse roles onto the test data:

* transaction source with duplicates -> ``lineitem`` (dedup on
  (l_orderkey, l_linenumber), first by (l_partkey, l_suppkey))
* reference-list dimension -> ``supplier`` (derived ``is_active`` flag)
* entity dimension with a denormalised child attribute -> ``customer`` +
  nation name from a filtered nation list
* lookup dimension -> ``part``; where misses are the feature, ``dim_part_short``
  limits it to sizes up to ``PART_DIM_MAX_SIZE`` (lines on larger parts land on
  the unknown member)
* type-1 dimension from distinct values + classification -> ``p_type``
* yearly snapshots for SCD2 -> customer x order year, tracked attribute
  ``max(o_orderpriority)``; where the coverage floor is the feature, the
  series starts in ``SNAPSHOT_FIRST_YEAR`` and the order facts go back further
* calendar -> every year spanned by order and ship dates
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.functions.keys import date_key, surrogate_key
from starkit.operators.calendar import calendar_dim
from starkit.operators.dims import (
    UNKNOWN_KEY,
    bridge,
    latest_version,
    lookup_attribute,
    scd2_from_snapshots,
    type1_dim,
    type1_from_values,
    with_unknown,
)
from starkit.operators.facts import coverage_floor, lookup, temporal_lookup
from starkit.operators.staging import Spec, dedup, typed_projection
from starkit.plans.tables import Tables
from starkit.sources.footers import column_bounds

# Fixed parameters of the test-data star.
PART_DIM_MAX_SIZE = 45
SNAPSHOT_FIRST_YEAR = 1996
EXCLUDED_REGION = 4
UNKNOWN_TEXT = "(unknown)"
PART_TYPE_CLASSES = {
    "Regular": ["STANDARD", "PROMO"],
    "Sized": ["LARGE", "MEDIUM", "SMALL"],
}  # ECONOMY deliberately unmapped -> null class

LINEITEM_SPECS = [
    Spec("l_orderkey", "bigint"), Spec("l_partkey", "bigint"), Spec("l_suppkey", "bigint"),
    Spec("l_linenumber", "int"), Spec("l_quantity", "double"), Spec("l_extendedprice", "double"),
    Spec("l_discount", "double"), Spec("l_tax", "double"), Spec("l_returnflag"),
    Spec("l_linestatus"), Spec("l_shipdate", "date"),
]


def _given(d: dict, name: str, build, t: Tables) -> DataFrame:
    """An already materialised input when given, else the lazy definition."""
    return d[name] if d.get(name) is not None else build(t)


def stg_lineitem(t: Tables) -> DataFrame:
    """Typed lineitem, one row per (l_orderkey, l_linenumber)."""
    typed = typed_projection(t.lineitem, LINEITEM_SPECS)
    return dedup(typed, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


def calendar_bounds(t: Tables) -> DataFrame:
    """One row: first and last year over order dates and ship dates, from the
    footers of the files."""
    spans = (column_bounds(t.spark, t.path("orders"), "o_orderdate", t.orders)
             .union(column_bounds(t.spark, t.path("lineitem"), "l_shipdate", t.lineitem)))
    return spans.agg(F.min(F.year("lo")).alias("first_year"), F.max(F.year("hi")).alias("last_year"))


def dim_calendar(t: Tables) -> DataFrame:
    return calendar_dim(calendar_bounds(t))


def _part_dim(parts: DataFrame) -> DataFrame:
    return type1_dim(
        parts, ["p_partkey"], "part_key",
        ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
        {"p_partkey": -1, "p_name": UNKNOWN_TEXT, "p_brand": UNKNOWN_TEXT, "p_type": UNKNOWN_TEXT})


def dim_part(t: Tables) -> DataFrame:
    return _part_dim(t.part)


def dim_part_short(t: Tables) -> DataFrame:
    """The part dimension without the largest sizes: lookups miss on purpose."""
    return _part_dim(t.part.where(F.col("p_size") <= PART_DIM_MAX_SIZE))


def dim_part_type(t: Tables) -> DataFrame:
    return type1_from_values(t.part, "p_type", "part_type_key", PART_TYPE_CLASSES, "type_class",
                             unknown_value=UNKNOWN_TEXT)


def dim_supplier(t: Tables) -> DataFrame:
    return type1_dim(
        t.supplier, ["s_suppkey"], "supplier_key",
        ["s_suppkey", "s_name", "s_nationkey", "s_acctbal",
         (F.col("s_acctbal") >= 0).alias("is_active")],
        {"s_suppkey": -1, "s_name": "Unknown supplier", "is_active": False})


def dim_customer(t: Tables) -> DataFrame:
    nations = t.nation.where(F.col("n_regionkey") != EXCLUDED_REGION)
    base = lookup_attribute(t.customer, nations, "c_nationkey", {"nation_name": "n_name"},
                            child_on="n_nationkey")
    return type1_dim(
        base, ["c_custkey"], "customer_key",
        ["c_custkey", F.upper(F.trim("c_name")).alias("c_name"), "c_mktsegment", "c_acctbal",
         "nation_name"],
        {"c_custkey": -1, "c_name": "UNKNOWN", "c_mktsegment": UNKNOWN_TEXT})


def customer_snapshots(t: Tables, first_year: int | None = None) -> DataFrame:
    """Customer x order year: tracked ``priority`` and carried ``status``."""
    o = t.orders.select("o_custkey", F.year("o_orderdate").alias("order_year"),
                        "o_orderpriority", "o_orderstatus")
    if first_year is not None:
        o = o.where(F.col("order_year") >= first_year)
    return o.groupBy("o_custkey", "order_year").agg(
        F.max("o_orderpriority").alias("priority"), F.max("o_orderstatus").alias("status"))


def dim_customer_versions(t: Tables, first_year: int | None = None) -> DataFrame:
    """Versions of a customer's priority over all order years, or from
    ``first_year`` on."""
    # the latest year straight from the dates: a one-column scan, no second aggregate
    latest = t.orders.agg(F.year(F.max("o_orderdate"))).scalar()
    v = scd2_from_snapshots(customer_snapshots(t, first_year), "o_custkey", "order_year",
                            tracked=["priority"], carried=["status"], key_col="customer_version_key",
                            latest=latest)
    return with_unknown(v, {"customer_version_key": UNKNOWN_KEY, "o_custkey": -1,
                            "priority": UNKNOWN_TEXT, "version_no": 1,
                            "valid_from": F.lit("1900-01-01").cast("date"),
                            "valid_to": F.lit("9999-12-31").cast("date"), "is_current": False})


def bridge_order_part(t: Tables, stg: DataFrame | None = None) -> DataFrame:
    return bridge(stg if stg is not None else stg_lineitem(t), ["l_orderkey"], ["l_partkey"], "l_linenumber",
                  "order_key", "part_key", seq_alias="line_no", main_col="is_main",
                  carry=["l_orderkey"])


def fct_lineitem(t: Tables, dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """Transaction fact at line grain (K11): three lookups to the unknown
    member, degenerate columns, constant additive measure ``n_lines``.
    ``dims`` may hold already materialised inputs (``stg_lineitem``,
    ``dim_calendar``, ``dim_part``, ``dim_supplier``)."""
    d = dims or {}
    s = _given(d, "stg_lineitem", stg_lineitem, t)
    f = lookup(s, _given(d, "dim_calendar", dim_calendar, t), "l_shipdate", "datum", "datum_key",
               out_col="ship_date_key", unknown=-1, bounded_dim=True)
    grain = ["l_orderkey", "l_linenumber"]
    f = lookup(f, _given(d, "dim_part", dim_part, t), "l_partkey", "p_partkey", "part_key", grain=grain)
    f = lookup(f, _given(d, "dim_supplier", dim_supplier, t), "l_suppkey", "s_suppkey", "supplier_key",
               grain=grain)
    return f.select("ship_date_key", "part_key", "supplier_key", "l_orderkey", "l_linenumber",
                    "l_shipdate", "l_returnflag", F.lit(1).alias("n_lines"), "l_quantity")


def orders_per_customer_year(t: Tables) -> DataFrame:
    return (t.orders.select("o_custkey", F.year("o_orderdate").alias("order_year"),
                            F.rint(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
            .groupBy("o_custkey", "order_year")
            .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("cents").alias("total_cents")))


def fct_orders_snapshot(t: Tables, dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """Periodic-snapshot fact (K12): coverage floor from the dimension,
    temporal lookup of the version valid on 1 Jan, period-start date key."""
    d = dims or {}
    # used by the floor and by the temporal lookup: materialise it once
    versions = d["dim_customer_versions"] if d.get("dim_customer_versions") is not None \
        else dim_customer_versions(t, SNAPSHOT_FIRST_YEAR).checkpoint(eager=True)
    facts = orders_per_customer_year(t)
    start = F.make_date(F.col("order_year"), F.lit(1), F.lit(1))
    facts = coverage_floor(facts, start, versions, key_col="customer_version_key")
    f = temporal_lookup(facts, versions, "o_custkey", start, "o_custkey", "customer_version_key",
                        grain=["o_custkey", "order_year"])
    f = f.withColumn("__start", start)
    f = lookup(f, _given(d, "dim_calendar", dim_calendar, t), "__start", "datum", "datum_key",
               out_col="period_date_key", unknown=-1, bounded_dim=True)
    return f.select("period_date_key", "customer_version_key", "o_custkey", "order_year",
                    "n_orders", "total_cents")


def build_star(t: Tables, base: str) -> dict[str, DataFrame]:
    """Materialise the star in dependency order under ``base``: the deduped
    staging once, then the dimensions and the bridge (concurrently), then
    the facts from the written dimensions.  Nothing is computed twice."""
    from starkit.sources.export import materialise

    stg = materialise({"stg_lineitem": stg_lineitem(t)}, base)
    w = materialise({
        "dim_calendar": dim_calendar(t), "dim_part": dim_part(t), "dim_part_type": dim_part_type(t),
        "dim_supplier": dim_supplier(t), "dim_customer": dim_customer(t),
        "dim_customer_versions": dim_customer_versions(t),
        "bridge_order_part": bridge_order_part(t, stg["stg_lineitem"]),
    }, base)
    inputs = {**stg, **w}
    w.update(materialise({"fct_lineitem": fct_lineitem(t, inputs),
                          "fct_orders_snapshot": fct_orders_snapshot(t, inputs)}, base))
    w["stg_lineitem"] = stg["stg_lineitem"]
    return w


def surrogate_columns(t: Tables) -> DataFrame:
    o = t.orders
    return o.select("o_orderkey", surrogate_key("o_orderkey").alias("order_key"),
                    surrogate_key("o_custkey", F.to_date("o_orderdate")).alias("customer_day_key"),
                    date_key(F.to_date("o_orderdate")).alias("order_date_key"))


__all__ = [
    "bridge_order_part", "calendar_bounds", "customer_snapshots", "dim_calendar", "dim_customer",
    "dim_customer_versions", "dim_part", "dim_part_short", "dim_part_type", "dim_supplier", "fct_lineitem",
    "fct_orders_snapshot", "latest_version", "orders_per_customer_year", "stg_lineitem",
    "surrogate_columns",
]
