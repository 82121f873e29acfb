"""Query catalogue over the test tables: one entry per operator family.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads whole tables.
The DuckDB formulation of the same query is in ``starkit.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starkit.functions.casts import numeric_text_to_int
from starkit.functions.keys import surrogate_key
from starkit.functions.scalars import count_of
from starkit.operators import profile as prof
from starkit.operators import checks as chk
from starkit.operators import quality as dq
from starkit.operators.calendar import nl_holidays
from starkit.operators.dims import UNKNOWN_KEY, latest_version
from starkit.operators.marts import bridge_measure, compare_shares, rank_within, restate_series
from starkit.operators.staging import (
    Spec,
    classify,
    decode,
    land_as_strings,
    long_to_wide,
    typed_projection,
)
from starkit.plans import star
from starkit.plans.tables import Tables
from starkit.sources import export as ex
from starkit.sources import sample as smp
from starkit.sources.landing import (
    dataset_name,
    land,
    land_code_list,
    manifest_entries,
    normalise_json,
    prefix_or_equal,
    read_family,
    reconciled,
    select_by_title,
    upsert_manifest,
    year_window,
)
from starkit.streaming.landing import land_available, landed_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return register


# ---------------------------------------------------------------- staging

@query("stg_lineitem_dedup")
def stg_lineitem_dedup(t: Tables) -> DataFrame:
    """One row per (l_orderkey, l_linenumber), first by partkey, suppkey."""
    return star.stg_lineitem(t)


# ---------------------------------------------------------------- calendar

@query("nl_holidays")
def q_nl_holidays(t: Tables) -> DataFrame:
    """Dutch holidays for every year the order and ship dates span."""
    return nl_holidays(star.calendar_bounds(t))


@query("dim_calendar")
def q_dim_calendar(t: Tables) -> DataFrame:
    """Calendar over the data's years plus the unknown member."""
    return star.dim_calendar(t)


# ---------------------------------------------------------------- facts / marts

def fct_with_misses(t: Tables, stg: DataFrame | None = None) -> DataFrame:
    """The line fact over the size-limited part dimension, from staged lines
    already written if given."""
    return star.fct_lineitem(t, {"dim_part": star.dim_part_short(t), "stg_lineitem": stg})


@query("fct_lineitem")
def q_fct_lineitem(t: Tables) -> DataFrame:
    """Line fact with three lookups to the unknown member;
    the part lookup misses on purpose."""
    return fct_with_misses(t)


@query("mart_top_parts")
def q_mart_top_parts(t: Tables) -> DataFrame:
    """Lines per part x return flag x ship year, ranked within
    (return flag, ship year) by lines desc, part key desc.

    The fact is aggregated on its surrogate key *before* the dimension join
    (the part attributes are functionally dependent on the key), so the
    join sees one row per (part, flag, year) instead of one per line.
    """
    f = star.fct_lineitem(t)
    per_key = (f.groupBy("part_key", "l_returnflag", F.year("l_shipdate").alias("ship_year"))
                .agg(F.sum("n_lines").cast("bigint").alias("n_lines")))
    p = star.dim_part(t).select("part_key", "p_partkey", "p_name")
    agg = per_key.join(p, "part_key", "inner").drop("part_key")
    # Few groups (flag x year), each as large as the part list: split them.
    return rank_within(agg, ["l_returnflag", "ship_year"], ["-n_lines", "-p_partkey"], "line_rank",
                       split_hot_groups=True)


# ---------------------------------------------------------------- staging (typed)


# Fixed parameters of the catalogue queries.
ORDER_SPECS = [
    Spec("o_orderkey", "bigint"), Spec("o_custkey", "bigint"), Spec("o_orderstatus"),
    Spec("o_totalprice", "double"), Spec("o_orderdate", "date"),
    Spec("o_orderstatus", "indicator", "is_fulfilled", true_value="F"),
    Spec("o_orderpriority"),
]
EVENT_TYPES = ["view", "click", "purchase", "signup", "error"]
EVENT_LABELS = {"view": "Page view", "click": "Click", "purchase": "Purchase"}
PROPS_COLUMNS = ["k", "note"]
NAME_FRAGMENTS = ["red", "gizmo", "anvil", "cold", "bolt"]
BRAND_PREFIXES = ["Brand#1", "Brand#2"]
BRAND_EQUALS = ["Brand#3"]
SHIP_YEAR_FIRST, SHIP_YEAR_LAST = 1996, 1998
SHARE_A_CLASSES = {
    "STANDARD": ["STANDARD"], "PROMO": ["PROMO"], "LARGE": ["LARGE", "MEDIUM"],
    "(not comparable)": ["SMALL"],
}  # ECONOMY unmapped -> null class
SHARE_B_CODES = {"STANDARD": "STANDARD", "PROMO": "PROMO", "LARGE": "LARGE", "ECONOMY": "ECONOMY"}
NOT_COMPARABLE = "(not comparable)"
EXTRA_CUSTKEYS = [-1, 0, 999999999]
TOPK = 100


@query("stg_orders_typed")
def q_stg_orders_typed(t: Tables) -> DataFrame:
    """Orders landed as text, then typed by a spec list."""
    raw = land_as_strings(t.orders)
    typed = typed_projection(raw, ORDER_SPECS)
    return typed.withColumn("priority_no", F.left(F.col("o_orderpriority"), F.lit(1)).cast("int"))


@query("stg_numeric_two_step")
def q_stg_numeric_two_step(t: Tables) -> DataFrame:
    """P5: price text -> double -> rint -> int."""
    raw = land_as_strings(t.orders, ["o_orderkey", "o_totalprice"])
    return raw.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                      numeric_text_to_int("o_totalprice").alias("total_int"))


@query("stg_events_long_to_wide")
def q_stg_events_long_to_wide(t: Tables) -> DataFrame:
    """A4: user x day, max(value) per event type as columns."""
    ev = t.events.withColumn("event_date", F.to_date("ts"))
    return long_to_wide(ev, ["user_id", "event_date"], "event_type", "value",
                        {e: f"{e}_max" for e in EVENT_TYPES})


@query("stg_code_decode")
def q_stg_code_decode(t: Tables) -> DataFrame:
    """Decode event types (no else), keep mapped types with a value."""
    ev = t.events.where(F.col("event_type").isin(list(EVENT_LABELS)) & F.col("value").isNotNull())
    return ev.select("event_id", "user_id", decode("event_type", EVENT_LABELS).alias("event_label"),
                     F.to_date("ts").alias("event_date"),
                     numeric_text_to_int(F.col("value").cast("string")).alias("value_int"))


@query("stg_string_shaping")
def q_stg_string_shaping(t: Tables) -> DataFrame:
    """2.7 string family: trim/upper/lower/lpad/left/length/concat/contains."""
    p = t.part
    return p.select(
        "p_partkey",
        F.upper(F.trim("p_name")).alias("name_norm"),
        F.lpad(F.regexp_extract("p_brand", r"#(\d+)", 1), 4, "0").alias("brand_code"),
        F.lpad(F.col("p_size").cast("string"), 1, "0").alias("size_first_digit"),
        F.left(F.col("p_type"), F.lit(3)).alias("type_prefix"),
        F.length("p_name").alias("name_len"),
        F.concat(F.col("p_brand"), F.lit("/"), F.lower("p_type")).alias("label"),
        F.col("p_name").contains("ring").alias("has_ring"),
    )


@query("landing_json_props")
def q_landing_json_props(t: Tables) -> DataFrame:
    """S3: JSON text -> fixed all-string columns, missing key -> null."""
    e = t.events.select("event_id", normalise_json("props", PROPS_COLUMNS).alias("p"))
    return e.select("event_id", *[F.col(f"p.{c}").alias(c) for c in PROPS_COLUMNS])


@query("scan_multi_file")
def q_scan_multi_file(t: Tables) -> DataFrame:
    """Glob over two files, union by name, rows per source file."""
    fam = read_family(t.spark, f"{t.sf_dir}/[cs]u*.parquet")
    key = F.coalesce(F.col("c_custkey"), F.col("s_suppkey"))
    nat = F.coalesce(F.col("c_nationkey"), F.col("s_nationkey"))
    bal = F.coalesce(F.col("c_acctbal"), F.col("s_acctbal"))
    return (fam.withColumn("source_name", dataset_name("source_file"))
               .groupBy("source_name")
               .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"),
                    F.count_distinct(nat).alias("n_nations"),
                    F.count_if(bal > 0).alias("n_positive_balance")))


@query("select_codes_by_fragment")
def q_select_codes_by_fragment(t: Tables) -> DataFrame:
    """Parts whose name contains a fragment -> lines semi-joined."""
    codes = select_by_title(t.part, "p_name", NAME_FRAGMENTS).select("p_partkey")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return li.join(codes, li.l_partkey == codes.p_partkey, "left_semi")


@query("select_prefix_year_window")
def q_select_prefix_year_window(t: Tables) -> DataFrame:
    """Brand prefix-or-equal selection and a ship-year window."""
    parts = t.part.where(prefix_or_equal("p_brand", BRAND_PREFIXES, BRAND_EQUALS)).select("p_partkey")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                           F.year("l_shipdate").alias("ship_year"))
    li = year_window(li, "ship_year", SHIP_YEAR_FIRST, SHIP_YEAR_LAST)
    return li.join(parts, li.l_partkey == parts.p_partkey, "left_semi")


@query("surrogate_keys")
def q_surrogate_keys(t: Tables) -> DataFrame:
    """K1/K2: md5 keys over one and two columns, YYYYMMDD date key."""
    return star.surrogate_columns(t)


# ---------------------------------------------------------------- dimensions

@query("dim_part_type")
def q_dim_part_type(t: Tables) -> DataFrame:
    """Distinct part types, classification without else, unknown."""
    return star.dim_part_type(t)


@query("dim_supplier_current")
def q_dim_supplier_current(t: Tables) -> DataFrame:
    """K7: reference list with a derived flag, plus the unknown member."""
    return star.dim_supplier(t)


@query("dim_customer_denorm")
def q_dim_customer_denorm(t: Tables) -> DataFrame:
    """Customer with normalised name and the nation name from a
    filtered nation list, plus the unknown member."""
    return star.dim_customer(t)


@query("scd2_customer_priority")
def q_scd2_customer_priority(t: Tables) -> DataFrame:
    """Versions of a customer's order priority."""
    return star.dim_customer_versions(t)


@query("scd2_latest_version")
def q_scd2_latest_version(t: Tables) -> DataFrame:
    """Newest version per customer (not the current flag)."""
    v = star.dim_customer_versions(t)
    newest = latest_version(v, "o_custkey", unknown_key_col="customer_version_key")
    return newest.select("o_custkey", F.col("priority").alias("priority_now"),
                         F.col("is_current").alias("still_current"), "version_no")


@query("bridge_order_part")
def q_bridge_order_part(t: Tables) -> DataFrame:
    """Order x part bridge with line sequence and main-line flag."""
    return star.bridge_order_part(t)


# ---------------------------------------------------------------- facts / marts

@query("fct_orders_snapshot")
def q_fct_orders_snapshot(t: Tables) -> DataFrame:
    """Customer x year snapshot fact, temporal lookup."""
    return star.fct_orders_snapshot(t)


@query("mart_restated_series")
def q_mart_restated_series(t: Tables) -> DataFrame:
    """Priority then (version valid then) vs now (newest version)."""
    # the versions feed the fact (floor, temporal lookup) and both sides of the
    # restatement: materialise them once (shared checkpoint folder)
    v = star.dim_customer_versions(t, star.SNAPSHOT_FIRST_YEAR).checkpoint(eager=True)
    f = star.fct_orders_snapshot(t, {"dim_customer_versions": v})
    out = restate_series(f, v, "customer_version_key", "o_custkey",
                         then_cols={"priority_then": "priority"},
                         now_cols={"priority_now": "priority", "still_current": "is_current"})
    return out.select("priority_now", "priority_then", "still_current", "o_custkey", "order_year",
                      "n_orders")


@query("mart_share_compare")
def q_mart_share_compare(t: Tables) -> DataFrame:
    """Part-type share of the part list vs quantity share in
    the latest ship year."""
    parts = star.dim_part(t).where(F.col("part_key") != UNKNOWN_KEY)
    a = (parts.groupBy(classify("p_type", SHARE_A_CLASSES).alias("part_class"))
              .agg(F.count(F.lit(1)).alias("n_parts")))
    f = star.fct_lineitem(t).withColumn("ship_year", F.year("l_shipdate"))
    # One pass over the fact: quantity per (part, ship year) before the join, so
    # the lines on the unknown member meet it as one row a year; then per (ship
    # year, class), unmapped classes included so the latest year is the latest
    # of the whole fact; the latest year is then read off this aggregate
    # (bounded: years x classes rows).
    per_part = f.groupBy("part_key", "ship_year").agg(F.sum("l_quantity").alias("qty"))
    per_year = (per_part.join(star.dim_part(t).select("part_key", "p_type"), "part_key", "inner")
                 .groupBy("ship_year", decode("p_type", SHARE_B_CODES).alias("part_class"))
                 .agg(F.sum("qty").alias("qty")))
    per_year = per_year.withColumn("__latest", F.max("ship_year").over(Window.partitionBy()))
    b = (per_year.where((F.col("ship_year") == F.col("__latest")) & F.col("part_class").isNotNull())
                 .select("part_class", F.col("qty").cast("bigint").alias("qty")))
    return compare_shares(a, b, "part_class", "n_parts", "qty", NOT_COMPARABLE,
                          "share_parts", "share_qty")


@query("mart_bridge_measure")
def q_mart_bridge_measure(t: Tables) -> DataFrame:
    """Orders and order value per part class through the order-part
    bridge, each order counted once per class."""
    br = star.bridge_order_part(t)
    part_class = (t.part.join(star.dim_part_type(t), "p_type", "inner")
                  .select(surrogate_key("p_partkey").alias("part_key"), "type_class"))
    facts = t.orders.select(surrogate_key("o_orderkey").alias("order_key"),
                            F.rint(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    return bridge_measure(facts, "order_key", br, "order_key", "part_key", part_class, "part_key",
                          "type_class", [F.count(F.lit(1)).alias("n_orders"),
                                         F.sum("cents").alias("total_cents")])


@query("inspections_distinct")
def q_inspections_distinct(t: Tables) -> DataFrame:
    """Exact distinct over a composite key (a null member counts)."""
    o = t.orders
    return o.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct(F.struct("o_custkey", F.to_date("o_orderdate"))).alias("n_keys"),
                 F.count_distinct("o_custkey").alias("n_customers"))


@query("union_distinct_keys")
def q_union_distinct_keys(t: Tables) -> DataFrame:
    """Customer keys of all orders union (distinct) literal keys."""
    extra = t.spark.createDataFrame([(k,) for k in EXTRA_CUSTKEYS], "k bigint")
    return t.orders.select(F.col("o_custkey").alias("k")).union(extra).distinct()


@query("topk_orders")
def q_topk_orders(t: Tables) -> DataFrame:
    """O1/O2: the 100 largest orders, ties broken by key (the limit is the
    report): planned as TakeOrderedAndProject, a per-partition top-k."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice",
                        F.to_date("o_orderdate").alias("order_date"))
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc()).limit(TOPK)


# ---------------------------------------------------------------- data quality


ORDER_STATUS_ACCEPTED = ["F", "O"]
ORDER_WINDOW_DAYS = 30


def order_intervals(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    return t.orders.select("o_custkey", "o_orderkey", d.alias("valid_from"),
                           F.date_add(d, ORDER_WINDOW_DAYS).alias("valid_to"))


@query("dq_unique")
def q_dq_unique(t: Tables) -> DataFrame:
    """Is orders one row per customer? (no: duplicated customer keys)."""
    return dq.failure_count("unique_orders_o_custkey", dq.unique(t.orders, "o_custkey"))


@query("dq_not_null")
def q_dq_not_null(t: Tables) -> DataFrame:
    """Customers without a denormalised nation name."""
    return dq.failure_count("not_null_dim_customer_nation_name",
                            dq.not_null(star.dim_customer(t), "nation_name"))


@query("dq_relationships")
def q_dq_relationships(t: Tables) -> DataFrame:
    """D3: staged lines whose part is not in the (size-limited) part dimension."""
    return dq.failure_count("relationships_stg_lineitem_l_partkey",
                            dq.relationships(star.stg_lineitem(t), "l_partkey", star.dim_part_short(t), "p_partkey"))


@query("dq_accepted_values")
def q_dq_accepted_values(t: Tables) -> DataFrame:
    """Order status values outside F/O."""
    return dq.failure_count("accepted_values_orders_o_orderstatus",
                            dq.accepted_values(t.orders, "o_orderstatus", ORDER_STATUS_ACCEPTED))


@query("dq_unique_combination")
def q_dq_unique_combination(t: Tables) -> DataFrame:
    """Duplicated (l_orderkey, l_linenumber) in the raw lines."""
    return dq.failure_count("unique_combination_lineitem",
                            dq.unique_combination(t.lineitem, ["l_orderkey", "l_linenumber"]))


@query("dq_no_overlap")
def q_dq_no_overlap(t: Tables) -> DataFrame:
    """Customers with overlapping 30-day order windows."""
    return dq.failure_count("overlaps_order_windows",
                            dq.overlaps(order_intervals(t), "o_custkey", "o_orderkey", "valid_from", "valid_to",
                                        split_hot_groups=True))


@query("dq_unmapped_class")
def q_dq_unmapped_class(t: Tables) -> DataFrame:
    """Part types without a class (unknown member excluded)."""
    return dq.failure_count("unmapped_dim_part_type",
                            dq.unmapped(star.dim_part_type(t), "type_class", "part_type_key"))


@query("dq_no_gaps")
def q_dq_no_gaps(t: Tables) -> DataFrame:
    """Gaps in a customer's yearly snapshot series."""
    return dq.failure_count("gaps_customer_snapshots",
                            dq.gaps(star.customer_snapshots(t), "o_custkey", "order_year"))


def _fact_complete(fct: DataFrame, stg: DataFrame) -> DataFrame:
    return dq.fact_completeness(fct, stg, {
        "unknown_date": ("ship_date_key", -1), "unknown_part": ("part_key", UNKNOWN_KEY),
        "unknown_supplier": ("supplier_key", UNKNOWN_KEY)})


@query("dq_fact_complete")
def q_dq_fact_complete(t: Tables) -> DataFrame:
    """Line fact rows = staged rows and no unknown-member lookups.  The
    staged lines are written once: the fact is built from the files, and
    their footers hold the count, so the dedup runs once."""
    stg = ex.materialise({"stg_lineitem": star.stg_lineitem(t)}, ex.run_folder(t.spark, "staged"))["stg_lineitem"]
    return dq.failure_count("fact_complete_fct_lineitem", _fact_complete(fct_with_misses(t, stg), stg))


@query("dq_current_version")
def q_dq_current_version(t: Tables) -> DataFrame:
    """Customers with more than one current version."""
    return dq.failure_count("at_most_one_current_customer_versions",
                            dq.at_most_one_current(star.dim_customer_versions(t), "o_custkey", "is_current"))


@query("dq_no_unknown_member")
def q_dq_no_unknown_member(t: Tables) -> DataFrame:
    """Line facts on the unknown part."""
    return dq.failure_count("unknown_member_fct_lineitem_part_key",
                            dq.on_unknown_member(fct_with_misses(t), "part_key"))


def star_suite(w: dict[str, DataFrame], t: Tables) -> list[chk.Check]:
    """The check list of the star (names are ``<test>_<table>_<column>``)."""
    unknown = {"ship_date_key": -1, "part_key": UNKNOWN_KEY, "supplier_key": UNKNOWN_KEY}
    v = w["dim_customer_versions"]
    return [
        *[chk.unique(table, col) for table, col in [
            ("dim_calendar", "datum_key"), ("dim_part", "part_key"), ("dim_part_type", "part_type_key"),
            ("dim_supplier", "supplier_key"), ("dim_customer", "customer_key"),
            ("dim_customer_versions", "customer_version_key")]],
        *[chk.not_null(table, col) for table, col in [
            ("fct_lineitem", "part_key"), ("fct_lineitem", "supplier_key"), ("fct_lineitem", "ship_date_key"),
            ("dim_customer", "nation_name")]],
        *[chk.relationships(*r) for r in [
            ("fct_lineitem", "part_key", "dim_part", "part_key"),
            ("fct_lineitem", "supplier_key", "dim_supplier", "supplier_key"),
            ("fct_lineitem", "ship_date_key", "dim_calendar", "datum_key"),
            ("fct_orders_snapshot", "customer_version_key", "dim_customer_versions", "customer_version_key"),
            ("bridge_order_part", "part_key", "dim_part", "part_key")]],
        chk.accepted_values("orders", "o_orderstatus", ["F", "O", "P"]),
        chk.unique_combination("fct_lineitem", ["l_orderkey", "l_linenumber"]),
        chk.unique_combination("fct_orders_snapshot", ["o_custkey", "order_year"]),
        chk.no_rows("overlaps_dim_customer_versions",
                    dq.overlaps(v, "o_custkey", "customer_version_key", "valid_from", "valid_to")),
        chk.unmapped("unmapped_dim_part_type", "dim_part_type", "type_class", "part_type_key"),
        chk.no_rows("gaps_customer_snapshots", dq.gaps(star.customer_snapshots(t), "o_custkey", "order_year")),
        chk.complete("fact_complete_fct_lineitem", "fct_lineitem", w["stg_lineitem"], unknown),
        chk.no_rows("at_most_one_current_dim_customer_versions", dq.at_most_one_current(v, "o_custkey", "is_current")),
        chk.unknown_member("unknown_member_fct_orders_snapshot", "fct_orders_snapshot", "customer_version_key"),
    ]


@query("dq_suite")
def q_dq_suite(t: Tables) -> DataFrame:
    """The star is materialised once (shared folder), then the check
    planner runs every check against the written tables in one job."""
    w = star.build_star(t, ex.run_folder(t.spark, "star"))
    return chk.run_checks({**w, "orders": t.orders}, star_suite(w, t))


# ---------------------------------------------------------------- profiling

GRAIN_CANDIDATES = {
    "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "customer": ["c_custkey"],
    "part": ["p_partkey"], "supplier": ["s_suppkey"], "nation": ["n_nationkey", "n_code"],
}
CASTABILITY_TARGETS = {"o_orderkey": "bigint", "o_orderpriority": "int", "o_orderstatus": "date",
                       "o_orderdate": "date", "o_totalprice": "double"}
PAD_WIDTH = 8
TOP_PADDED = 15
NAME_LENGTH_PROBE = 8


@query("profile_columns")
def q_profile_columns(t: Tables) -> DataFrame:
    """Column profile of customer, exact distinct counts."""
    return prof.column_profile(t.customer, exact=True)


@query("profile_columns_approx")
def q_profile_columns_approx(t: Tables) -> DataFrame:
    """Column profile of lineitem with HyperLogLog distinct counts."""
    return prof.column_profile(t.lineitem, exact=False)


@query("profile_distinct_sketches")
def q_profile_distinct_sketches(t: Tables) -> DataFrame:
    """Sketches of the columns of orders, stored a file, read back and merged
    for the table; the exact counts beside them, and whether the estimates
    are within tolerance."""
    path = f"{ex.run_folder(t.spark, 'sketches')}/orders.parquet"
    prof.distinct_sketches(t.orders).write.parquet(path)
    merged = prof.merged_sketches(t.spark.read.parquet(path))
    return merged.join(prof.distinct_counts(t.orders), "column_name").select(
        "column_name", "n_rows", "n_null", "n_distinct", prof.within(F.col("sketch"), F.col("n_distinct")).alias("within_tolerance"))


@query("profile_grain")
def q_profile_grain(t: Tables) -> DataFrame:
    """Candidate keys per table; a missing column is a remark."""
    return prof.grain({name: (t.read(name), key) for name, key in GRAIN_CANDIDATES.items()})


@query("profile_duplicates")
def q_profile_duplicates(t: Tables) -> DataFrame:
    """Rows equal on all columns, per table."""
    return prof.duplicate_count({
        "orders": t.orders, "customer": t.customer, "part": t.part, "supplier": t.supplier,
        "lineitem": t.lineitem})


@query("profile_duplicate_rows")
def q_profile_duplicate_rows(t: Tables) -> DataFrame:
    """Lines equal on all columns, with multiplicity."""
    return prof.duplicate_rows(t.lineitem)


@query("profile_coverage")
def q_profile_coverage(t: Tables) -> DataFrame:
    """Referential coverage; the part parent is size-limited."""
    parts = t.part.where(F.col("p_size") <= star.PART_DIM_MAX_SIZE)
    pairs = [
        (t.lineitem, "l_partkey", parts, "p_partkey", "lineitem", "part_dim"),
        (t.lineitem, "l_suppkey", t.supplier, "s_suppkey", "lineitem", "supplier"),
        (t.lineitem, "l_orderkey", t.orders, "o_orderkey", "lineitem", "orders"),
        (t.orders, "o_custkey", t.customer, "c_custkey", "orders", "customer"),
    ]
    out = [prof.coverage(*p) for p in pairs]
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


@query("profile_membership_change")
def q_profile_membership_change(t: Tables) -> DataFrame:
    """Customers new / vanished per order year."""
    o = t.orders.select(F.year("o_orderdate").alias("order_year"), "o_custkey")
    return prof.membership_change(o, "order_year", "o_custkey")


@query("profile_padding")
def q_profile_padding(t: Tables) -> DataFrame:
    """Brand text right-padded to a fixed width, per part type."""
    p = t.part.select("p_type", F.rpad("p_brand", PAD_WIDTH, " ").alias("brand_text"))
    return prof.padding(p, "p_type", "brand_text", TOP_PADDED)


@query("profile_castability")
def q_profile_castability(t: Tables) -> DataFrame:
    """Orders landed as text: values a hard cast would fail on."""
    return prof.castability(land_as_strings(t.orders), CASTABILITY_TARGETS)


@query("profile_value_census")
def q_profile_value_census(t: Tables) -> DataFrame:
    """Value frequencies of status, priority and return flag."""
    return (prof.value_census(t.orders, ["o_orderstatus", "o_orderpriority"], "orders")
            .unionByName(prof.value_census(t.lineitem, ["l_returnflag"], "lineitem")))


@query("profile_format_counts")
def q_profile_format_counts(t: Tables) -> DataFrame:
    """Orphan counts, duplicate key groups and a text-length count.  The
    three references are one tagged group-by, from which the orphans are
    read; lines and orders are scanned once for all their keys."""
    parts = t.part.where(F.col("p_size") <= star.PART_DIM_MAX_SIZE)
    orphans = prof.orphan_counts(
        {"lineitem": t.lineitem, "orders": t.orders, "customer": t.customer, "parts": parts},
        {"lines_without_order": ("lineitem", "l_orderkey", "orders", "o_orderkey"),
         "orders_without_customer": ("orders", "o_custkey", "customer", "c_custkey"),
         "lines_without_part_dim": ("lineitem", "l_partkey", "parts", "p_partkey")}, nulls=True)
    return orphans.select(
        "*", count_of(dq.unique_combination(t.lineitem, ["l_orderkey", "l_linenumber"])).alias("duplicate_line_groups"),
        t.part.agg(F.count_if(F.length("p_name") == NAME_LENGTH_PROBE)).scalar().alias("names_of_8_chars"))


@query("profile_inventory")
def q_profile_inventory(t: Tables) -> DataFrame:
    """File inventory from parquet footers only."""
    return prof.parquet_inventory(t.spark, f"{t.sf_dir}/*.parquet")


@query("profile_inventory_counts")
def q_profile_inventory_counts(t: Tables) -> DataFrame:
    """Rows and columns of each file, from parquet footers only."""
    return prof.parquet_inventory(t.spark, f"{t.sf_dir}/*.parquet").select("file_name", "n_rows", "n_columns")


# ---------------------------------------------------------------- sampling / landing / export

RANGE_SIZE = 100
SAMPLE_N = 200
EXTRA_ORDERKEYS = [1499, 14999, 99999999]
MANIFEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
RELANDED = ["orders", "lineitem"]


@query("range_boundary")
def q_range_boundary(t: Tables) -> DataFrame:
    """The first and the 100th customer key fix a range that is
    applied to customers, orders and (through orders) lines."""
    lo, hi = smp.fixed_bounds(smp.key_range(t.customer, "c_custkey", RANGE_SIZE))
    cust = smp.in_range(t.customer, "c_custkey", (lo, hi))
    orders = smp.in_range(t.orders, "o_custkey", (lo, hi))
    lines = t.lineitem.join(orders.select("o_orderkey"), t.lineitem.l_orderkey == orders.o_orderkey, "left_semi")
    rows = (cust.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("customer").alias("table_name"), "n_rows")
            .unionByName(orders.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("orders").alias("table_name"), "n_rows"))
            .unionByName(lines.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("lineitem").alias("table_name"), "n_rows")))
    return rows.select("table_name", "n_rows", F.lit(lo).cast("bigint").alias("lo_key"),
                       F.lit(hi).cast("bigint").alias("hi_key"))


@query("sample_referential")
def q_sample_referential(t: Tables) -> DataFrame:
    """First 200 order keys plus extra keys; lines and the
    customers of the sampled orders follow; one report row."""
    keys = smp.first_keys(t.orders, "o_orderkey", SAMPLE_N, EXTRA_ORDERKEYS)
    orders = smp.restrict_to(t.orders, "o_orderkey", keys, "o_orderkey")
    lines = smp.restrict_to(t.lineitem, "l_orderkey", keys, "o_orderkey")
    custs = t.customer.join(orders.select("o_custkey"), t.customer.c_custkey == orders.o_custkey, "left_semi")
    first_year = orders.agg(F.min(F.year("o_orderdate"))).scalar()
    return smp.sample_report(SAMPLE_N, EXTRA_ORDERKEYS, keys, "o_orderkey",
                             {"orders": orders, "lineitem": lines, "customer": custs},
                             details={"first_order_year": first_year})


@query("manifest_upsert")
def q_manifest_upsert(t: Tables) -> DataFrame:
    """The input tables land as all-string parquet in the shared
    folder; two of them land again under a later date, and their entries
    replace the old ones.  Expected rows are observed by the writes, written
    rows are those of the files, and the two are reconciled."""
    base = ex.run_folder(t.spark, "landing")
    steps = [(n, "2026-01-01") for n in MANIFEST_TABLES] + [(n, "2026-02-01") for n in RELANDED]

    def step(name: str, snapshot: str):
        return f"{name}.parquet", snapshot, land(t.read(name), f"{base}/{snapshot}/{name}.parquet")

    with ThreadPoolExecutor(max_workers=4) as pool:
        landed = list(pool.map(lambda s: step(*s), steps))
    old, new = (manifest_entries(t.spark, part) for part in (landed[:len(MANIFEST_TABLES)], landed[len(MANIFEST_TABLES):]))
    return reconciled(t.spark, upsert_manifest(old, new)).orderBy("file_name")


@query("landing_code_list")
def q_landing_code_list(t: Tables) -> DataFrame:
    """Part codes as JSON records whose keys vary (absent where there is no
    value), landed with the sorted union of the keys and read back."""
    size = F.col("p_size")
    record = F.struct(F.col("p_name").alias("Title"), F.col("p_partkey").alias("Identifier"), F.when(size <= 25, F.col("p_brand")).alias("Key"),
                      F.when(size > 40, F.col("p_type")).alias("Description"))
    path = f"{ex.run_folder(t.spark, 'codes')}/part_codes.parquet"
    land_code_list(t.part.select(F.to_json(record).alias("record")), "record", path, "2026-01-01")
    return t.spark.read.parquet(path)


@query("export_roundtrip")
def q_export_roundtrip(t: Tables) -> DataFrame:
    """Write the star (plus an empty table) to a fresh folder
    in the shared location, read it back, count rows per table."""
    base = ex.run_folder(t.spark, "export")
    written = star.build_star(t, base)
    written.pop("stg_lineitem")
    written.update(ex.materialise(
        {"fct_lineitem_negative_qty": written["fct_lineitem"].where(F.col("l_quantity") < 0)}, base))
    return ex.export_report(written)


# ---------------------------------------------------------------- streaming landing


EVENT_RAW_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query("landing_stream_events")
def q_landing_stream_events(t: Tables) -> DataFrame:
    """S3/S4 as an incremental stream: the events file lands once as
    all-string columns plus the props fields; checkpoint and output live in
    a fresh folder in the shared location; the landed table is read back."""
    base = ex.run_folder(t.spark, "stream")
    stream = landed_stream(t.spark, t.sf_dir, "parquet", t.events.schema, EVENT_RAW_COLUMNS,
                           json_column="props", json_fields=PROPS_COLUMNS, file_filter="events.parquet")
    land_available(stream, f"{base}/events.parquet", f"{base}/_checkpoint")
    return t.spark.read.parquet(f"{base}/events.parquet")
