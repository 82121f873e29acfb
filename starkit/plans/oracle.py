"""Independent DuckDB SQL for every catalogued query (the correctness oracle).

Tables are the pre-registered views ``region nation customer supplier part
orders lineitem events``.  Shared building blocks are CTE texts composed per
query; each query's columns are aliased exactly like the Spark output.
"""

from __future__ import annotations

NULL_KEY = "'_dbt_utils_surrogate_key_null_'"


def sk(*cols: str) -> str:
    """md5 surrogate key over string casts joined by '-'."""
    parts = [f"coalesce(CAST({c} AS VARCHAR), {NULL_KEY})" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


STG_LINEITEM = """
stg_lineitem AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_partkey, l_suppkey) = 1
)"""

BOUNDS = """
bounds AS (
  SELECT CAST(least(a, c) AS INTEGER) AS first_year, CAST(greatest(b, d) AS INTEGER) AS last_year
  FROM (SELECT min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS b FROM orders) o,
       (SELECT min(year(l_shipdate)) AS c, max(year(l_shipdate)) AS d FROM lineitem) l
),
yrs AS (
  SELECT CAST(unnest(range(first_year, last_year + 1)) AS INTEGER) AS y FROM bounds
)"""

HOLIDAYS = """
easter AS (
  -- anonymous Gregorian computus, all integer arithmetic
  SELECT y, make_date(y, CAST(n // 31 AS INTEGER), CAST(n % 31 + 1 AS INTEGER)) AS sunday
  FROM (
    SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n
    FROM (
      SELECT y, a, h, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l
      FROM (
        SELECT y, a, b, c,
               (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h
        FROM (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yrs)
      )
    )
  )
),
easter_offsets(name, days) AS (
  VALUES ('Goede Vrijdag', -2), ('Eerste Paasdag', 0), ('Tweede Paasdag', 1),
         ('Hemelvaartsdag', 39), ('Eerste Pinksterdag', 49), ('Tweede Pinksterdag', 50)
),
fixed_dates(name, m, d) AS (
  VALUES ('Nieuwjaarsdag', 1, 1), ('Bevrijdingsdag', 5, 5), ('Eerste Kerstdag', 12, 25),
         ('Tweede Kerstdag', 12, 26)
),
april AS (
  SELECT y, CASE WHEN y >= 2014 THEN make_date(y, 4, 27) ELSE make_date(y, 4, 30) END AS nominal,
         CASE WHEN y >= 2014 THEN 'Koningsdag' ELSE 'Koninginnedag' END AS name
  FROM yrs
),
holiday_rows AS (
  SELECT CAST(e.sunday + o.days AS DATE) AS datum, o.name AS feestdag FROM easter e, easter_offsets o
  UNION ALL
  SELECT make_date(y.y, f.m, f.d), f.name FROM yrs y, fixed_dates f
  UNION ALL
  SELECT CASE WHEN isodow(nominal) = 7 THEN CAST(nominal - 1 AS DATE) ELSE nominal END, name FROM april
),
holidays AS (
  SELECT datum, string_agg(feestdag, ' en ' ORDER BY feestdag) AS feestdag
  FROM holiday_rows GROUP BY datum
)"""

# From the number of a day in its year: months by where they start, weekdays by
# counting from a Monday, ISO weeks by the Thursday of the week.
CALENDAR = """
month_starts AS (
  SELECT y, m, naam, make_date(y, m, 1) AS van, CASE WHEN m = 12 THEN make_date(y + 1, 1, 1) ELSE make_date(y, m + 1, 1) END AS tot
  FROM yrs, (VALUES (1, 'januari'), (2, 'februari'), (3, 'maart'), (4, 'april'), (5, 'mei'), (6, 'juni'), (7, 'juli'),
                    (8, 'augustus'), (9, 'september'), (10, 'oktober'), (11, 'november'), (12, 'december')) t(m, naam)
),
month_days AS (
  SELECT y, m, naam, van, CAST(unnest(range(0, tot - van)) AS INTEGER) AS nth FROM month_starts
),
numbered AS (
  SELECT y, m, naam, nth + 1 AS d, CAST(van + nth AS DATE) AS day, CAST((van + nth) - make_date(y, 1, 1) AS INTEGER) AS since_new_year,
         CAST((van + nth) - DATE '1900-01-01' AS INTEGER) % 7 AS since_monday
  FROM month_days
),
thursdays AS (
  SELECT *, CAST(day + (3 - since_monday) AS DATE) AS thursday FROM numbered
),
weekdays(since_monday, naam) AS (
  VALUES (0, 'maandag'), (1, 'dinsdag'), (2, 'woensdag'), (3, 'donderdag'), (4, 'vrijdag'), (5, 'zaterdag'), (6, 'zondag')
),
cal AS (
  SELECT CAST(y * 10000 + m * 100 + d AS INTEGER) AS datum_key, day AS datum, y AS jaar, CAST((m + 2) // 3 AS INTEGER) AS kwartaal,
         CAST(m AS INTEGER) AS maand, t.naam AS maand_naam, CAST(d AS INTEGER) AS dag, CAST(since_new_year + 1 AS INTEGER) AS dag_van_jaar,
         CAST(since_monday + 1 AS INTEGER) AS dag_van_week, w.naam AS dag_naam,
         CAST((thursday - make_date(CAST(date_part('year', thursday) AS INTEGER), 1, 1)) // 7 + 1 AS INTEGER) AS weeknummer,
         CAST(date_part('year', thursday) AS INTEGER) AS iso_jaar, since_monday > 4 AS is_weekend,
         feestdag IS NOT NULL AS is_feestdag, feestdag AS feestdag_naam, since_monday < 5 AND feestdag IS NULL AS is_werkdag
  FROM thursdays t JOIN weekdays w USING (since_monday) LEFT JOIN holidays h ON h.datum = t.day
  UNION ALL
  SELECT -1, DATE '1900-01-01', 1900, 1, 1, 'onbekend', 1, 1, 1, 'onbekend', 1, 1900,
         false, false, NULL, false
)"""

def part_dim(where: str = "") -> str:
    return f"""
dim_part AS (
  SELECT {sk('p_partkey')} AS part_key, p_partkey, p_name, p_brand, p_type, p_size
  FROM part {where}
  UNION ALL SELECT '-1', -1, '(unknown)', '(unknown)', '(unknown)', NULL
)"""


DIM_PART, DIM_PART_SHORT = part_dim(), part_dim("WHERE p_size <= 45")

DIM_SUPPLIER = f"""
dim_supplier AS (
  SELECT {sk('s_suppkey')} AS supplier_key, s_suppkey, s_name, s_nationkey, s_acctbal,
         s_acctbal >= 0 AS is_active
  FROM supplier
  UNION ALL SELECT '-1', -1, 'Unknown supplier', NULL, NULL, false
)"""

FCT_LINEITEM = """
fct_lineitem AS (
  SELECT coalesce(c.datum_key, -1) AS ship_date_key,
         coalesce(p.part_key, '-1') AS part_key,
         coalesce(s.supplier_key, '-1') AS supplier_key,
         l.l_orderkey, l.l_linenumber, l.l_shipdate, l.l_returnflag,
         1 AS n_lines, l.l_quantity
  FROM stg_lineitem l
  LEFT JOIN cal c ON l.l_shipdate = c.datum
  LEFT JOIN dim_part p ON l.l_partkey = p.p_partkey
  LEFT JOIN dim_supplier s ON l.l_suppkey = s.s_suppkey
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


STAR_BASE = (STG_LINEITEM, BOUNDS, HOLIDAYS, CALENDAR, DIM_PART, DIM_SUPPLIER, FCT_LINEITEM)
STAR_SHORT = tuple(DIM_PART_SHORT if cte == DIM_PART else cte for cte in STAR_BASE)

ORACLE: dict[str, str] = {}

ORACLE["stg_lineitem_dedup"] = with_(STG_LINEITEM) + "SELECT * FROM stg_lineitem"

ORACLE["nl_holidays"] = with_(BOUNDS, HOLIDAYS) + "SELECT datum, feestdag FROM holidays"

ORACLE["dim_calendar"] = with_(BOUNDS, HOLIDAYS, CALENDAR) + "SELECT * FROM cal"

ORACLE["fct_lineitem"] = with_(*STAR_SHORT) + "SELECT * FROM fct_lineitem"

ORACLE["mart_top_parts"] = with_(*STAR_BASE) + """
SELECT p.p_partkey, p.p_name, f.l_returnflag, CAST(year(f.l_shipdate) AS INTEGER) AS ship_year,
       CAST(sum(f.n_lines) AS BIGINT) AS n_lines,
       CAST(row_number() OVER (PARTITION BY f.l_returnflag, year(f.l_shipdate)
                               ORDER BY sum(f.n_lines) DESC, p.p_partkey DESC) AS INTEGER) AS line_rank
FROM fct_lineitem f JOIN dim_part p ON f.part_key = p.part_key
GROUP BY p.p_partkey, p.p_name, f.l_returnflag, year(f.l_shipdate)
"""

# ---------------------------------------------------------------- staging

ORACLE["stg_orders_typed"] = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderstatus = 'F' AS is_fulfilled,
       o_orderpriority,
       CAST(left(o_orderpriority, 1) AS INTEGER) AS priority_no
FROM orders
"""

ORACLE["stg_numeric_two_step"] = """
SELECT o_orderkey, CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS INTEGER) AS total_int
FROM orders
"""

ORACLE["stg_events_long_to_wide"] = """
SELECT user_id, CAST(ts AS DATE) AS event_date,
       max(value) FILTER (WHERE event_type = 'view') AS view_max,
       max(value) FILTER (WHERE event_type = 'click') AS click_max,
       max(value) FILTER (WHERE event_type = 'purchase') AS purchase_max,
       max(value) FILTER (WHERE event_type = 'signup') AS signup_max,
       max(value) FILTER (WHERE event_type = 'error') AS error_max
FROM events
GROUP BY user_id, CAST(ts AS DATE)
"""

ORACLE["stg_code_decode"] = """
SELECT event_id, user_id,
       CASE event_type WHEN 'view' THEN 'Page view' WHEN 'click' THEN 'Click'
                       WHEN 'purchase' THEN 'Purchase' END AS event_label,
       CAST(ts AS DATE) AS event_date,
       CAST(CAST(CAST(value AS VARCHAR) AS DOUBLE) AS INTEGER) AS value_int
FROM events
WHERE event_type IN ('view', 'click', 'purchase') AND value IS NOT NULL
"""

ORACLE["stg_string_shaping"] = """
SELECT p_partkey,
       upper(trim(p_name)) AS name_norm,
       lpad(regexp_extract(p_brand, '#(\\d+)', 1), 4, '0') AS brand_code,
       lpad(CAST(p_size AS VARCHAR), 1, '0') AS size_first_digit,
       left(p_type, 3) AS type_prefix,
       CAST(length(p_name) AS INTEGER) AS name_len,
       p_brand || '/' || lower(p_type) AS label,
       contains(p_name, 'ring') AS has_ring
FROM part
"""

ORACLE["landing_json_props"] = """
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.note') AS note
FROM events
"""

ORACLE["scan_multi_file"] = """
SELECT 'customer' AS source_name, count(*) AS n_rows, count(DISTINCT c_custkey) AS n_keys,
       count(DISTINCT c_nationkey) AS n_nations, count(*) FILTER (WHERE c_acctbal > 0) AS n_positive_balance
FROM customer
UNION ALL
SELECT 'supplier', count(*), count(DISTINCT s_suppkey), count(DISTINCT s_nationkey),
       count(*) FILTER (WHERE s_acctbal > 0)
FROM supplier
"""

ORACLE["select_codes_by_fragment"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity
FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part
                    WHERE regexp_matches(lower(p_name), 'red|gizmo|anvil|cold|bolt'))
"""

ORACLE["select_prefix_year_window"] = """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(year(l_shipdate) AS INTEGER) AS ship_year
FROM lineitem
WHERE year(l_shipdate) BETWEEN 1996 AND 1998
  AND l_partkey IN (SELECT p_partkey FROM part
                    WHERE p_brand LIKE 'Brand#1%' OR p_brand LIKE 'Brand#2%' OR p_brand = 'Brand#3')
"""

ORACLE["surrogate_keys"] = f"""
SELECT o_orderkey, {sk('o_orderkey')} AS order_key,
       {sk('o_custkey', 'CAST(o_orderdate AS DATE)')} AS customer_day_key,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key
FROM orders
"""

# ---------------------------------------------------------------- dimensions

DIM_PART_TYPE = f"""
dim_part_type AS (
  SELECT {sk('p_type')} AS part_type_key, p_type,
         CASE WHEN p_type IN ('STANDARD', 'PROMO') THEN 'Regular'
              WHEN p_type IN ('LARGE', 'MEDIUM', 'SMALL') THEN 'Sized' END AS type_class
  FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL)
  UNION ALL SELECT '-1', '(unknown)', NULL
)"""

ORACLE["dim_part_type"] = with_(DIM_PART_TYPE) + "SELECT * FROM dim_part_type"
ORACLE["dim_supplier_current"] = with_(DIM_SUPPLIER) + "SELECT * FROM dim_supplier"

ORACLE["dim_customer_denorm"] = f"""
SELECT {sk('c.c_custkey')} AS customer_key, c.c_custkey, upper(trim(c.c_name)) AS c_name,
       c.c_mktsegment, c.c_acctbal, n.n_name AS nation_name
FROM customer c
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 4) n ON c.c_nationkey = n.n_nationkey
UNION ALL SELECT '-1', -1, 'UNKNOWN', '(unknown)', NULL, NULL
"""

def customer_versions(where: str = "") -> str:
    """A version is a start (a snapshot that differs from the one before it)
    with every snapshot up to the next start."""
    return f"""
snap AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
         max(o_orderpriority) AS priority, max(o_orderstatus) AS status
  FROM orders {where} GROUP BY ALL
),
preceded AS (
  SELECT s.*, b.order_year AS year_before, b.priority AS priority_before
  FROM snap s ASOF LEFT JOIN snap b ON s.o_custkey = b.o_custkey AND s.order_year > b.order_year
),
starts AS (
  SELECT o_custkey, order_year AS started,
         rank() OVER of_customer AS version_no,
         coalesce(min(order_year) OVER (of_customer ROWS BETWEEN 1 FOLLOWING AND 1 FOLLOWING), 100000) AS next_start
  FROM preceded
  WHERE year_before IS NULL OR priority IS DISTINCT FROM priority_before
  WINDOW of_customer AS (PARTITION BY o_custkey ORDER BY order_year)
),
spans AS (
  SELECT o_custkey, version_no, started, max(order_year) AS ended,
         any_value(priority) AS priority, max(status) AS status
  FROM starts JOIN snap USING (o_custkey)
  WHERE order_year >= started AND order_year < next_start
  GROUP BY o_custkey, version_no, started
),
versions AS (
  SELECT {sk('o_custkey', 'version_no')} AS customer_version_key, o_custkey, priority, status,
         CAST(version_no AS INTEGER) AS version_no, make_date(started, 1, 1) AS valid_from,
         if(is_current, DATE '9999-12-31', make_date(ended, 12, 31)) AS valid_to, is_current
  FROM (SELECT *, ended >= ALL (SELECT order_year FROM snap) AS is_current FROM spans)
  UNION ALL SELECT '-1', -1, '(unknown)', NULL, 1, DATE '1900-01-01', DATE '9999-12-31', false
)"""


VERSIONS = customer_versions()
VERSIONS_LATE = customer_versions("WHERE year(o_orderdate) >= 1996")

ORACLE["scd2_customer_priority"] = with_(VERSIONS) + "SELECT * FROM versions"

ORACLE["scd2_latest_version"] = with_(VERSIONS) + """
SELECT o_custkey, priority AS priority_now, is_current AS still_current, version_no
FROM versions WHERE customer_version_key <> '-1'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY valid_from DESC) = 1
"""

ORACLE["bridge_order_part"] = with_(STG_LINEITEM) + f"""
SELECT {sk('l_orderkey')} AS order_key, {sk('l_partkey')} AS part_key, l_orderkey,
       l_linenumber AS line_no, l_linenumber = 1 AS is_main
FROM stg_lineitem
"""

# ---------------------------------------------------------------- facts / marts

FCT_ORDERS_SNAPSHOT = """
order_facts AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n_orders,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
  FROM orders GROUP BY o_custkey, year(o_orderdate)
),
order_facts_kept AS (
  SELECT * FROM order_facts
  WHERE make_date(order_year, 1, 1) >= (SELECT min(valid_from) FROM versions
                                         WHERE customer_version_key <> '-1')
),
fct_orders_snapshot AS (
  SELECT coalesce(c.datum_key, -1) AS period_date_key,
         coalesce(v.customer_version_key, '-1') AS customer_version_key,
         k.o_custkey, k.order_year, k.n_orders, k.total_cents
  FROM order_facts_kept k
  LEFT JOIN versions v ON k.o_custkey = v.o_custkey
                      AND make_date(k.order_year, 1, 1) BETWEEN v.valid_from AND v.valid_to
  LEFT JOIN cal c ON c.datum = make_date(k.order_year, 1, 1)
)"""

ORACLE["fct_orders_snapshot"] = (with_(BOUNDS, HOLIDAYS, CALENDAR, VERSIONS_LATE, FCT_ORDERS_SNAPSHOT)
                                 + "SELECT * FROM fct_orders_snapshot")

ORACLE["mart_restated_series"] = with_(BOUNDS, HOLIDAYS, CALENDAR, VERSIONS_LATE, FCT_ORDERS_SNAPSHOT) + """
, newest AS (
  SELECT o_custkey, priority, is_current FROM versions WHERE customer_version_key <> '-1'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY valid_from DESC) = 1
)
SELECT n.priority AS priority_now, v.priority AS priority_then, n.is_current AS still_current,
       f.o_custkey, f.order_year, f.n_orders
FROM fct_orders_snapshot f
JOIN versions v ON f.customer_version_key = v.customer_version_key AND v.customer_version_key <> '-1'
JOIN newest n ON f.o_custkey = n.o_custkey
"""

# class of a type in the part list and in the sales (fixed lists)
ORACLE["mart_share_compare"] = with_(*STAR_BASE) + """
, listed(p_type, part_class) AS (
  VALUES ('STANDARD', 'STANDARD'), ('PROMO', 'PROMO'), ('LARGE', 'LARGE'), ('MEDIUM', 'LARGE'),
         ('SMALL', '(not comparable)')
),
both_sides AS (
  SELECT part_class, 1 AS parts, NULL AS sold
  FROM dim_part LEFT JOIN listed USING (p_type) WHERE p_partkey <> -1
  UNION ALL
  SELECT p_type, NULL, l_quantity
  FROM fct_lineitem JOIN dim_part USING (part_key)
  WHERE p_type IN ('STANDARD', 'PROMO', 'LARGE', 'ECONOMY')
    AND date_trunc('year', l_shipdate) = (SELECT date_trunc('year', max(l_shipdate)) FROM fct_lineitem)
),
-- a missing class on either side matches nothing, so it stays a row of its own
sums AS (
  SELECT part_class, CAST(sum(parts) AS BIGINT) AS n_parts, CAST(sum(sold) AS BIGINT) AS qty,
         coalesce(part_class, '(not comparable)') <> '(not comparable)' AS comparable
  FROM both_sides GROUP BY part_class
),
totals AS (
  SELECT sum(n_parts) FILTER (comparable) AS all_parts, sum(qty) AS all_qty FROM sums
)
SELECT part_class, n_parts, qty, CASE WHEN comparable THEN round(n_parts / all_parts, 4) END AS share_parts,
       round(qty / all_qty, 4) AS share_qty
FROM sums, totals
"""

ORACLE["mart_bridge_measure"] = with_(STG_LINEITEM, DIM_PART_TYPE) + """
, pairs AS (
  SELECT DISTINCT l.l_orderkey, d.type_class
  FROM stg_lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN dim_part_type d ON p.p_type = d.p_type
)
SELECT pr.type_class, count(*) AS n_orders,
       CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM orders o JOIN pairs pr ON o.o_orderkey = pr.l_orderkey
GROUP BY pr.type_class
"""

ORACLE["inspections_distinct"] = """
SELECT count(*) AS n_rows, count(DISTINCT (o_custkey, CAST(o_orderdate AS DATE))) AS n_keys,
       count(DISTINCT o_custkey) AS n_customers
FROM orders
"""

ORACLE["union_distinct_keys"] = """
SELECT o_custkey AS k FROM orders
UNION
SELECT CAST(k AS BIGINT) FROM (VALUES (-1), (0), (999999999)) t(k)
"""

ORACLE["topk_orders"] = """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date
FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 100
"""

# ---------------------------------------------------------------- data quality

DIM_CUSTOMER = f"""
dim_customer AS (
  SELECT {sk('c.c_custkey')} AS customer_key, c.c_custkey, upper(trim(c.c_name)) AS c_name,
         c.c_mktsegment, c.c_acctbal, n.n_name AS nation_name
  FROM customer c
  LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 4) n ON c.c_nationkey = n.n_nationkey
  UNION ALL SELECT '-1', -1, 'UNKNOWN', '(unknown)', NULL, NULL
)"""

BRIDGE = f"""
bridge_order_part AS (
  SELECT {sk('l_orderkey')} AS order_key, {sk('l_partkey')} AS part_key, l_orderkey,
         l_linenumber AS line_no, l_linenumber = 1 AS is_main
  FROM stg_lineitem
)"""

ORDER_INTERVALS = """
order_intervals AS (
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS valid_from,
         CAST(o_orderdate AS DATE) + 30 AS valid_to
  FROM orders
)"""

STAR_ALL = (*STAR_BASE, DIM_PART_TYPE, DIM_CUSTOMER, VERSIONS, FCT_ORDERS_SNAPSHOT, BRIDGE)


def f_unique(t, c):
    return f"SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"


def f_not_null(t, c):
    return f"SELECT * FROM {t} WHERE {c} IS NULL"


def f_relationships(child, c, parent, pc):
    return (f"SELECT ch.{c} FROM {child} ch LEFT JOIN {parent} pa ON ch.{c} = pa.{pc} "
            f"WHERE ch.{c} IS NOT NULL AND pa.{pc} IS NULL")


def f_accepted(t, c, values):
    vals = ", ".join(f"'{v}'" for v in values)
    return f"SELECT {c}, count(*) AS n FROM {t} GROUP BY {c} HAVING {c} NOT IN ({vals})"


def f_unique_comb(t, cols):
    cs = ", ".join(cols)
    return f"SELECT {cs} FROM {t} GROUP BY {cs} HAVING count(*) > 1"


def f_overlaps(t, code, key, fr, to):
    return (f"SELECT DISTINCT a.{code} FROM {t} a JOIN {t} b ON a.{code} = b.{code} "
            f"AND a.{key} <> b.{key} AND a.{fr} <= b.{to} AND a.{to} >= b.{fr}")


def f_unmapped(t, cls, key):
    return f"SELECT * FROM {t} WHERE {key} <> '-1' AND {cls} IS NULL"


def f_gaps(t, code, period):
    # a period that is not its code's first and whose previous period is missing
    return (f"SELECT {code}, {period} FROM {t} EXCEPT SELECT {code}, {period} + 1 FROM {t} "
            f"EXCEPT SELECT {code}, min({period}) FROM {t} GROUP BY {code}")


def f_fact_complete():
    return """SELECT f.*, staged FROM
      (SELECT count(*) AS rows_built,
              count(*) FILTER (ship_date_key = -1 OR '-1' IN (part_key, supplier_key)) AS missed
       FROM fct_lineitem) f,
      (SELECT count(*) AS staged FROM stg_lineitem)
    WHERE missed > 0 OR staged != rows_built"""


def f_current(t, code, cur):
    return f"SELECT {code} FROM {t} WHERE {cur} GROUP BY {code} HAVING count(*) > 1"


def f_unknown(t, key):
    return f"SELECT * FROM {t} WHERE {key} = '-1'"


def count_check(name: str, failing_sql: str) -> str:
    return f"SELECT '{name}' AS check_name, count(*) AS failing_rows FROM ({failing_sql})"


ORACLE["dq_unique"] = count_check("unique_orders_o_custkey", f_unique("orders", "o_custkey"))
ORACLE["dq_not_null"] = with_(DIM_CUSTOMER) + count_check(
    "not_null_dim_customer_nation_name", f_not_null("dim_customer", "nation_name"))
ORACLE["dq_relationships"] = with_(STG_LINEITEM, DIM_PART_SHORT) + count_check(
    "relationships_stg_lineitem_l_partkey", f_relationships("stg_lineitem", "l_partkey", "dim_part", "p_partkey"))
ORACLE["dq_accepted_values"] = count_check(
    "accepted_values_orders_o_orderstatus", f_accepted("orders", "o_orderstatus", ["F", "O"]))
ORACLE["dq_unique_combination"] = count_check(
    "unique_combination_lineitem", f_unique_comb("lineitem", ["l_orderkey", "l_linenumber"]))
ORACLE["dq_no_overlap"] = with_(ORDER_INTERVALS) + count_check(
    "overlaps_order_windows", f_overlaps("order_intervals", "o_custkey", "o_orderkey", "valid_from", "valid_to"))
ORACLE["dq_unmapped_class"] = with_(DIM_PART_TYPE) + count_check(
    "unmapped_dim_part_type", f_unmapped("dim_part_type", "type_class", "part_type_key"))
ORACLE["dq_no_gaps"] = with_(VERSIONS) + count_check(
    "gaps_customer_snapshots", f_gaps("snap", "o_custkey", "order_year"))
ORACLE["dq_fact_complete"] = with_(*STAR_SHORT) + count_check("fact_complete_fct_lineitem", f_fact_complete())
ORACLE["dq_current_version"] = with_(VERSIONS) + count_check(
    "at_most_one_current_customer_versions", f_current("versions", "o_custkey", "is_current"))
ORACLE["dq_no_unknown_member"] = with_(*STAR_SHORT) + count_check(
    "unknown_member_fct_lineitem_part_key", f_unknown("fct_lineitem", "part_key"))

_SUITE = []
for _t, _c in [("cal", "datum_key"), ("dim_part", "part_key"), ("dim_part_type", "part_type_key"),
               ("dim_supplier", "supplier_key"), ("dim_customer", "customer_key"),
               ("versions", "customer_version_key")]:
    _name = {"cal": "dim_calendar", "versions": "dim_customer_versions"}.get(_t, _t)
    _SUITE.append(count_check(f"unique_{_name}_{_c}", f_unique(_t, _c)))
for _t, _c in [("fct_lineitem", "part_key"), ("fct_lineitem", "supplier_key"),
               ("fct_lineitem", "ship_date_key"), ("dim_customer", "nation_name")]:
    _SUITE.append(count_check(f"not_null_{_t}_{_c}", f_not_null(_t, _c)))
for _ch, _c, _pa, _pc in [("fct_lineitem", "part_key", "dim_part", "part_key"),
                          ("fct_lineitem", "supplier_key", "dim_supplier", "supplier_key"),
                          ("fct_lineitem", "ship_date_key", "cal", "datum_key"),
                          ("fct_orders_snapshot", "customer_version_key", "versions", "customer_version_key"),
                          ("bridge_order_part", "part_key", "dim_part", "part_key")]:
    _SUITE.append(count_check(f"relationships_{_ch}_{_c}", f_relationships(_ch, _c, _pa, _pc)))
_SUITE.append(count_check("accepted_values_orders_o_orderstatus", f_accepted("orders", "o_orderstatus", ["F", "O", "P"])))
_SUITE.append(count_check("unique_combination_fct_lineitem", f_unique_comb("fct_lineitem", ["l_orderkey", "l_linenumber"])))
_SUITE.append(count_check("unique_combination_fct_orders_snapshot",
                          f_unique_comb("fct_orders_snapshot", ["o_custkey", "order_year"])))
_SUITE.append(count_check("overlaps_dim_customer_versions",
                          f_overlaps("versions", "o_custkey", "customer_version_key", "valid_from", "valid_to")))
_SUITE.append(count_check("unmapped_dim_part_type", f_unmapped("dim_part_type", "type_class", "part_type_key")))
_SUITE.append(count_check("gaps_customer_snapshots", f_gaps("snap", "o_custkey", "order_year")))
_SUITE.append(count_check("fact_complete_fct_lineitem", f_fact_complete()))
_SUITE.append(count_check("at_most_one_current_dim_customer_versions", f_current("versions", "o_custkey", "is_current")))
_SUITE.append(count_check("unknown_member_fct_orders_snapshot", f_unknown("fct_orders_snapshot", "customer_version_key")))

ORACLE["dq_suite"] = with_(*STAR_ALL) + "SELECT check_name, failing_rows, failing_rows = 0 AS passed FROM (\n" + \
    "\nUNION ALL\n".join(_SUITE) + "\n)"

# ---------------------------------------------------------------- profiling

_PROFILE_COLS = [("c_custkey", "bigint", False), ("c_name", "string", True), ("c_nationkey", "int", False),
                 ("c_acctbal", "double", False), ("c_mktsegment", "string", True)]
ORACLE["profile_columns"] = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, '{ty}' AS column_type, CAST(min({c}) AS VARCHAR) AS min_value,
       CAST(max({c}) AS VARCHAR) AS max_value, count(DISTINCT {c}) AS n_distinct,
       round(CAST(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) AS DOUBLE), 2) AS null_pct,
       {f"round(CAST(100.0 * count(*) FILTER (WHERE trim({c}) = '') / count(*) AS DOUBLE), 2)" if is_str
        else "CAST(0.0 AS DOUBLE)"} AS empty_pct
FROM customer""" for c, ty, is_str in _PROFILE_COLS)

_GRAIN = [("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]),
          ("customer", ["c_custkey"]), ("part", ["p_partkey"]), ("supplier", ["s_suppkey"])]
ORACLE["profile_grain"] = "\nUNION ALL\n".join(
    [f"""SELECT '{t}' AS table_name, '{' + '.join(k)}' AS key_cols, count(*) AS n_rows,
       count(DISTINCT {('(' + ', '.join(k) + ')') if len(k) > 1 else k[0]}) AS n_keys,
       count(*) = count(DISTINCT {('(' + ', '.join(k) + ')') if len(k) > 1 else k[0]}) AS is_unique,
       round(count(*) / nullif(count(DISTINCT {('(' + ', '.join(k) + ')') if len(k) > 1 else k[0]}), 0), 4)
         AS rows_per_key,
       CAST(NULL AS VARCHAR) AS remark
FROM {t}""" for t, k in _GRAIN]
    + ["SELECT 'nation', 'n_nationkey + n_code', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), "
       "CAST(NULL AS BOOLEAN), CAST(NULL AS DOUBLE), 'missing column: n_code'"])

# a row is compared as the text of all its columns
ORACLE["profile_duplicates"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, coalesce(sum(n), 0)::BIGINT AS n_rows, coalesce(sum(n - 1), 0)::BIGINT AS n_duplicates "
    f"FROM (SELECT count(*) AS n FROM (SELECT md5(CAST(t AS VARCHAR)) AS whole FROM {name} t) GROUP BY whole)"
    for name in ("orders", "customer", "part", "supplier", "lineitem"))

ORACLE["profile_duplicate_rows"] = """
SELECT *, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1
"""

_COV = [("lineitem", "l_partkey", "(SELECT * FROM part WHERE p_size <= 45)", "p_partkey", "part_dim"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey", "supplier"),
        ("lineitem", "l_orderkey", "orders", "o_orderkey", "orders"),
        ("orders", "o_custkey", "customer", "c_custkey", "customer")]
ORACLE["profile_coverage"] = "\nUNION ALL\n".join(
    f"""SELECT '{ch}.{cc}' AS child_ref, '{pn}.{pc}' AS parent_ref, count(*) AS n_rows,
       count(DISTINCT ref) AS n_keys, count(*) FILTER (NOT found) AS n_orphans,
       round(100 - 100 * avg(CAST(NOT found AS INTEGER)), 2) AS coverage_pct
FROM (SELECT {cc} AS ref, EXISTS (SELECT 1 FROM {pa} p WHERE p.{pc} = c.{cc}) AS found FROM {ch} c)"""
    for ch, cc, pa, pc, pn in _COV)

# a member appears in its first year and vanishes after its last one
ORACLE["profile_membership_change"] = """
WITH stay AS (
  SELECT o_custkey, CAST(min(year(o_orderdate)) AS INTEGER) AS first_seen,
         CAST(max(year(o_orderdate)) AS INTEGER) AS last_seen
  FROM orders GROUP BY o_custkey
),
events AS (
  SELECT first_seen AS order_year, 1 AS came, 0 AS went FROM stay
  WHERE first_seen > (SELECT min(first_seen) FROM stay)
  UNION ALL
  SELECT last_seen, 0, 1 FROM stay WHERE last_seen < (SELECT max(last_seen) FROM stay)
)
SELECT order_year, CAST(sum(came) AS BIGINT) AS n_new, CAST(sum(went) AS BIGINT) AS n_vanished
FROM events GROUP BY order_year
"""

ORACLE["profile_padding"] = """
WITH texts AS (
  SELECT p_type, 8 AS width, length(p_brand) AS plain FROM part WHERE p_brand IS NOT NULL
), flagged AS (  -- brands hold no blanks of their own: what is padded is what is short
  SELECT p_type, width AS len, least(plain, width) AS trimmed, (plain < width)::INT AS padded FROM texts
), per_type AS (
  SELECT p_type, count(*) AS n_rows, max(len)::INT AS max_len, max(trimmed)::INT AS max_len_trimmed, sum(padded)::BIGINT AS n_padded
  FROM flagged GROUP BY p_type
)
SELECT * FROM per_type WHERE n_padded > 0 ORDER BY n_rows DESC, p_type LIMIT 15
"""

_CASTS = [("o_orderkey", "bigint", "BIGINT"), ("o_orderpriority", "int", "INTEGER"),
          ("o_orderstatus", "date", "DATE"), ("o_orderdate", "date", "DATE"),
          ("o_totalprice", "double", "DOUBLE")]
ORACLE["profile_castability"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS target_type, count(*) FILTER (WHERE s IS NOT NULL AND "
    f"try_cast(s AS {dt}) IS NULL) AS n_unparseable FROM (SELECT CAST({c} AS VARCHAR) AS s FROM orders)"
    for c, t, dt in _CASTS)

ORACLE["profile_value_census"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, coalesce(CAST({c} AS VARCHAR), '(null)') AS value, "
    f"count(*) AS n FROM {t} GROUP BY 3"
    for t, c in [("orders", "o_orderstatus"), ("orders", "o_orderpriority"), ("lineitem", "l_returnflag")])

ORACLE["profile_format_counts"] = """
SELECT
  (SELECT count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))
    AS lines_without_order,
  (SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey))
    AS orders_without_customer,
  (SELECT count(*) FROM lineitem l WHERE NOT EXISTS
     (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 45)) AS lines_without_part_dim,
  (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
    AS duplicate_line_groups,
  (SELECT count(*) FROM part WHERE length(p_name) = 8) AS names_of_8_chars
"""

# ---------------------------------------------------------------- sampling / landing / export

ORACLE["range_boundary"] = """
WITH b AS (
  SELECT (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL ORDER BY c_custkey LIMIT 1 OFFSET 0) AS lo,
         (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL ORDER BY c_custkey LIMIT 1 OFFSET 99) AS hi
),
o AS (SELECT o_orderkey FROM orders, b WHERE o_custkey BETWEEN lo AND hi)
SELECT 'customer' AS table_name, (SELECT count(*) FROM customer, b WHERE c_custkey BETWEEN lo AND hi) AS n_rows,
       lo AS lo_key, hi AS hi_key FROM b
UNION ALL SELECT 'orders', (SELECT count(*) FROM o), lo, hi FROM b
UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o)), lo, hi
FROM b
"""

ORACLE["sample_referential"] = """
WITH keys AS (
  SELECT o_orderkey FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL
                          ORDER BY o_orderkey LIMIT 200)
  UNION
  SELECT CAST(k AS BIGINT) FROM (VALUES (1499), (14999), (99999999)) t(k)
),
so AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM keys))
SELECT 200 AS n_requested, 3 AS n_extra, '1499,14999,99999999' AS extra_keys, (SELECT count(*) FROM keys) AS n_keys,
       (SELECT max(o_orderkey) FROM keys WHERE o_orderkey NOT IN (1499, 14999, 99999999)) AS limit_key,
       (SELECT max(o_orderkey) FROM keys) AS max_key,
       (SELECT CAST(min(year(o_orderdate)) AS INTEGER) FROM so) AS first_order_year,
       (SELECT count(*) FROM so) AS orders_rows,
       (SELECT count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM keys)) AS lineitem_rows,
       (SELECT count(*) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM so)) AS customer_rows
"""

_MANIFEST_COLS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
                  "lineitem": 11, "events": 6}
ORACLE["manifest_upsert"] = "SELECT * FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{t}.parquet' AS file_name, '{'2026-02-01' if t in ('orders', 'lineitem') else '2026-01-01'}'"
    f" AS snapshot_date, count(*) AS n_rows, {n} AS n_columns, count(*) AS expected_rows, true AS reconciled "
    f"FROM {t}" for t, n in _MANIFEST_COLS.items()) + "\n) ORDER BY file_name"

ORACLE["export_roundtrip"] = with_(*STAR_ALL) + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {src}"
    for name, src in [("dim_calendar", "cal"), ("dim_part", "dim_part"), ("dim_part_type", "dim_part_type"),
                      ("dim_supplier", "dim_supplier"), ("dim_customer", "dim_customer"),
                      ("dim_customer_versions", "versions"), ("bridge_order_part", "bridge_order_part"),
                      ("fct_lineitem", "fct_lineitem"), ("fct_orders_snapshot", "fct_orders_snapshot"),
                      ("fct_lineitem_negative_qty", "(SELECT * FROM fct_lineitem WHERE l_quantity < 0)")])

ORACLE["landing_stream_events"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts, CAST(user_id AS VARCHAR) AS user_id,
       event_type, CAST(value AS VARCHAR) AS value, props,
       json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.note') AS note
FROM events
"""

_FILES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
ORACLE["profile_inventory_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{t}.parquet' AS file_name, (SELECT count(*) FROM {t}) AS n_rows, "
    f"(SELECT count(*)::INT FROM (DESCRIBE {t})) AS n_columns" for t in _FILES)

_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORACLE["profile_distinct_sketches"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, "
    f"true AS within_tolerance FROM orders" for c in _ORDER_COLUMNS)

ORACLE["landing_code_list"] = """
SELECT CASE WHEN p_size > 40 THEN p_type END AS "Description", p_partkey::VARCHAR AS "Identifier",
       CASE WHEN p_size <= 25 THEN p_brand END AS "Key", p_name AS "Title"
FROM part
"""
