"""The query catalogue: every operator that returns a table, run over the
whole source tables, with the equivalent SQL used as an independent oracle.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is
the same result in ANSI SQL over the source tables (DuckDB dialect where
they differ). Output columns are named and typed alike on both sides:
money as decimal(18,2), counts as bigint, ratios as one double division.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_marts.functions.columns import month_key
from retail_marts.operators import marts as B
from retail_marts.plans.warehouse import Warehouse, line_rules
from retail_marts.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def wh(spark: SparkSession, d: str) -> Warehouse:
    return Warehouse(spark, d)


# Shared SQL pieces ----------------------------------------------------------

# fact_sales measures in SQL (same rounding as W7).
SALES_CTE = """
sales AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, l.l_partkey AS product_id,
         l.l_suppkey AS seller_id, o.o_custkey AS customer_id, o.o_orderdate AS ordered_at,
         l.l_shipdate AS shipped_at, upper(trim(o.o_orderstatus)) AS order_status,
         l.l_returnflag AS return_flag, l.l_linestatus AS line_status,
         CAST(l.l_quantity AS DECIMAL(18,2)) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS gross_amount,
         CAST(l.l_discount AS DECIMAL(4,2)) AS discount_rate,
         CAST(l.l_tax AS DECIMAL(4,2)) AS tax_rate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
sales_m AS (
  SELECT *, CAST(ROUND(gross_amount * discount_rate, 2) AS DECIMAL(18,2)) AS discount_amount,
         CAST(gross_amount - CAST(ROUND(gross_amount * discount_rate, 2) AS DECIMAL(18,2))
              AS DECIMAL(18,2)) AS net_amount
  FROM sales
)"""


# B2 (flagship) ---------------------------------------------------------------

@query("sales_by_month", f"""
WITH {SALES_CTE},
m AS (
  SELECT CAST(date_trunc('month', ordered_at) AS DATE) AS month,
         CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue,
         COUNT(DISTINCT order_id) AS orders
  FROM sales_m GROUP BY 1
),
sp AS (SELECT CAST(unnest(generate_series(CAST(min(month) AS TIMESTAMP), CAST(max(month) AS TIMESTAMP),
                                          INTERVAL 1 MONTH)) AS DATE) AS month FROM m),
f AS (SELECT sp.month, CAST(coalesce(m.net_revenue, 0) AS DECIMAL(18,2)) AS net_revenue,
             coalesce(m.orders, 0) AS orders FROM sp LEFT JOIN m ON sp.month = m.month),
p AS (SELECT *, LAG(net_revenue) OVER (ORDER BY month) AS prev_net_revenue FROM f)
SELECT month, net_revenue, orders, prev_net_revenue,
       CASE WHEN prev_net_revenue IS NULL OR prev_net_revenue = 0 THEN NULL
            ELSE CAST(net_revenue - prev_net_revenue AS DOUBLE) / CAST(prev_net_revenue AS DOUBLE)
       END AS mom_change
FROM p
""")
def q_sales_by_month(spark, d):
    return B.sales_by_month(wh(spark, d).sales)


@query("sales_by_month_loaded", ORACLE["sales_by_month"])
def q_sales_by_month_loaded(spark, d):
    """B2 from the published warehouse (E6, S3): load, publish, read the month-partitioned fact."""
    from retail_marts.plans.warehouse import load_version
    root = scratch_path(spark, f"published-{uuid.uuid4().hex[:12]}")
    load_version(spark, d, root)
    return B.sales_by_month(Warehouse.from_loaded(spark, root).sales)


# ETL --------------------------------------------------------------------------

from retail_marts.operators import etl as E  # noqa: E402
from retail_marts.operators import warehouse as W  # noqa: E402
from retail_marts.plans import standins  # noqa: E402
from retail_marts.plans.star import customers_model, payments_model, ratings_model, sales_model, slice as star_slice  # noqa: E402
from retail_marts.sources import SCHEMAS, column_totals, read_table  # noqa: E402

_READ_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                "documents", "labels"]


@query("read_table", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, CAST({len(SCHEMAS[t].fields)} AS BIGINT) AS n_columns "
    f"FROM {t}" for t in _READ_TABLES))
def q_read_table(spark, d):
    """Every source read through its declared schema; rows and columns per table."""
    from functools import reduce
    parts = []
    for t in _READ_TABLES:
        df = read_table(spark, d, t)
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                       .select(F.lit(t).alias("table_name"), "row_count",
                               F.lit(len(df.columns)).cast("bigint").alias("n_columns")))
    return reduce(DataFrame.unionByName, parts)


def _contents_sql(t: str) -> str:
    """One line per column of a table: nulls, and the exact sum of a number (to four decimals), of the
    characters of a text or of the days since 1970 of a time."""
    kinds = {"string": "length({0})", "timestamp_ntz": "date_diff('day', DATE '1970-01-01', CAST({0} AS DATE))"}
    one = []
    for f in SCHEMAS[t].fields:
        e = kinds.get(f.dataType.simpleString(), "{0}").format(f.name)
        one.append(f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({f.name}) AS null_count, "
                   f"CAST(coalesce(SUM(CAST({e} AS DECIMAL(28,4))), 0) AS DECIMAL(38,4)) AS total FROM {t}")
    return "\nUNION ALL\n".join(one)


@query("read_table_contents", "\nUNION ALL\n".join(_contents_sql(t) for t in _READ_TABLES))
def q_read_table_contents(spark, d):
    """Every declared column of every source read: rows, nulls and an exact sum."""
    from functools import reduce
    return reduce(DataFrame.unionByName, [column_totals(read_table(spark, d, t), t) for t in _READ_TABLES])


ORDERS_STD_SPEC = {"o_orderstatus": "code", "o_totalprice": "money", "o_orderpriority": "code"}


@query("standardise", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       upper(nullif(trim(o_orderstatus), '')) AS order_status,
       CAST(o_totalprice AS DECIMAL(18,2)) AS total_price,
       o_orderdate AS ordered_at,
       upper(nullif(trim(o_orderpriority), '')) AS priority
FROM orders
""")
def q_standardise(spark, d):
    """E2 on orders."""
    return E.standardise(read_table(spark, d, "orders"), ORDERS_STD_SPEC,
                         {"o_orderkey": "order_id", "o_custkey": "customer_id",
                          "o_orderstatus": "order_status", "o_totalprice": "total_price",
                          "o_orderdate": "ordered_at", "o_orderpriority": "priority"})


@query("latest_per_key", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def q_latest_per_key(spark, d):
    """The latest event of every user (ties by event id)."""
    return E.latest_per_key(read_table(spark, d, "events"), ["user_id"], ["ts", "event_id"])


def _line_checks(spark, d):
    parents = [E.Parent("orders", read_table(spark, d, "orders"), {"l_orderkey": "o_orderkey"}),
               E.Parent("part", read_table(spark, d, "part"), {"l_partkey": "p_partkey"}),
               E.Parent("supplier", read_table(spark, d, "supplier"), {"l_suppkey": "s_suppkey"})]
    return parents, line_rules()


LINE_REASON_SQL = """
CASE WHEN l.l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
          THEN 'missing orders'
     WHEN l.l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
          THEN 'missing part'
     WHEN l.l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)
          THEN 'missing supplier'
     WHEN NOT coalesce(l.l_quantity > 0, false) THEN 'quantity not positive'
     WHEN NOT coalesce(l.l_discount BETWEEN 0 AND 1, false) THEN 'discount outside 0..1'
     WHEN NOT coalesce(l.l_extendedprice >= 0, false) THEN 'price negative'
END"""


@query("split_rejects", f"""
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_shipdate,
       {LINE_REASON_SQL} AS reject_reason
FROM lineitem l
""")
def q_split_rejects(spark, d):
    """E4 on lines: parents orders/part/supplier, value rules; every line with its reason."""
    parents, rules = _line_checks(spark, d)
    f = E.flag_rejects(read_table(spark, d, "lineitem"), rules, parents)
    return f.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "reject_reason")


# Orphans: parents without every third (orders: seventh) key, so that reasons and the unknown member occur.
ORPHAN_REASON_SQL = (LINE_REASON_SQL.replace("o.o_orderkey = l.l_orderkey", "o.o_orderkey = l.l_orderkey AND o.o_orderkey % 7 <> 0")
                     .replace("p.p_partkey = l.l_partkey", "p.p_partkey = l.l_partkey AND p.p_partkey % 3 <> 0")
                     .replace("s.s_suppkey = l.l_suppkey", "s.s_suppkey = l.l_suppkey AND s.s_suppkey % 3 <> 0"))


@query("split_rejects_orphans", f"""
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_shipdate,
       {ORPHAN_REASON_SQL} AS reject_reason
FROM lineitem l
""")
def q_split_rejects_orphans(spark, d):
    """E4 against parents that lack keys; hot and null keys take their own path (skew.match_keys)."""
    (orders, part, supplier), rules = _line_checks(spark, d)
    orders.df, part.df, supplier.df = orders.df.where("o_orderkey % 7 <> 0"), part.df.where("p_partkey % 3 <> 0"), supplier.df.where("s_suppkey % 3 <> 0")
    f = E.flag_rejects(read_table(spark, d, "lineitem"), rules, [orders, part, supplier], spread=["l_orderkey", "l_linenumber"])
    return f.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "reject_reason")


@query("reconcile", f"""
WITH fl AS (SELECT l.*, {LINE_REASON_SQL} AS reason FROM lineitem l),
lo AS (SELECT fl.* FROM fl JOIN orders o ON fl.l_orderkey = o.o_orderkey WHERE fl.reason IS NULL),
fo AS (SELECT o.*, CASE WHEN o.o_custkey IS NOT NULL AND NOT EXISTS
                 (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey) THEN 'missing customer' END AS reason
       FROM orders o),
st AS (
  SELECT 'lineitem' AS t, 'source' AS stage, COUNT(*) AS n, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amt FROM fl
  UNION ALL SELECT 'lineitem', 'accepted', COUNT(*), SUM(CAST(l_extendedprice AS DECIMAL(18,2))) FROM fl WHERE reason IS NULL
  UNION ALL SELECT 'lineitem', 'rejected', COUNT(*), SUM(CAST(l_extendedprice AS DECIMAL(18,2))) FROM fl WHERE reason IS NOT NULL
  UNION ALL SELECT 'lineitem', 'loaded', COUNT(*), SUM(CAST(l_extendedprice AS DECIMAL(18,2))) FROM lo
  UNION ALL SELECT 'orders', 'source', COUNT(*), SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM fo
  UNION ALL SELECT 'orders', 'accepted', COUNT(*), SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM fo WHERE reason IS NULL
  UNION ALL SELECT 'orders', 'rejected', COUNT(*), SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM fo WHERE reason IS NOT NULL
  UNION ALL SELECT 'orders', 'loaded', COUNT(*), SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM fo WHERE reason IS NULL
),
st2 AS (SELECT t, stage, n, CAST(coalesce(amt, 0) AS DECIMAL(18,2)) AS amt FROM st),
w AS (
  SELECT t AS table_name,
    CAST(SUM(CASE WHEN stage='source' THEN n END) AS BIGINT) AS source_rows,
    CAST(SUM(CASE WHEN stage='source' THEN amt END) AS DECIMAL(18,2)) AS source_amount,
    CAST(SUM(CASE WHEN stage='accepted' THEN n END) AS BIGINT) AS accepted_rows,
    CAST(SUM(CASE WHEN stage='accepted' THEN amt END) AS DECIMAL(18,2)) AS accepted_amount,
    CAST(SUM(CASE WHEN stage='rejected' THEN n END) AS BIGINT) AS rejected_rows,
    CAST(SUM(CASE WHEN stage='rejected' THEN amt END) AS DECIMAL(18,2)) AS rejected_amount,
    CAST(SUM(CASE WHEN stage='loaded' THEN n END) AS BIGINT) AS loaded_rows,
    CAST(SUM(CASE WHEN stage='loaded' THEN amt END) AS DECIMAL(18,2)) AS loaded_amount
  FROM st2 GROUP BY t)
SELECT *, coalesce(source_rows = accepted_rows + rejected_rows AND source_amount = accepted_amount + rejected_amount
                   AND accepted_rows = loaded_rows AND accepted_amount = loaded_amount, false) AS balanced
FROM w
""")
def q_reconcile(spark, d):
    """E5: lines and orders through the reject split and the (unwritten) load."""
    parents, rules = _line_checks(spark, d)
    li, orders = read_table(spark, d, "lineitem"), read_table(spark, d, "orders")
    ok, bad = E.split_rejects(li, rules, parents)
    loaded = W.fact_sales(ok, orders)
    o_ok, o_bad = E.split_rejects(orders, {}, [E.Parent("customer", read_table(spark, d, "customer"),
                                                         {"o_custkey": "c_custkey"})])
    return E.reconcile([
        ("lineitem", {"source": li, "accepted": ok, "rejected": bad,
                      "loaded": loaded.withColumnRenamed("gross_amount", "l_extendedprice")},
         "l_extendedprice"),
        ("orders", {"source": orders, "accepted": o_ok, "rejected": o_bad, "loaded": o_ok},
         "o_totalprice")])


def _rows_sql(name: str, cols: str, key: str, period: str, altered: str) -> str:
    """The rows of ``name`` against ``altered`` (a query giving the same columns), as multisets, then by key."""
    key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in key.split(", "))
    return f"""SELECT '{name}' AS table_name, CAST(coalesce(min(p) FILTER (a), min(p)) AS INTEGER) AS period, key,
  CASE WHEN count(*) FILTER (NOT a) < count(*) FILTER (a) THEN 'missing'
       WHEN count(*) FILTER (NOT a) > count(*) FILTER (a) THEN 'extra' ELSE 'changed' END AS difference,
  count(*) FILTER (a) AS source_rows, count(*) FILTER (NOT a) AS loaded_rows
FROM (SELECT true AS a, {key} AS key, {period} AS p FROM {name}
      UNION ALL SELECT false, {key}, {period} FROM ({altered}))
WHERE key IN (SELECT {key} FROM ((SELECT {cols} FROM {name} EXCEPT ALL SELECT {cols} FROM ({altered}))
              UNION ALL (SELECT {cols} FROM ({altered}) EXCEPT ALL SELECT {cols} FROM {name})))
GROUP BY key"""


def _columns(t: str) -> str:
    return ", ".join(f.name for f in SCHEMAS[t].fields)


_LINE_ENDS = "(SELECT {0}(l_orderkey * 100 + l_linenumber) FROM lineitem)"


@query("reconcile_rows", "\nUNION ALL\n".join([
    _rows_sql("orders", _columns("orders"), "o_orderkey", "coalesce(year(o_orderdate) * 100 + month(o_orderdate), -1)",
              """SELECT * REPLACE (o_totalprice + CASE o_orderkey WHEN (SELECT min(o_orderkey) FROM orders) THEN 1
                 WHEN (SELECT max(o_orderkey) FROM orders) THEN -1 ELSE 0 END AS o_totalprice) FROM orders"""),
    _rows_sql("lineitem", _columns("lineitem"), "l_orderkey, l_linenumber", "coalesce(year(l_shipdate) * 100 + month(l_shipdate), -1)",
              f"""SELECT * REPLACE (l_quantity + CASE l_orderkey * 100 + l_linenumber WHEN {_LINE_ENDS.format("min")} THEN 1
                 WHEN {_LINE_ENDS.format("max")} THEN -1 ELSE 0 END AS l_quantity) FROM lineitem"""),
    _rows_sql("events", _columns("events"), "event_id", "coalesce(year(ts) * 100 + month(ts), -1)",
              """SELECT * REPLACE (CASE WHEN event_id = (SELECT max(event_id) FROM events) THEN NULL ELSE props END AS props) FROM events"""),
    _rows_sql("labels", _columns("labels"), "doc_id", "-1",
              """SELECT * FROM labels WHERE doc_id <> (SELECT max(doc_id) FROM labels)
                 UNION ALL SELECT * FROM labels WHERE doc_id = (SELECT min(doc_id) FROM labels)"""),
]))
def q_reconcile_rows(spark, d):
    """E5 by row: whole tables against copies in which two amounts changed so that sums agree, one value became
    null, and one row was lost and another loaded twice."""
    orders, li, ev, lab = (read_table(spark, d, t) for t in ("orders", "lineitem", "events", "labels"))
    line = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    o, l, e, b = (df.agg(F.min(k).alias("lo"), F.max(k).alias("hi")).first()
                  for df, k in ((orders, "o_orderkey"), (li, line), (ev, "event_id"), (lab, "doc_id")))

    def shift(col, key, ends):
        by = F.when(key == ends["lo"], 1.0).when(key == ends["hi"], -1.0).otherwise(0.0)
        return {col: F.col(col) + by}
    return E.reconcile_rows([
        E.Compared("orders", orders, orders.withColumns(shift("o_totalprice", F.col("o_orderkey"), o)), ["o_orderkey"], month_key("o_orderdate")),
        E.Compared("lineitem", li, li.withColumns(shift("l_quantity", line, l)), ["l_orderkey", "l_linenumber"], month_key("l_shipdate")),
        E.Compared("events", ev, ev.withColumn("props", F.when(F.col("event_id") != e["hi"], F.col("props"))), ["event_id"], month_key("ts")),
        E.Compared("labels", lab, lab.where(F.col("doc_id") != b["hi"]).unionByName(lab.where(F.col("doc_id") == b["lo"])), ["doc_id"])])


# Warehouse ------------------------------------------------------------------------

DIM_DATE_SQL = """
WITH b AS (SELECT min(d) AS lo, max(d) AS hi FROM (
    SELECT CAST(o_orderdate AS DATE) AS d FROM orders
    UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem
    UNION ALL SELECT CAST(ts AS DATE) FROM events)),
days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key, date,
       CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
       CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
       CAST(weekofyear(date) AS INTEGER) AS iso_week, CAST(isodow(date) - 1 AS INTEGER) AS weekday,
       CAST(date_trunc('month', date) AS DATE) AS month_start,
       CAST(year(date) * 100 + month(date) AS INTEGER) AS month_key
FROM days
"""


@query("dim_date", DIM_DATE_SQL)
def q_dim_date(spark, d):
    """W1 over every day the orders, lines and events touch."""
    return wh(spark, d).dim_date


GEO_SQL = "nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"


@query("dim_customer", f"""
SELECT sha256(CAST(c_custkey AS VARCHAR)) AS customer_key, c_custkey AS customer_id, c_name AS customer_name,
       g.n_name AS nation, g.r_name AS region, c_mktsegment AS segment,
       CAST(c_acctbal AS DECIMAL(18,2)) AS acct_balance
FROM customer c LEFT JOIN (SELECT * FROM {GEO_SQL}) g ON c.c_nationkey = g.n_nationkey
UNION ALL SELECT '-1', CAST(NULL AS BIGINT), NULL, NULL, NULL, NULL, CAST(NULL AS DECIMAL(18,2))
""")
def q_dim_customer(spark, d):
    """W2."""
    return wh(spark, d).dim_customer


@query("dim_product", """
SELECT sha256(CAST(p_partkey AS VARCHAR)) AS product_key, p_partkey AS product_id, p_name AS product_name,
       p_brand AS brand, p_type AS product_type, p_size AS size,
       CAST(p_retailprice AS DECIMAL(18,2)) AS retail_price
FROM part
UNION ALL SELECT '-1', CAST(NULL AS BIGINT), NULL, NULL, NULL, CAST(NULL AS INTEGER), CAST(NULL AS DECIMAL(18,2))
""")
def q_dim_product(spark, d):
    """W3."""
    return wh(spark, d).dim_product


@query("dim_seller", f"""
SELECT sha256(CAST(s_suppkey AS VARCHAR)) AS seller_key, s_suppkey AS seller_id, s_name AS seller_name,
       g.n_name AS nation, g.r_name AS region, CAST(s_acctbal AS DECIMAL(18,2)) AS acct_balance
FROM supplier s LEFT JOIN (SELECT * FROM {GEO_SQL}) g ON s.s_nationkey = g.n_nationkey
UNION ALL SELECT '-1', CAST(NULL AS BIGINT), NULL, NULL, NULL, CAST(NULL AS DECIMAL(18,2))
""")
def q_dim_seller(spark, d):
    """W4."""
    return wh(spark, d).dim_seller


@query("dim_key", """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, l_suppkey AS seller_id,
       sha256(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
                        CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) AS line_key
FROM lineitem
""")
def q_dim_key(spark, d):
    """Composite key of an order line."""
    from retail_marts.functions.columns import dim_key
    li = read_table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                     F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
                     dim_key("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("line_key"))


@query("lookup", """
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
       coalesce(sha256(CAST(c.c_custkey AS VARCHAR)), '-1') AS customer_key
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def q_lookup(spark, d):
    """Orders to the customer dimension."""
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"),
                                              F.col("o_custkey").alias("customer_id"))
    return W.lookup(o, wh(spark, d).dim_customer, {"customer_id": "customer_id"}, "customer_key")


@query("lookup_orphans", """
SELECT e.event_id, e.user_id AS customer_id, coalesce(sha256(CAST(c.c_custkey AS VARCHAR)), '-1') AS customer_key
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey AND c.c_custkey % 3 <> 0
""")
def q_lookup_orphans(spark, d):
    """Events to a customer dimension without every third customer; those become '-1'."""
    e = read_table(spark, d, "events").select("event_id", F.col("user_id").alias("customer_id"))
    return W.lookup(e, wh(spark, d).dim_customer.where("customer_id % 3 <> 0"), {"customer_id": "customer_id"}, "customer_key", spread=["event_id"])


@query("heavy_keys", "SELECT CAST(0 AS BIGINT) AS missed")
def q_heavy_keys(spark, d):
    """Customers with over 2 % of the events that the sketch doesn't list (none)."""
    from retail_marts.operators.skew import HotKeys, heavy_keys
    e = read_table(spark, d, "events").where("user_id IS NOT NULL")
    exact = e.groupBy(F.col("user_id").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    total = e.agg(F.count(F.lit(1)).alias("total"))
    hot = exact.join(total).where(F.col("n") > F.lit(0.02) * F.col("total")).select("item")
    listed = heavy_keys(e, ["user_id"], HotKeys(share=0.02, k=64)).select("item")
    return hot.join(listed, "item", "left_anti").agg(F.count(F.lit(1)).alias("missed"))


@query("fact_sales", f"""
WITH {SALES_CTE}
SELECT order_id, line_no, s.customer_id, product_id, seller_id,
       coalesce(sha256(CAST(c.c_custkey AS VARCHAR)), '-1') AS customer_key,
       coalesce(sha256(CAST(p.p_partkey AS VARCHAR)), '-1') AS product_key,
       coalesce(sha256(CAST(su.s_suppkey AS VARCHAR)), '-1') AS seller_key,
       CAST(year(ordered_at) * 10000 + month(ordered_at) * 100 + day(ordered_at) AS INTEGER) AS order_date_key,
       CAST(year(shipped_at) * 10000 + month(shipped_at) * 100 + day(shipped_at) AS INTEGER) AS ship_date_key,
       CAST(year(ordered_at) * 100 + month(ordered_at) AS INTEGER) AS month_key,
       ordered_at, shipped_at, order_status, return_flag, line_status, quantity, gross_amount,
       discount_rate, discount_amount, net_amount, tax_rate,
       CAST(ROUND(net_amount * tax_rate, 2) AS DECIMAL(18,2)) AS tax_amount
FROM sales_m s
LEFT JOIN customer c ON s.customer_id = c.c_custkey
LEFT JOIN part p ON s.product_id = p.p_partkey
LEFT JOIN supplier su ON s.seller_id = su.s_suppkey
""")
def q_fact_sales(spark, d):
    """W7 with dimension lookups."""
    return wh(spark, d).sales_keyed("customer", "product", "seller")


@query("fact_payments", """
SELECT event_id AS payment_id, user_id AS customer_id,
       coalesce(sha256(CAST(c.c_custkey AS VARCHAR)), '-1') AS customer_key,
       upper(nullif(trim(event_type), '')) AS payment_type,
       CAST(value AS DECIMAL(18,2)) AS amount, ts AS paid_at,
       CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS date_key,
       CAST(year(ts) * 100 + month(ts) AS INTEGER) AS month_key
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
WHERE event_type = 'purchase'
""")
def q_fact_payments(spark, d):
    """Purchase events as payments (stand-in)."""
    return wh(spark, d).payments(["purchase"])


RATINGS_SQL = r"""
SELECT l.doc_id AS rating_id, CAST(l.quality AS INTEGER) AS score,
       CAST(l.quality >= 1 AS INTEGER) AS satisfied,
       CAST(length(d.text) AS BIGINT) AS comment_chars,
       CAST(CASE WHEN d.text IS NULL THEN NULL WHEN trim(d.text) = '' THEN 0
                 ELSE len(string_split_regex(trim(d.text), '\s+')) END AS BIGINT) AS comment_words,
       d.lang, d.source, d.text AS comment
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""


@query("fact_ratings", RATINGS_SQL)
def q_fact_ratings(spark, d):
    """Labels + documents as ratings (stand-in)."""
    return wh(spark, d).ratings


@query("drill_across", f"""
WITH {SALES_CTE},
a AS (SELECT customer_id, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue,
             COUNT(DISTINCT order_id) AS orders, COUNT(*) AS lines FROM sales_m GROUP BY customer_id),
b AS (SELECT user_id AS customer_id, COUNT(*) AS payments,
             CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS paid_amount
      FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT coalesce(a.customer_id, b.customer_id) AS customer_id, net_revenue, orders, lines, payments, paid_amount
FROM a FULL OUTER JOIN b ON a.customer_id = b.customer_id
""")
def q_drill_across(spark, d):
    """Sales and payments side by side per customer."""
    w = wh(spark, d)
    return W.drill_across(
        [(w.sales, [F.sum("net_amount").cast("decimal(18,2)").alias("net_revenue"),
                    F.countDistinct("order_id").alias("orders"), F.count(F.lit(1)).alias("lines")]),
         (w.payments(["purchase"]), [F.count(F.lit(1)).alias("payments"),
                                     F.sum("amount").cast("decimal(18,2)").alias("paid_amount")])],
        ["customer_id"])


@query("drill_across_three", f"""
WITH {SALES_CTE},
a AS (SELECT CAST(year(ordered_at) * 100 + month(ordered_at) AS INTEGER) AS month_key,
             CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue, COUNT(*) AS lines FROM sales_m GROUP BY 1),
b AS (SELECT CAST(year(ts) * 100 + month(ts) AS INTEGER) AS month_key, COUNT(*) AS payments,
             CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS paid_amount
      FROM events WHERE event_type = 'purchase' GROUP BY 1),
c AS (SELECT CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS INTEGER) AS month_key, COUNT(*) AS ratings,
             CAST(SUM(CAST(l.quality >= 1 AS INTEGER)) AS BIGINT) AS satisfied
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id LEFT JOIN orders o ON o.o_orderkey = l.doc_id GROUP BY 1),
k AS (SELECT month_key FROM a UNION SELECT month_key FROM b UNION SELECT month_key FROM c)
SELECT k.month_key, net_revenue, lines, payments, paid_amount, ratings, satisfied FROM k
LEFT JOIN a ON k.month_key IS NOT DISTINCT FROM a.month_key LEFT JOIN b ON k.month_key IS NOT DISTINCT FROM b.month_key
LEFT JOIN c ON k.month_key IS NOT DISTINCT FROM c.month_key
""")
def q_drill_across_three(spark, d):
    """Sales, payments and ratings by month (ratings dated by an arbitrary pairing, see standins)."""
    from retail_marts.functions.columns import month_key
    w = wh(spark, d)
    ratings = standins.dated_ratings(w.ratings, w.orders).withColumn("month_key", month_key("rated_at"))
    return W.drill_across(
        [(w.sales, [F.sum("net_amount").cast("decimal(18,2)").alias("net_revenue"), F.count(F.lit(1)).alias("lines")]),
         (w.payments(["purchase"]), [F.count(F.lit(1)).alias("payments"), F.sum("amount").cast("decimal(18,2)").alias("paid_amount")]),
         (ratings, [F.count(F.lit(1)).alias("ratings"), F.sum("satisfied").alias("satisfied")])], ["month_key"])


# Dashboard marts ------------------------------------------------------------------

GEO_CUSTOMER_SQL = """
geo AS (SELECT c.c_custkey, n.n_name AS nation, r.r_name AS region, c.c_mktsegment AS segment
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _sales_with(w: Warehouse, dim: str, *cols: str) -> DataFrame:
    dd = getattr(w, f"dim_{dim}")
    return w.sales_keyed(dim).join(dd.select(f"{dim}_key", *cols), f"{dim}_key", "left")


@query("sales_kpis", f"""
WITH {SALES_CTE}
SELECT return_flag, line_status, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue,
       COUNT(DISTINCT order_id) AS orders, COUNT(*) AS lines, CAST(SUM(quantity) AS DECIMAL(18,2)) AS units,
       CAST(CAST(SUM(net_amount) AS DECIMAL(18,2)) AS DOUBLE) / CAST(COUNT(DISTINCT order_id) AS DOUBLE)
         AS avg_order_value
FROM sales_m GROUP BY return_flag, line_status
""")
def q_sales_kpis(spark, d):
    """B1 by return flag and line status."""
    return B.sales_kpis(wh(spark, d).sales, ["return_flag", "line_status"])


@query("sales_ytd", f"""
WITH {SALES_CTE},
m AS (SELECT CAST(date_trunc('month', ordered_at) AS DATE) AS month,
             CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue FROM sales_m GROUP BY 1)
SELECT month, net_revenue, CAST(year(month) AS INTEGER) AS year,
       CAST(SUM(net_revenue) OVER (PARTITION BY year(month) ORDER BY month
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS ytd_net_revenue
FROM m
""")
def q_sales_ytd(spark, d):
    """B3."""
    return B.sales_ytd(wh(spark, d).sales)


@query("sales_rollup", f"""
WITH {SALES_CTE}, {GEO_CUSTOMER_SQL}
SELECT region, nation, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue, COUNT(*) AS lines,
       CAST(GROUPING(region, nation) AS INTEGER) AS level
FROM sales_m s LEFT JOIN geo ON s.customer_id = geo.c_custkey
GROUP BY ROLLUP (region, nation)
""")
def q_sales_rollup(spark, d):
    """Customer region > nation."""
    return B.sales_rollup(_sales_with(wh(spark, d), "customer", "region", "nation"), ["region", "nation"])


@query("sales_cube", f"""
WITH {SALES_CTE}
SELECT order_status, return_flag, line_status, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue,
       COUNT(*) AS lines, CAST(GROUPING(order_status) AS INTEGER) AS g_order_status,
       CAST(GROUPING(return_flag) AS INTEGER) AS g_return_flag,
       CAST(GROUPING(line_status) AS INTEGER) AS g_line_status
FROM sales_m GROUP BY CUBE (order_status, return_flag, line_status)
""")
def q_sales_cube(spark, d):
    """B5."""
    return B.sales_cube(wh(spark, d).sales, ["order_status", "return_flag", "line_status"])


@query("sales_cube_orders", f"""
WITH {SALES_CTE}
SELECT order_status, return_flag, line_status, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue,
       COUNT(*) AS lines, COUNT(DISTINCT order_id) AS orders, CAST(GROUPING(order_status) AS INTEGER) AS g_order_status,
       CAST(GROUPING(return_flag) AS INTEGER) AS g_return_flag,
       CAST(GROUPING(line_status) AS INTEGER) AS g_line_status
FROM sales_m GROUP BY CUBE (order_status, return_flag, line_status)
""")
def q_sales_cube_orders(spark, d):
    """B5 with distinct orders at every level, from bitmaps of the finest cells."""
    return B.sales_cube_orders(wh(spark, d).sales, ["order_status", "return_flag", "line_status"])


@query("top_products", f"""
WITH {SALES_CTE},
p AS (SELECT product_id, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue,
             CAST(SUM(quantity) AS DECIMAL(18,2)) AS units FROM sales_m GROUP BY product_id),
r AS (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY net_revenue DESC, product_id) AS INTEGER) AS rank FROM p)
SELECT * FROM r WHERE rank <= 10
""")
def q_top_products(spark, d):
    """B6 overall, n = 10."""
    return B.top_products(wh(spark, d).sales, 10)


@query("top_products_by_brand", f"""
WITH {SALES_CTE},
p AS (SELECT s.product_id, pt.p_brand AS brand, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue,
             CAST(SUM(quantity) AS DECIMAL(18,2)) AS units
      FROM sales_m s LEFT JOIN part pt ON s.product_id = pt.p_partkey GROUP BY 1, 2),
r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY brand ORDER BY net_revenue DESC, product_id) AS INTEGER)
             AS rank FROM p)
SELECT * FROM r WHERE rank <= 3
""")
def q_top_products_by_brand(spark, d):
    """B6 within each brand, n = 3."""
    return B.top_products(_sales_with(wh(spark, d), "product", "brand"), 3, within="brand")


@query("new_vs_returning", """
WITH o AS (
  SELECT o_orderkey, o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CASE WHEN o_custkey IS NULL THEN 0 ELSE
           ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) END AS rn
  FROM orders)
SELECT month, COUNT(*) AS orders,
       CAST(SUM(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS new_orders,
       CAST(COUNT(o_custkey) - SUM(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS returning_orders,
       COUNT(DISTINCT o_custkey) AS customers,
       CAST(SUM(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS new_customers,
       CAST(COUNT(DISTINCT o_custkey) - SUM(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS returning_customers
FROM o GROUP BY month
""")
def q_new_vs_returning(spark, d):
    """B7 over all orders (with or without lines)."""
    return B.new_vs_returning(wh(spark, d).orders)


@query("repeat_rate", """
WITH per AS (SELECT o_custkey, COUNT(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1),
dist AS (SELECT n AS orders_per_customer, COUNT(*) AS customers FROM per GROUP BY 1)
SELECT orders_per_customer, customers,
       CAST(customers AS DOUBLE) / CAST(SUM(customers) OVER () AS DOUBLE) AS customer_share,
       CAST(SUM(CASE WHEN orders_per_customer >= 2 THEN customers ELSE 0 END) OVER () AS DOUBLE)
         / CAST(SUM(customers) OVER () AS DOUBLE) AS repeat_rate
FROM dist
""")
def q_repeat_rate(spark, d):
    """B8."""
    return B.repeat_rate(wh(spark, d).orders)


@query("customers_by", f"""
WITH {SALES_CTE}, {GEO_CUSTOMER_SQL},
per AS (SELECT customer_id, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS rev FROM sales_m GROUP BY 1)
SELECT region, segment, COUNT(*) AS customers, COUNT(per.rev) AS active_customers,
       CAST(coalesce(SUM(rev), 0) AS DECIMAL(18,2)) AS net_revenue,
       CAST(CAST(coalesce(SUM(rev), 0) AS DECIMAL(18,2)) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)
         AS revenue_per_customer
FROM geo LEFT JOIN per ON geo.c_custkey = per.customer_id
GROUP BY region, segment
""")
def q_customers_by(spark, d):
    """B9 by region and market segment."""
    w = wh(spark, d)
    return B.customers_by(w.dim_customer, w.sales, ["region", "segment"])


PAY_ALL_SQL = """
pay AS (SELECT upper(nullif(trim(event_type), '')) AS payment_type, CAST(value AS DECIMAL(18,2)) AS amount,
               ts AS paid_at FROM events)"""


@query("payments_by_type", f"""
WITH {PAY_ALL_SQL},
t AS (SELECT payment_type, COUNT(*) AS payments, CAST(SUM(amount) AS DECIMAL(18,2)) AS amount
      FROM pay GROUP BY 1)
SELECT payment_type, payments, amount,
       CAST(amount AS DOUBLE) / CAST(SUM(amount) OVER () AS DOUBLE) AS amount_share
FROM t
""")
def q_payments_by_type(spark, d):
    """B10 over every event type (the stand-in payment type)."""
    return B.payments_by_type(wh(spark, d).payments())


PIVOT_TYPES = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]


@query("payments_pivot", f"""
WITH {PAY_ALL_SQL}
SELECT CAST(paid_at AS DATE) AS day,
""" + ",\n".join(f"       CAST(SUM(CASE WHEN payment_type = '{t}' THEN amount END) AS DECIMAL(18,2)) "
                 f"AS amount_{t.lower()}" for t in PIVOT_TYPES) + """
FROM pay GROUP BY 1
""")
def q_payments_pivot(spark, d):
    """B11 per day, one column per type."""
    return B.payments_pivot(wh(spark, d).payments(), PIVOT_TYPES, period="day")


@query("payment_stats", f"""
WITH {PAY_ALL_SQL}
SELECT payment_type, COUNT(*) AS payments, CAST(SUM(amount) AS DECIMAL(18,2)) AS amount,
       CAST(CAST(SUM(amount) AS DECIMAL(18,2)) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS mean_amount,
       CAST(quantile_cont(CAST(amount AS DOUBLE), 0.5) AS DECIMAL(20,6)) AS median_amount,
       CAST(quantile_cont(CAST(amount AS DOUBLE), 0.9) AS DECIMAL(20,6)) AS p90_amount,
       CAST(quantile_cont(CAST(amount AS DOUBLE), 0.99) AS DECIMAL(20,6)) AS p99_amount
FROM pay GROUP BY 1
""")
def q_payment_stats(spark, d):
    """B12 per type, exact percentiles."""
    return B.payment_stats(wh(spark, d).payments(), ["payment_type"])


_RANKS = {"median_within": 0.5, "p90_within": 0.9, "p99_within": 0.99}


@query("payment_stats_sketched", f"""
WITH {PAY_ALL_SQL}
SELECT payment_type, COUNT(*) AS payments, CAST(SUM(amount) AS DECIMAL(18,2)) AS amount,
       1 AS median_within, 1 AS p90_within, 1 AS p99_within
FROM pay GROUP BY 1
""")
def q_payment_stats_sketched(spark, d):
    """B12 from stored monthly sketches merged per type; 1 where the quantile's exact rank is within 0.01 of the asked one."""
    pay = wh(spark, d).payments()
    stored = B.payment_sketches(pay, ["payment_type"])
    got = B.sketch_stats(stored, ["payment_type"], _RANKS)
    off = B.rank_errors(pay, got, ["payment_type"], _RANKS)
    return (got.select(F.col("payment_type").alias("_t"), "payments", "amount").join(off, F.col("_t").eqNullSafe(F.col("payment_type")))
            .select("payment_type", "payments", "amount", *[(F.col(n) <= 0.01).cast("int").alias(n) for n in _RANKS]))


@query("rating_distribution", f"""
WITH r AS ({RATINGS_SQL}),
d AS (SELECT lang, score, COUNT(*) AS ratings FROM r GROUP BY 1, 2)
SELECT lang, score, ratings,
       CAST(ratings AS DOUBLE) / CAST(SUM(ratings) OVER (PARTITION BY lang) AS DOUBLE) AS share
FROM d
""")
def q_rating_distribution(spark, d):
    """B13 per language."""
    return B.rating_distribution(wh(spark, d).ratings, ["lang"])


@query("satisfaction_by", f"""
WITH r AS ({RATINGS_SQL})
SELECT lang, source, COUNT(*) AS ratings,
       CAST(SUM(score) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS mean_score,
       CAST(SUM(satisfied) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS satisfied_rate
FROM r GROUP BY lang, source HAVING COUNT(*) >= 5
""")
def q_satisfaction_by(spark, d):
    """B14 per language and source, groups of at least 5 ratings."""
    return B.satisfaction_by(wh(spark, d).ratings, ["lang", "source"], min_n=5)


@query("slice_region_year", f"""
WITH {SALES_CTE}, {GEO_CUSTOMER_SQL}
SELECT region, CAST(year(ordered_at) AS INTEGER) AS order_year,
       CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue, COUNT(DISTINCT order_id) AS orders
FROM sales_m s LEFT JOIN geo ON s.customer_id = geo.c_custkey
WHERE order_status = 'F'
GROUP BY 1, 2 ORDER BY net_revenue DESC, region, order_year LIMIT 5
""")
def q_slice_region_year(spark, d):
    """B15, slice 1: top 5 (region, year) by revenue of finished orders."""
    return star_slice(sales_model(wh(spark, d)), ["net_revenue", "orders"], ["region", "order_year"],
                      where=[("order_status", "=", "F")], order=[("net_revenue", "desc")], n=5)


@query("slice_brand_units", f"""
WITH {SALES_CTE}
SELECT p.p_brand AS brand, CAST(SUM(quantity) AS DECIMAL(18,2)) AS units, COUNT(*) AS lines
FROM sales_m s LEFT JOIN part p ON s.product_id = p.p_partkey
WHERE p.p_size BETWEEN 10 AND 20 AND return_flag IN ('A', 'R')
GROUP BY 1 ORDER BY units DESC, brand LIMIT 10
""")
def q_slice_brand_units(spark, d):
    """B15, slice 2: top 10 brands by units, sizes 10-20, returned or accepted lines."""
    return star_slice(sales_model(wh(spark, d)), ["units", "lines"], ["brand"],
                      where=[("size", "between", (10, 20)), ("return_flag", "in", ["A", "R"])],
                      order=[("units", "desc")], n=10)


@query("slice_sales_quarter", f"""
WITH {SALES_CTE}, {GEO_CUSTOMER_SQL}
SELECT CAST(year(ordered_at) AS INTEGER) AS year, CAST(quarter(ordered_at) AS INTEGER) AS quarter, region,
       CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue, COUNT(*) AS lines
FROM sales_m s LEFT JOIN geo ON s.customer_id = geo.c_custkey
WHERE quarter(ordered_at) IN (1, 2) GROUP BY 1, 2, 3
""")
def q_slice_sales_quarter(spark, d):
    """B15, sales dashboard by the date dimension: first half-years by region."""
    return star_slice(sales_model(wh(spark, d)), ["net_revenue", "lines"], ["year", "quarter", "region"], where=[("quarter", "in", [1, 2])])


@query("slice_payments", f"""
WITH {GEO_CUSTOMER_SQL}
SELECT upper(nullif(trim(event_type), '')) AS payment_type, segment, COUNT(*) AS payments,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(value) AS DOUBLE) AS mean_amount
FROM events e LEFT JOIN geo ON e.user_id = geo.c_custkey WHERE isodow(ts) - 1 < 5 GROUP BY 1, 2
""")
def q_slice_payments(spark, d):
    """B15, payment dashboard: working days by type and customer segment."""
    return star_slice(payments_model(wh(spark, d)), ["payments", "amount", "mean_amount"], ["payment_type", "segment"], where=[("weekday", "<", 5)])


@query("slice_ratings", f"""
WITH r AS ({RATINGS_SQL})
SELECT lang, source, COUNT(*) AS ratings, CAST(SUM(score) AS DOUBLE) / CAST(COUNT(score) AS DOUBLE) AS mean_score,
       CAST(SUM(satisfied) AS BIGINT) AS satisfied
FROM r WHERE comment_words >= 50 GROUP BY lang, source
""")
def q_slice_ratings(spark, d):
    """B15, satisfaction dashboard: longer comments by language and source."""
    return star_slice(ratings_model(wh(spark, d)), ["ratings", "mean_score", "satisfied"], ["lang", "source"], where=[("comment_words", ">=", 50)])


CUSTOMER_STAR_SQL = f"""
{GEO_CUSTOMER_SQL},
per AS (SELECT o_custkey, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS v FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1),
cust AS (SELECT geo.*, coalesce(n, 0) AS n_orders, v, CASE WHEN coalesce(n, 0) = 0 THEN 'none' WHEN n = 1 THEN 'one' ELSE 'repeat' END AS loyalty
         FROM geo LEFT JOIN per ON geo.c_custkey = per.o_custkey)"""


@query("slice_customers", f"""
WITH {CUSTOMER_STAR_SQL}
SELECT region, loyalty, COUNT(*) AS customers, CAST(SUM(n_orders) AS BIGINT) AS orders, CAST(SUM(v) AS DECIMAL(18,2)) AS order_value,
       CAST(SUM(n_orders) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS mean_orders
FROM cust WHERE segment IN ('BUILDING', 'MACHINERY') GROUP BY region, loyalty
""")
def q_slice_customers(spark, d):
    """B15, customer dashboard: two segments by region and loyalty."""
    return star_slice(customers_model(wh(spark, d)), ["customers", "orders", "order_value", "mean_orders"], ["region", "loyalty"],
                      where=[("segment", "in", ["BUILDING", "MACHINERY"])])


@query("slice_stored", f"""
WITH {SALES_CTE}, {GEO_CUSTOMER_SQL}
SELECT region, CAST(year(ordered_at) AS INTEGER) AS year, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS net_revenue, COUNT(*) AS lines
FROM sales_m s LEFT JOIN geo ON s.customer_id = geo.c_custkey WHERE return_flag <> 'N' GROUP BY 1, 2
""")
def q_slice_stored(spark, d):
    """B15 from stored aggregates: built once, the request answered from the smallest that covers it."""
    from retail_marts.plans.lattice import Lattice
    stored = Lattice.build(sales_model(wh(spark, d)), scratch_path(spark, f"lattice-{uuid.uuid4().hex[:12]}"),
                           [["region", "nation", "year", "quarter", "return_flag"], ["region", "year", "return_flag"], ["year", "quarter"]])
    return stored.slice(["net_revenue", "lines"], ["region", "year"], where=[("return_flag", "!=", "N")])


# Customer segmentation ------------------------------------------------------------

from retail_marts.operators import segment as C  # noqa: E402

FEATURES_SQL = """
feat AS (
  SELECT o_custkey AS customer_id,
         CAST(date_diff('day', max(CAST(o_orderdate AS DATE)),
              (SELECT CAST(max(CAST(o_orderdate AS DATE)) + INTERVAL 1 DAY AS DATE) FROM orders)) AS INTEGER)
           AS recency,
         COUNT(*) AS frequency,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS monetary
  FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey)"""

Z_SQL = """
mom AS (SELECT avg(recency) AS m_r, stddev_samp(recency) AS s_r, avg(frequency) AS m_f,
               stddev_samp(frequency) AS s_f, avg(CAST(monetary AS DOUBLE)) AS m_m,
               stddev_samp(CAST(monetary AS DOUBLE)) AS s_m FROM feat),
zf AS (
  SELECT feat.*,
    CAST(ROUND(CASE WHEN s_r = 0 THEN 0 ELSE (recency - m_r) / s_r END, 6) AS DECIMAL(18,6)) AS z_recency,
    CAST(ROUND(CASE WHEN s_f = 0 THEN 0 ELSE (frequency - m_f) / s_f END, 6) AS DECIMAL(18,6)) AS z_frequency,
    CAST(ROUND(CASE WHEN s_m = 0 THEN 0 ELSE (CAST(monetary AS DOUBLE) - m_m) / s_m END, 6) AS DECIMAL(18,6))
      AS z_monetary
  FROM feat, mom)"""


def _features(spark, d):
    w = wh(spark, d)
    return C.customer_features(w.orders, C.default_as_of(w.orders))


@query("customer_features", f"WITH {FEATURES_SQL} SELECT * FROM feat")
def q_customer_features(spark, d):
    """Recency / frequency / monetary, as of the day after the last order."""
    return _features(spark, d)


@query("rfm_scores", f"""
WITH {FEATURES_SQL}
SELECT customer_id,
       CAST(ntile(5) OVER (ORDER BY recency DESC, customer_id) AS INTEGER) AS recency_score,
       CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS frequency_score,
       CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS monetary_score
FROM feat
""")
def q_rfm_scores(spark, d):
    """Quintile scores; recency high-to-low so the most recent score 5."""
    f = _features(spark, d)
    f = C.score(f, "recency", "customer_id", 5, descending=True)
    f = C.score(f, "frequency", "customer_id", 5)
    f = C.score(f, "monetary", "customer_id", 5)
    return f.select("customer_id", "recency_score", "frequency_score", "monetary_score")


@query("scale_features", f"""
WITH {FEATURES_SQL}, {Z_SQL}
SELECT customer_id, z_recency, z_frequency, z_monetary FROM zf
""")
def q_scale_features(spark, d):
    """Z-scores of the three features (decimal(18,6))."""
    scaled, _ = C.scale(_features(spark, d), C.FEATURES, "z")
    return C.z_columns(scaled.select("customer_id", "z"), C.FEATURES)


ZC = ["z_recency", "z_frequency", "z_monetary"]


def _assigned(spark, d):
    """Customers assigned to centres derived from the data: the mean z-vector
    of each monetary quintile (rounded to 6 decimals)."""
    f = _features(spark, d)
    scaled, _ = C.scale(f, C.FEATURES, "z")
    z = C.z_columns(scaled, C.FEATURES)
    z = C.score(z, "monetary", "customer_id", 5)
    cen = (z.groupBy("monetary_score")
            .agg(*[F.round(F.sum(c).cast("double") / F.count(F.lit(1)).cast("double"), 6).alias(c)
                   for c in ZC])
            .orderBy("monetary_score").collect())        # 5 rows
    from decimal import Decimal
    centres = [[Decimal(f"{r[c]:.6f}") for c in ZC] for r in cen]
    zz = z.select("customer_id", *C.FEATURES, *[F.col(c).cast("decimal(12,6)").alias(c) for c in ZC])
    return C.assign(zz, centres, ZC)


ASSIGN_SQL = f"""
WITH {FEATURES_SQL}, {Z_SQL},
sc AS (SELECT *, ntile(5) OVER (ORDER BY monetary, customer_id) AS ms FROM zf),
cen AS (SELECT ms - 1 AS j,
               CAST(ROUND(CAST(SUM(z_recency) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 6) AS DECIMAL(12,6)) AS cr,
               CAST(ROUND(CAST(SUM(z_frequency) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 6) AS DECIMAL(12,6)) AS cf,
               CAST(ROUND(CAST(SUM(z_monetary) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 6) AS DECIMAL(12,6)) AS cm
        FROM sc GROUP BY ms),
dist AS (
  SELECT sc.customer_id, sc.recency, sc.frequency, sc.monetary, cen.j,
         (CAST(z_recency AS DECIMAL(12,6)) - cr) * (CAST(z_recency AS DECIMAL(12,6)) - cr)
         + (CAST(z_frequency AS DECIMAL(12,6)) - cf) * (CAST(z_frequency AS DECIMAL(12,6)) - cf)
         + (CAST(z_monetary AS DECIMAL(12,6)) - cm) * (CAST(z_monetary AS DECIMAL(12,6)) - cm) AS d2
  FROM sc CROSS JOIN cen),
best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY d2, j) AS rn FROM dist),
asg AS (SELECT customer_id, recency, frequency, monetary, CAST(j AS INTEGER) AS segment FROM best WHERE rn = 1)"""


@query("assign_segments", ASSIGN_SQL + "\nSELECT customer_id, segment FROM asg")
def q_assign_segments(spark, d):
    """C6 assignment to data-derived centres (exact decimal distances)."""
    return _assigned(spark, d).select("customer_id", "segment")


@query("segment_profile", ASSIGN_SQL + """
SELECT segment, COUNT(*) AS customers,
       CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS share,
       CAST(SUM(recency) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS mean_recency,
       CAST(SUM(frequency) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS mean_frequency,
       CAST(SUM(monetary) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS mean_monetary
FROM asg GROUP BY segment
""")
def q_segment_profile(spark, d):
    """C6 profile of the assignment above."""
    return C.profile(_assigned(spark, d))


def _kmeans_sql(ks: list[int], seed: int, steps: int) -> str:
    """C4 / C5 as plain SQL: scaling, hash-seeded k-means++ and ``steps`` Lloyd steps written out one by
    one; ``cen`` (k, j, a, b, c) holds the last centres, ``near`` (k, customer_id, j, d) the nearest one."""
    cols = [("a", "recency"), ("b", "frequency"), ("c", "monetary")]
    x = {n: f"CAST({f} AS DECIMAL(18,4))" for n, f in cols}
    moments = ", ".join(f"CAST(SUM({e}) AS DOUBLE) AS s_{n}, CAST(SUM(CAST({e} AS DECIMAL(38,4)) * CAST({e} AS DECIMAL(38,4))) AS DOUBLE) AS q_{n}" for n, e in x.items())
    spread = ", ".join(f"s_{n} / n AS m_{n}, sqrt(greatest((q_{n} - s_{n} * s_{n} / n) / (n - 1), 0)) AS d_{n}" for n in x)
    z = ", ".join(f"CAST(CASE WHEN d_{n} = 0 THEN 0 ELSE floor((CAST({e} AS DOUBLE) - m_{n}) / d_{n} * CAST(1000000 AS DOUBLE)) END AS BIGINT) AS {n}"
                  for n, e in x.items())
    dist = " + ".join(f"CAST(z.{n} - s.{n} AS DOUBLE) * CAST(z.{n} - s.{n} AS DOUBLE)" for n in x)
    parts = [FEATURES_SQL.strip(),
             f"mo AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, {moments} FROM feat)",
             f"sp AS (SELECT {spread} FROM mo)",
             f"z AS MATERIALIZED (SELECT customer_id, monetary, {z} FROM feat, sp)"]
    for j in range(max(ks)):
        u = (f"(CAST(CAST('0x' || substr(md5('{seed}|{j}|' || CAST(customer_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)"
             f" / CAST(4503599627370496 AS DOUBLE)")
        w = f"(SELECT MIN({dist}) FROM seeds{j - 1} s)" if j else "1.0"
        before = f"SELECT * FROM seeds{j - 1} UNION ALL " if j else ""
        parts.append(f"seeds{j} AS MATERIALIZED ({before}(SELECT {j} AS j, a, b, c FROM z "
                     f"ORDER BY {w} / -ln({u}) DESC, customer_id DESC LIMIT 1))")
    values = ", ".join(f"({k})" for k in ks)
    parts.append(f"cen0 AS MATERIALIZED (SELECT k, j, a, b, c FROM seeds{max(ks) - 1}, (VALUES {values}) AS v(k) WHERE j < k)")

    def near(t):
        return (f"(SELECT k, customer_id, m.j AS j, m.d AS d FROM (SELECT s.k, z.customer_id, "
                f"min(struct_pack(d := {dist}, j := s.j)) AS m FROM z, cen{t} s GROUP BY ALL))")
    for t in range(steps):
        mean = ", ".join(f"CAST(coalesce((g.{n} - ((g.{n} % g.n) + g.n) % g.n) // g.n, s.{n}) AS BIGINT) AS {n}" for n in x)
        sums = ", ".join(f"SUM(z.{n}) AS {n}" for n in x)
        parts.append(f"cen{t + 1} AS MATERIALIZED (SELECT s.k, s.j, {mean} FROM cen{t} s LEFT JOIN "
                     f"(SELECT e.k, e.j, COUNT(*) AS n, {sums} FROM {near(t)} e JOIN z USING (customer_id) GROUP BY e.k, e.j) g "
                     f"ON g.k = s.k AND g.j = s.j)")
    parts += [f"cen AS (SELECT * FROM cen{steps})", f"near AS MATERIALIZED {near(steps)}"]
    return "WITH " + ",\n".join(parts)


@query("fit_segments", _kmeans_sql([4], 1, 40) + """,
val AS (SELECT j, CAST(SUM(CAST(monetary AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*) AS m FROM near JOIN z USING (customer_id) GROUP BY j),
num AS (SELECT cen.j, CAST(ROW_NUMBER() OVER (ORDER BY m DESC NULLS LAST, cen.j) - 1 AS INTEGER) AS segment
        FROM cen LEFT JOIN val ON val.j = cen.j)
SELECT customer_id, segment FROM near JOIN num USING (j)
""")
def q_fit_segments(spark, d):
    """C4: k-means with k = 4 on scaled RFM; segment 0 = highest mean monetary."""
    f = _features(spark, d)
    seg = C.fit_segments(f, 4, seed=1)
    return seg.transform(f).select("customer_id", "segment")


@query("choose_k", _kmeans_sql([2, 3, 4, 5, 6], 1, 40) + """,
p AS (SELECT near.k, near.j, near.d, z.customer_id, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b, CAST(c AS DOUBLE) AS c,
             CAST(a AS DOUBLE) * CAST(a AS DOUBLE) + CAST(b AS DOUBLE) * CAST(b AS DOUBLE) + CAST(c AS DOUBLE) * CAST(c AS DOUBLE) AS norm
      FROM near JOIN z USING (customer_id)),
g AS MATERIALIZED (
  SELECT k, j, CAST(COUNT(*) AS DOUBLE) AS n, CAST(CAST(SUM(CAST(a AS BIGINT)) AS BIGINT) AS DOUBLE) AS sa,
         CAST(CAST(SUM(CAST(b AS BIGINT)) AS BIGINT) AS DOUBLE) AS sb, CAST(CAST(SUM(CAST(c AS BIGINT)) AS BIGINT) AS DOUBLE) AS sc,
         CAST(CAST(SUM(CAST(norm AS BIGINT)) AS BIGINT) AS DOUBLE) AS q, SUM(CAST(d AS BIGINT)) AS cost
  FROM p GROUP BY k, j),
m AS (SELECT p.k, p.customer_id, p.j = g.j AS own, g.n,
             p.norm - CAST(2 AS DOUBLE) * (p.a * sa + p.b * sb + p.c * sc) / n + q / n AS e
      FROM p JOIN g ON g.k = p.k),
ab AS (SELECT k, customer_id, MAX(CASE WHEN own AND n > 1 THEN e * n / (n - 1) END) AS a, MIN(CASE WHEN NOT own THEN e END) AS b
       FROM m GROUP BY k, customer_id),
s AS (SELECT k, COUNT(*) AS n, SUM(CAST(floor(CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) <= 0 THEN 0
        ELSE (b - a) / greatest(a, b) END * CAST(1000000 AS DOUBLE)) AS BIGINT)) AS t FROM ab GROUP BY k),
t AS (SELECT k, SUM(cost) AS cost FROM g GROUP BY k)
SELECT CAST(k AS INTEGER) AS k, CAST(CAST(cost // 100000000 AS BIGINT) AS DOUBLE) / CAST(10000 AS DOUBLE) AS cost,
       CAST(CAST(t.t AS BIGINT) AS DOUBLE) / CAST(n AS DOUBLE) / CAST(1000000 AS DOUBLE) AS silhouette
FROM (SELECT s.k, s.n, s.t, t.cost FROM s JOIN t ON s.k = t.k) t
""")
def q_choose_k(spark, d):
    """Cost and silhouette for k = 2..6, all in the same passes."""
    return C.choose_k(_features(spark, d), [2, 3, 4, 5, 6], seed=1)


# Satisfaction prediction ----------------------------------------------------------

from retail_marts.operators import satisfaction as P  # noqa: E402

TEST_SHARE = 0.3
NUMERIC = ["comment_chars", "comment_words"]
CATEGORICAL = ["lang", "source"]


def _reviews(spark, d) -> DataFrame:
    """Every document as a review (features only: text, length, lang, source)."""
    docs = read_table(spark, d, "documents")
    cand = docs.select(F.col("doc_id").alias("rating_id"), F.lit(None).cast("int").alias("score"),
                       F.col("text").alias("comment"), "lang", "source")
    return W.fact_ratings(cand).drop("score", "satisfied")


def _training(spark, d):
    return P.training_rows(_reviews(spark, d), read_table(spark, d, "labels")
                           .withColumnRenamed("doc_id", "rating_id"), "rating_id", "quality")


LABELLED_SQL = r"""
lab AS (
  SELECT d.doc_id AS rating_id, CAST(max(l.quality) >= 1 AS INTEGER) AS label, d.lang, d.source,
         CAST(length(d.text) AS BIGINT) AS comment_chars,
         CAST(CASE WHEN trim(d.text) = '' THEN 0 ELSE len(string_split_regex(trim(d.text), '\s+')) END AS BIGINT)
           AS comment_words, d.text
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  GROUP BY d.doc_id, d.lang, d.source, d.text)"""


@query("training_rows", f"""
WITH {LABELLED_SQL}
SELECT rating_id, label, lang, source, comment_chars, comment_words FROM lab
""")
def q_training_rows(spark, d):
    """Labelled reviews (label = quality)."""
    lab, _ = _training(spark, d)
    return lab.select("rating_id", "label", "lang", "source", "comment_chars", "comment_words")


@query("unlabelled_rows", r"""
SELECT d.doc_id AS rating_id, d.lang, d.source, CAST(length(d.text) AS BIGINT) AS comment_chars
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def q_unlabelled_rows(spark, d):
    """Reviews without a label, kept apart for scoring."""
    _, unl = _training(spark, d)
    return unl.select("rating_id", "lang", "source", "comment_chars")


@query("split", f"""
WITH {LABELLED_SQL}
SELECT rating_id, label,
       CASE WHEN substr(sha256(text), 1, 8) < '{P.test_threshold(TEST_SHARE)}' THEN 'test' ELSE 'train' END AS part
FROM lab
""")
def q_split(spark, d):
    """30 % test by hash of the review text (copies stay on one side)."""
    lab, _ = _training(spark, d)
    return P.split_flag(lab, "comment", TEST_SHARE).select("rating_id", "label", "part")


@query("evaluate_length", f"""
WITH {LABELLED_SQL},
pred AS (SELECT label, comment_chars AS s, CASE WHEN comment_chars >= 2000 THEN 1 ELSE 0 END AS p FROM lab),
cm AS (SELECT CAST(SUM(CASE WHEN label = 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
              CAST(SUM(CASE WHEN label = 0 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
              CAST(SUM(CASE WHEN label = 0 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
              CAST(SUM(CASE WHEN label = 1 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
              COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS pos FROM pred),
sc AS (SELECT s, COUNT(*) AS c, SUM(label) AS p FROM pred GROUP BY s),
rk AS (SELECT *, coalesce(SUM(c) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS before FROM sc),
a AS (SELECT CAST(SUM(CAST(p AS HUGEINT) * (2 * before + c + 1)) - (SELECT CAST(pos AS HUGEINT) * (pos + 1) FROM cm)
             AS DOUBLE) / CAST((SELECT 2 * CAST(pos AS HUGEINT) * (n - pos) FROM cm) AS DOUBLE) AS auc FROM rk),
k AS (
  SELECT 1 AS class, tp + fn AS support, tp + fp AS predicted, tp AS correct, tp, tn, n FROM cm
  UNION ALL SELECT 0, tn + fp, tn + fn, tn, tp, tn, n FROM cm)
SELECT class, support, predicted, correct,
       CASE WHEN predicted = 0 THEN NULL ELSE CAST(correct AS DOUBLE) / CAST(predicted AS DOUBLE) END AS precision,
       CASE WHEN support = 0 THEN NULL ELSE CAST(correct AS DOUBLE) / CAST(support AS DOUBLE) END AS recall,
       CASE WHEN support + predicted = 0 THEN NULL
            ELSE CAST(2 * correct AS DOUBLE) / CAST(support + predicted AS DOUBLE) END AS f1,
       CAST(tp + tn AS DOUBLE) / CAST(n AS DOUBLE) AS accuracy,
       (SELECT auc FROM a) AS auc,
       CAST((SELECT pos FROM cm) AS DOUBLE) / CAST(n AS DOUBLE) AS base_rate
FROM k
""")
def q_evaluate_length(spark, d):
    """P5 with the review length as the score (prediction: 2,000 characters or more)."""
    lab, _ = _training(spark, d)
    return P.evaluate(lab, "label", "comment_chars", 2000)


def _train_test(spark, d):
    lab, _ = _training(spark, d)
    return P.split(lab, "comment", TEST_SHARE)


@query("feature_pipeline")
def q_feature_pipeline(spark, d):
    """Features fitted on the training part, applied to both parts. Rows only."""
    from pyspark.ml.functions import vector_to_array
    train, test = _train_test(spark, d)
    fp = P.feature_pipeline(NUMERIC, CATEGORICAL, "comment", num_text_features=1 << 14).fit(train)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    arr = vector_to_array(F.col("features"))
    return fp.transform(both).select("rating_id", "part", F.size(arr).alias("n_features"),
                                     F.size(F.filter(arr, lambda x: x != 0)).alias("nonzeros"))


MODEL_TEXT_FEATURES = {"baseline": 1 << 10, "logreg": 1 << 14, "rf": 1 << 12, "gbt": 1 << 12}


@query("train_models")
def q_train_models(spark, d):
    """P4 + P5: baseline, logistic regression, random forest and boosted
    trees (class-weighted) fitted on the training part, evaluated on the
    test part at cut 0.5. Rows only."""
    from functools import reduce
    lab, _ = _training(spark, d)
    # one pass: split by text hash, tokenise, checkpoint; both parts read it
    both = (P.tokenizer("comment", "tokens").transform(P.split_flag(P.spread_texts(lab, "comment"), "comment", TEST_SHARE))
             .drop("comment").checkpoint(eager=True))
    train = both.filter(F.col("part") == "train").drop("part")
    test = both.filter(F.col("part") == "test").drop("part")
    out = []
    for kind, nf in MODEL_TEXT_FEATURES.items():
        feats = P.feature_pipeline(NUMERIC, CATEGORICAL, None, num_text_features=nf, tokens="tokens")
        m = P.train(train, kind, feats, weighted=(kind != "baseline"))
        out.append(P.evaluate(P.scored(m, test, ["rating_id", "label"]), "label", "score", 0.5)
                   .withColumn("model", F.lit(kind)))
    return reduce(DataFrame.unionByName, out)


@query("score_batch")
def q_score_batch(spark, d):
    """A random forest fitted on every labelled review scores every
    unlabelled one. Rows only."""
    lab, unl = _training(spark, d)
    lab = P.spread_texts(lab, "comment").checkpoint(eager=True)
    m = P.train(lab, "rf", P.feature_pipeline(NUMERIC, CATEGORICAL, "comment", num_text_features=1 << 12),
                weighted=True)
    return P.score_batch(m, unl, "rating_id", version="rf-v1")


@query("score_versions", """
WITH u AS (SELECT COUNT(*) AS n, COUNT(DISTINCT d.doc_id) AS k FROM documents d
           WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))
SELECT 'rf-v1' AS model_version, n AS scored, k AS reviews, n AS within FROM u
UNION ALL SELECT 'rf-v2', n, k, n FROM u
""")
def q_score_versions(spark, d):
    """Every unlabelled review scored and stored under two model versions, one of them twice; read back per version."""
    lab, unl = _training(spark, d)
    lab = P.spread_texts(lab, "comment").checkpoint(eager=True)
    path = scratch_path(spark, "scores-" + uuid.uuid4().hex[:8])
    features = P.feature_pipeline(NUMERIC, CATEGORICAL, "comment", num_text_features=1 << 12)
    model = P.train(lab, "rf", features, weighted=True)
    for version, cut in (("rf-v1", 0.5), ("rf-v2", 0.6), ("rf-v1", 0.4)):
        P.score_batch(model, unl, "rating_id", path, version, cut)
    return (P.read_scores(spark, path, unl.schema["rating_id"].dataType, "rating_id").groupBy("model_version")
            .agg(F.count(F.lit(1)).alias("scored"), F.countDistinct("rating_id").alias("reviews"),
                 F.sum(F.col("score").between(0, 1).cast("bigint")).alias("within")))
