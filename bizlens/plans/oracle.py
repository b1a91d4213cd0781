"""DuckDB SQL for every registered report: the correctness oracle.

Each statement is worked out from the definition of its report (SURVEY §2) and
takes nothing from the code under test: constants are written out again here.
The statements work on raw lines and plain SQL (window functions, QUALIFY,
arg_max, correlated subqueries, generated calendars), not on the reduced frames
of the Spark plans.

``FRAMES`` holds the shared subqueries: ``o`` orders, ``l`` lines, ``x`` lines with
their order's header, ``ok`` those of orders that count as revenue, ``p`` parts,
``c`` customers with geography, ``r`` reviews, ``g`` ledger, ``m`` monthly revenue.
"""

from __future__ import annotations

FRAMES = {
    "o": """SELECT o_orderkey AS oid, o_custkey AS cid, o_orderpriority AS prio, o_orderdate AS ts, CAST(o_orderdate AS DATE) AS day,
                   CAST(date_trunc('month', o_orderdate) AS DATE) AS mon, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
                   CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'processing'
                        WHEN 'P' THEN (CASE WHEN o_orderkey % 10 = 0 THEN 'cancelled' ELSE 'pending' END) END AS state
            FROM orders""",
    "l": """SELECT l_orderkey AS oid, l_partkey AS pid, l_linenumber AS lno, CAST(l_quantity AS INTEGER) AS qty, l_shipdate AS shipped,
                   CAST(l_extendedprice AS DECIMAL(12,2)) AS gross, CAST(l_discount AS DECIMAL(4,2)) AS disc,
                   CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) AS net
            FROM lineitem""",
    "x": "SELECT * FROM l JOIN o USING (oid)",
    "ok": "SELECT * FROM x WHERE state IN ('delivered', 'processing', 'pending')",
    "p": """SELECT p_partkey AS pid, p_name AS pname, p_type AS cat, CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_size AS size,
                   concat('SKU-', p_partkey) AS sku, p_partkey % 20 <> 0 AS active, p_size - 1 AS stock, 10 + p_partkey % 20 AS level
            FROM part""",
    "c": """SELECT c_custkey AS cid, c_name AS first, c_mktsegment AS last, concat(c_name, ' ', c_mktsegment) AS whole, c_nationkey AS nat,
                   concat('cust', c_custkey, '@example.com') AS mail, n_name AS nation, r_name AS region
            FROM customer LEFT JOIN (nation JOIN region ON r_regionkey = n_regionkey) ON n_nationkey = c_nationkey""",
    "r": """SELECT event_id AS rid, (7 * event_id) % (SELECT count(*) FROM part) AS pid, user_id AS cid, CAST(event_id % 5 + 1 AS INTEGER) AS stars
            FROM events""",
    "m": "SELECT mon, sum(net) AS rev, count(DISTINCT oid) AS n FROM ok GROUP BY mon",
    "g": """SELECT CAST(o_orderdate AS DATE) AS day, true AS inc, o_orderpriority AS cat, CAST(o_totalprice AS DECIMAL(12,2)) AS amt FROM orders
            UNION ALL
            SELECT CAST(l_shipdate AS DATE), false, p_type,
                   CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(12,2))
            FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "b": """SELECT * FROM (VALUES ('ECONOMY', 180000), ('LARGE', 190000), ('MEDIUM', 200000), ('PROMO', 170000), ('SMALL', 185000),
                                  ('STANDARD', 195000)) t(cat, budget)""",
    "ship": """SELECT o.*, min(l.shipped) AS s0, max(l.shipped) AS s1 FROM o LEFT JOIN l ON l.oid = o.oid AND l.shipped >= o.ts
               GROUP BY ALL""",
}
NEEDS = {"x": ["l", "o"], "ok": ["x"], "m": ["ok"], "ship": ["o", "l"], "ser": ["x"]}


def sql(frames: str, body: str) -> str:
    """``body`` after the named frames and all that they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in frames.split():
        add(name)
    head = ",\n".join(f"{n} AS ({FRAMES[n]})" for n in order)
    return f"WITH {head}{',' if body.lstrip()[:5] == 'more:' else ''}\n{body.lstrip().removeprefix('more:')}"


def half_up(num: str, den: str, digits: int) -> str:
    """num / den for whole numbers, rounded half away from zero without floating point; NULL for den = 0."""
    n, d, f = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)", 10 ** digits
    return f"CAST(sign({n}) * sign({d}) * ((2 * {f} * abs({n}) + abs({d})) // (2 * abs(nullif({d}, 0)))) / {f}.0 AS DOUBLE)"


def per(num: str, den: str, digits: int) -> str:
    """The same for amounts with at most two decimals."""
    return half_up(f"(({num}) * 100)", f"(({den}) * 100)", digits)


def dbl(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


TODAY = "DATE '2001-09-01'"
ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------- revenue
ORACLE["daily_revenue"] = sql("ok", f"SELECT day AS order_day, {big('count(DISTINCT oid)', 'total_orders')}, {dbl('sum(net)', 'daily_revenue')} FROM ok GROUP BY day")
ORACLE["monthly_revenue"] = sql("m", f"""
SELECT a.mon AS month, {dbl('a.rev', 'monthly_revenue')}, {dbl('(SELECT sum(z.rev) FROM m z WHERE z.mon <= a.mon)', 'cumulative_revenue')} FROM m a""")
ORACLE["category_revenue"] = sql("ok p", f"""
SELECT cat AS category, {dbl('sum(net)', 'revenue')}, {big('count(DISTINCT oid)', 'order_count')},
       {per('sum(net) * 100', '(SELECT sum(net) FROM ok JOIN p USING (pid))', 2)} AS pct_of_total
FROM ok JOIN p USING (pid) GROUP BY cat""")
ORACLE["moving_average_3m"] = sql("m", f"""more: n AS (SELECT *, row_number() OVER (ORDER BY mon) AS i FROM m)
SELECT a.mon AS month, {dbl('any_value(a.rev)', 'revenue')}, {per('sum(z.rev)', 'count(z.rev)', 2)} AS moving_avg_3m
FROM n a JOIN n z ON z.i BETWEEN a.i - 2 AND a.i GROUP BY a.mon""")


def _growth(join: str) -> str:
    return f"""SELECT a.mon AS month, {dbl('a.rev', 'current_revenue')}, {dbl('z.rev', 'prior_year_revenue')},
       CASE WHEN z.rev IS NOT NULL THEN {per('(a.rev - z.rev) * 100', 'z.rev', 2)} END AS yoy_growth_pct
FROM n a LEFT JOIN n z ON {join}"""


ORACLE["yoy_growth"] = sql("m", "more: n AS (SELECT *, row_number() OVER (ORDER BY mon) AS i FROM m)\n" + _growth("z.i = a.i - 12"))
ORACLE["yoy_growth_calendar"] = sql("m", "more: n AS (SELECT * FROM m)\n" + _growth("z.mon + INTERVAL 12 MONTH = a.mon"))
ORACLE["average_order_value"] = sql("m", f"SELECT mon AS month, {big('n', 'order_count')}, {per('rev', 'n', 2)} AS avg_order_value FROM m")

# ---------------------------------------------------------------- customers
ORACLE["top_customers"] = sql("ok c", f"""
SELECT cid AS customer_id, any_value(whole) AS full_name, any_value(nation) AS city, {big('count(DISTINCT oid)', 'total_orders')},
       {dbl('sum(net)', 'lifetime_spend')}, {per('sum(net)', 'count(*)', 2)} AS avg_item_value
FROM ok JOIN c USING (cid) GROUP BY cid ORDER BY sum(net) DESC, cid LIMIT 10""")
ORACLE["cohort_retention"] = sql("ok o", f"""more: born AS (SELECT cid, min(mon) AS joined FROM o WHERE state NOT IN ('cancelled', 'refunded') GROUP BY cid)
SELECT joined AS cohort_month, mon AS activity_month, {big("datediff('month', joined, mon)", 'months_since_acq')},
       {big('count(DISTINCT cid)', 'active_customers')}, {dbl('sum(net)', 'revenue')}
FROM ok JOIN born USING (cid) GROUP BY joined, mon""")
ORACLE["rfm_segments"] = sql("ok c", f"""more: per AS (
  SELECT cid, any_value(whole) AS who, {TODAY} - max(day) AS gap, count(DISTINCT oid) AS times, sum(net) AS spent FROM ok JOIN c USING (cid) GROUP BY cid
), fifths AS (
  SELECT *, 6 - ntile(5) OVER (ORDER BY gap, cid) AS a, ntile(5) OVER (ORDER BY times, cid) AS b, ntile(5) OVER (ORDER BY spent, cid) AS d FROM per
)
SELECT cid AS customer_id, who AS full_name, {big('gap', 'recency_days')}, {big('times', 'frequency')}, {dbl('spent', 'monetary')},
       {big('a', 'r_score')}, {big('b', 'f_score')}, {big('d', 'm_score')}, {big('a + b + d', 'rfm_total')},
       CASE WHEN least(a, b, d) > 3 THEN 'Champions' WHEN a > 3 AND b > 1 THEN 'Loyal Customers' WHEN a > 2 AND b < 3 AND d > 2 THEN 'Big Spenders'
            WHEN a < 3 THEN (CASE WHEN b > 2 THEN 'At Risk' ELSE 'Lost' END) ELSE 'Potential' END AS segment
FROM fifths""")
ORACLE["inactive_customers"] = sql("o c", f"""
SELECT cid AS customer_id, any_value(whole) AS full_name, any_value(mail) AS email, max(day) AS last_order_date,
       {big(f'{TODAY} - max(day)', 'days_since_last_order')}
FROM o JOIN c USING (cid) WHERE state NOT IN ('cancelled', 'refunded') GROUP BY cid HAVING max(day) < {TODAY} - 90""")
ORACLE["customers_without_orders"] = sql("o c", f"""
SELECT cid AS customer_id, whole AS full_name, mail AS email FROM c
WHERE cid NOT IN (SELECT cid FROM o WHERE state NOT IN ('cancelled', 'refunded') AND ts >= {TODAY} - INTERVAL 90 DAY AND cid IS NOT NULL)""")
ORACLE["value_segments"] = sql("x c", f"""more: per AS (SELECT cid, count(*) AS n, sum(net) AS spent, min(day) AS d0, max(day) AS d1 FROM x GROUP BY cid),
bar AS (SELECT list(spent ORDER BY spent DESC)[greatest(count(*) // 10, 1)] AS least_vip FROM per)
SELECT per.cid AS customer_id, c.first AS customer_name, {big('n', 'total_orders')}, {dbl('spent', 'total_spent')}, {per('spent', 'n', 2)} AS avg_order_value,
       d0 AS first_purchase, d1 AS last_purchase,
       CASE WHEN spent >= least_vip THEN 'VIP' WHEN d0 >= {TODAY} - 60 THEN 'New' WHEN d1 < {TODAY} - 90 THEN 'At Risk' ELSE 'Regular' END AS segment
FROM per CROSS JOIN bar LEFT JOIN c ON c.cid = per.cid""")

# ---------------------------------------------------------------- products
ORACLE["product_performance"] = sql("ok p r", f"""
SELECT pid AS product_id, pname AS name, {dbl('price', 'price')},
       {big('coalesce((SELECT sum(qty) FROM ok WHERE ok.pid = p.pid), 0)', 'units_sold')},
       {dbl('coalesce((SELECT sum(net) FROM ok WHERE ok.pid = p.pid), 0)', 'total_revenue')},
       coalesce((SELECT {half_up('sum(stars)', 'count(*)', 2)} FROM r WHERE r.pid = p.pid), 0) AS avg_rating,
       {big('(SELECT count(*) FROM r WHERE r.pid = p.pid)', 'review_count')}
FROM p WHERE active""")
ORACLE["inventory_alerts"] = sql("p", f"""
SELECT sku, pname AS name, {big('stock', 'current_stock')}, {big('level', 'reorder_level')}, {big('50', 'suggested_reorder')},
       CASE WHEN stock = 0 THEN 'OUT OF STOCK' WHEN stock > level THEN 'LOW STOCK' ELSE 'REORDER NOW' END AS stock_status
FROM p WHERE 2 * stock <= 3 * level""")
ORACLE["top_products_per_category"] = sql("ok p", f"""
SELECT cat AS category, any_value(pname) AS product_name, {big('sum(qty)', 'units_sold')}, {dbl('sum(net)', 'revenue')},
       {big('row_number() OVER (PARTITION BY cat ORDER BY sum(net) DESC, pid)', 'rank_in_category')}
FROM ok JOIN p USING (pid) GROUP BY cat, pid QUALIFY rank_in_category <= 3""")
ORACLE["review_sentiment"] = sql("ok p r", f"""
SELECT any_value(pname) AS product, {big('count(*)', 'total_reviews')}, {half_up('sum(stars)', 'count(*)', 2)} AS avg_rating,
       {big('count(*) FILTER (stars >= 4)', 'positive_reviews')}, {big('count(*) FILTER (stars <= 2)', 'negative_reviews')},
       {big('coalesce((SELECT sum(qty) FROM ok WHERE ok.pid = r.pid), 0)', 'units_sold')},
       {dbl('coalesce((SELECT sum(net) FROM ok WHERE ok.pid = r.pid), 0)', 'revenue')}
FROM r JOIN p USING (pid) GROUP BY r.pid""")
ORACLE["co_purchased_pairs"] = sql("l p", f"""more: named AS (SELECT oid, pid, pname FROM l JOIN p USING (pid))
SELECT least(u.pname, v.pname) AS product_a, greatest(u.pname, v.pname) AS product_b, {big('count(*)', 'times_bought_together')}
FROM named u JOIN named v ON v.oid = u.oid AND v.pid > u.pid GROUP BY 1, 2 HAVING count(*) > 1""")
ORACLE["pareto"] = sql("ok p", f"""more: per AS (SELECT pid, any_value(pname) AS pname, sum(net) AS rev FROM ok JOIN p USING (pid) GROUP BY pid),
w AS (SELECT *, sum(rev) OVER (ORDER BY rev DESC RANGE UNBOUNDED PRECEDING) AS upto, row_number() OVER (ORDER BY rev DESC, pid) AS i FROM per)
SELECT {big('i', 'product_rank')}, pname AS name, {dbl('rev', 'revenue')}, {per('upto * 100', '(SELECT sum(rev) FROM per)', 2)} AS cumulative_pct,
       {half_up('i * 100', '(SELECT count(*) FROM per)', 2)} AS pct_of_products,
       CASE WHEN 10 * upto <= 8 * (SELECT sum(rev) FROM per) THEN 'Top 80% revenue' ELSE 'Long tail' END AS pareto_group
FROM w""")
ORACLE["sales_rank"] = sql("ok p", f"""more: per AS (SELECT p.pid, any_value(pname) AS pname, sum(qty) AS units FROM p LEFT JOIN ok ON ok.pid = p.pid GROUP BY p.pid)
SELECT pid AS product_id, pname AS name, {big('units', 'units_sold')}, {big('rank() OVER (ORDER BY units DESC NULLS LAST)', 'units_rank')},
       {big('dense_rank() OVER (ORDER BY units DESC NULLS LAST)', 'units_dense_rank')}
FROM per""")
ORACLE["product_table"] = sql("x p", f"""
SELECT pid AS product_id, any_value(pname) AS product, any_value(cat) AS category, {dbl('sum(net)', 'total_revenue')}, {big('count(*)', 'total_orders')},
       {per('sum(net)', 'count(*)', 2)} AS avg_order_value, row_number() OVER (ORDER BY sum(net) DESC, pid) <= 5 AS is_top,
       row_number() OVER (ORDER BY sum(net), pid DESC) <= 5 AS is_bottom
FROM x JOIN p USING (pid) GROUP BY pid""")

# ---------------------------------------------------------------- dashboards
ORACLE["fulfilment_times"] = sql("ship", f"""more: t AS (SELECT mon, date_diff('second', ts, s0) AS a, date_diff('second', ts, s1) AS b FROM ship
                                                        WHERE state = 'delivered' AND s0 IS NOT NULL)
SELECT mon AS month, {big('count(*)', 'delivered_orders')}, {half_up('sum(a)', 'count(*) * 3600', 1)} AS avg_hours_to_ship,
       {half_up('sum(b)', 'count(*) * 86400', 1)} AS avg_days_to_deliver, round(quantile_cont(b / 86400.0, 0.5), 1) AS median_days_to_deliver
FROM t GROUP BY mon""")
ORACLE["kpis_by_year"] = sql("x p c", f"""more: y AS (SELECT *, year(day) AS yr FROM x),
prod AS (SELECT yr, pname, sum(net) AS v FROM y LEFT JOIN p USING (pid) GROUP BY ALL), geo AS (SELECT yr, region, sum(net) AS v FROM y LEFT JOIN c USING (cid) GROUP BY ALL),
t AS (SELECT yr, sum(net) AS rev, sum(qty) AS units, coalesce(sum(net) FILTER (month(day) < 7), 0) AS h1, coalesce(sum(net) FILTER (month(day) > 6), 0) AS h2 FROM y GROUP BY yr),
u AS (SELECT *, CASE WHEN h1 = 0 THEN 0 ELSE {per('h2 - h1', 'h1', 4)} END AS gr FROM t)
SELECT yr AS year, {dbl('rev', 'total_revenue')}, {big('units', 'total_units')}, {dbl('h1', 'h1_revenue')}, {dbl('h2', 'h2_revenue')}, gr AS growth,
       (SELECT pname FROM prod WHERE prod.yr = u.yr ORDER BY v DESC, pname LIMIT 1) AS top_product,
       (SELECT region FROM geo WHERE geo.yr = u.yr ORDER BY v DESC, region LIMIT 1) AS top_region, {per('rev', '12', 2)} AS avg_revenue_per_month,
       '$' || format('{{:,}}', CAST(floor(rev) AS BIGINT)) || right(CAST(CAST(rev AS DECIMAL(38,2)) AS VARCHAR), 3) AS revenue_text,
       format('{{:.1f}}', gr * 100) || '%' AS growth_text
FROM u""")


def _shares(key: str, frames: str, join: str) -> str:
    return sql(f"x {frames}", f"""SELECT {key[0]} AS {key[1]}, {dbl('sum(net)', 'revenue')}, {big('count(*)', 'orders')}, {per('sum(net)', 'count(*)', 2)} AS avg_order_value,
       {per('sum(net)', '(SELECT sum(net) FROM x)', 4)} AS share FROM x LEFT JOIN {join} GROUP BY 1""")


ORACLE["country_breakdown"] = _shares(("nation", "country"), "c", "c USING (cid)")
ORACLE["region_breakdown"] = _shares(("region", "region"), "c", "c USING (cid)")
ORACLE["category_breakdown"] = _shares(("cat", "category"), "p", "p USING (pid)")
ORACLE["region_detail"] = sql("x c p", f"""more: d AS (SELECT region, mon, pname, qty, net FROM x LEFT JOIN c USING (cid) LEFT JOIN p USING (pid))
SELECT region, mon AS month, pname AS product, {big('sum(qty)', 'units')}, {dbl('sum(net)', 'revenue')} FROM d GROUP BY region, mon, pname
UNION ALL SELECT region, NULL, 'TOTAL', CAST(sum(qty) AS BIGINT), CAST(sum(net) AS DOUBLE) FROM d GROUP BY region""")
ORACLE["dashboard_regions"] = sql("x c", f"""
SELECT region, {dbl('sum(net)', 'revenue')}, {big('count(*)', 'orders')}, {big('sum(qty)', 'units')}, {per('sum(net) * 100', '(SELECT sum(net) FROM x)', 2)} AS share_pct
FROM x LEFT JOIN c USING (cid) GROUP BY region""")
ORACLE["dashboard_trend"] = sql("x p", f"""more: d AS (SELECT cat, mon, net FROM x LEFT JOIN p USING (pid)),
cal AS (SELECT CAST(unnest(range(min(mon), max(mon) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS mon FROM d)
SELECT k.cat AS category, cal.mon AS month, {dbl('coalesce(sum(d.net), 0)', 'revenue')}, {big('count(d.net)', 'orders')}
FROM (SELECT DISTINCT cat FROM p) k CROSS JOIN cal LEFT JOIN d ON d.cat = k.cat AND d.mon = cal.mon GROUP BY k.cat, cal.mon""")
ORACLE["dashboard_kpis"] = sql("x", f"""
SELECT {dbl('sum(net)', 'total_revenue')}, {per('sum(net)', 'count(*)', 2)} AS avg_revenue, {big('count(oid)', 'transactions')}, {big('sum(qty)', 'total_units')} FROM x""")
_AFR = "FILTER (cat = 'SMALL' AND region = 'AFRICA')"
ORACLE["criteria_report"] = sql("x c p", f"""
SELECT {dbl("coalesce(sum(net) FILTER (region = 'EUROPE'), 0)", 'revenue_europe')},
       {dbl("coalesce(sum(net) FILTER (region = 'EUROPE' AND cat = 'PROMO'), 0)", 'revenue_europe_promo')},
       {big("count(*) FILTER (nation = 'GERMANY')", 'lines_germany')}, {big("count(*) FILTER (region = 'ASIA' AND qty > 24)", 'lines_asia_qty25')},
       {big("count(*) FILTER (region IS DISTINCT FROM 'ASIA')", 'lines_not_asia')},
       {per("sum(net) FILTER (region = 'AMERICA')", "count(*) FILTER (region = 'AMERICA')", 2)} AS avg_revenue_america,
       {half_up(f"sum(qty) {_AFR}", f"count(*) {_AFR}", 4)} AS avg_qty_small_africa,
       {dbl("coalesce(sum(net) FILTER (mon = DATE '1996-01-01'), 0)", 'revenue_jan_1996')}
FROM x LEFT JOIN c USING (cid) LEFT JOIN p USING (pid)""")
ORACLE["monthly_trends"] = sql("x", f"""
SELECT a.mon AS month, {big('count(*)', 'orders')}, {dbl('sum(net)', 'revenue')}, {per('sum(net)', 'count(*)', 2)} AS avg_order_value,
       {big('(SELECT count(*) FROM (SELECT cid FROM x GROUP BY cid HAVING min(mon) = a.mon))', 'new_customers')}
FROM x a GROUP BY a.mon""")
ORACLE["executive_kpis"] = sql("x c p", f"""more: geo AS (SELECT nation, sum(net) AS v FROM x LEFT JOIN c USING (cid) GROUP BY nation),
prod AS (SELECT pname, sum(net) AS v FROM x LEFT JOIN p USING (pid) GROUP BY pname)
SELECT {dbl('sum(net)', 'total_revenue')}, {big('count(*)', 'total_orders')}, {big('count(DISTINCT cid)', 'unique_customers')},
       (SELECT min(nation) FROM geo WHERE v = (SELECT max(v) FROM geo)) AS top_country, (SELECT min(pname) FROM prod WHERE v = (SELECT max(v) FROM prod)) AS top_product,
       {per('sum(net)', 'count(*)', 2)} AS avg_order_value
FROM x""")
ORACLE["country_top_products"] = sql("x c p", f"""more: d AS (SELECT nation, pname, sum(net) AS v FROM x LEFT JOIN c USING (cid) LEFT JOIN p USING (pid) GROUP BY nation, pname)
SELECT nation AS country, {big('row_number() OVER (PARTITION BY nation ORDER BY v DESC, pname)', 'rank')}, pname AS product, {dbl('v', 'revenue')},
       {per('v', 'sum(v) OVER (PARTITION BY nation)', 4)} AS share_of_country
FROM d QUALIFY rank <= 3""")
ORACLE["order_numbers"] = sql("o", """SELECT oid AS order_id, day AS order_day, 'ORD-' || format('{:05d}', row_number() OVER (ORDER BY day, oid)) AS order_no FROM o""")

# ---------------------------------------------------------------- budget
_NET = "coalesce(sum(amt) FILTER (inc), 0) - coalesce(sum(amt) FILTER (NOT inc), 0)"
_IN, _OUT = "coalesce(sum(amt) FILTER (inc), 0)", "coalesce(sum(amt) FILTER (NOT inc), 0)"


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN {den} = 0 THEN 0 ELSE {per(num, den, 4)} END"


ORACLE["budget_vs_actual"] = sql("g b", """more: spent AS (SELECT year(day) AS y, month(day) AS mm, cat, sum(amt) AS a FROM g WHERE NOT inc GROUP BY ALL),
cells AS (SELECT y.y, b.cat, k.mm, b.budget AS bud, coalesce(s.a, 0) AS act
          FROM b CROSS JOIN (SELECT unnest(range(min(y), max(y) + 1)) AS y FROM spent) y CROSS JOIN (SELECT unnest(range(1, 13)) AS mm) k
          LEFT JOIN spent s ON s.y = y.y AND s.cat = b.cat AND s.mm = k.mm),
allc AS (FROM cells UNION ALL SELECT y, 'TOTAL', mm, sum(bud), sum(act) FROM cells GROUP BY y, mm)
SELECT y AS year, cat AS category, """ + ",\n".join(
    f"{big(f'sum(bud) FILTER (mm = {i})', f'm{i:02d}_budget')}, {dbl(f'sum(act) FILTER (mm = {i})', f'm{i:02d}_actual')}, "
    f"{dbl(f'sum(bud - act) FILTER (mm = {i})', f'm{i:02d}_variance')}, "
    f"{_ratio(f'sum(bud - act) FILTER (mm = {i})', f'sum(bud) FILTER (mm = {i})')} AS m{i:02d}_var_pct" for i in range(1, 13)) + "\nFROM allc GROUP BY y, cat")
ORACLE["monthly_cashflow"] = sql("g", f"""more: t AS (SELECT CAST(date_trunc('month', day) AS DATE) AS mon, {_IN} AS i, {_OUT} AS e FROM g GROUP BY 1)
SELECT mon AS month, {dbl('i', 'income')}, {dbl('e', 'expense')}, {dbl('i - e', 'net')}, {_ratio('i - e', 'i')} AS savings_rate,
       {dbl('(SELECT sum(z.i - z.e) FROM t z WHERE z.mon <= t.mon)', 'cumulative_net')} FROM t""")
ORACLE["expense_categories"] = sql("g b", f"""more: t AS (SELECT year(day) AS y, cat, sum(amt) AS s FROM g WHERE NOT inc GROUP BY ALL)
SELECT y AS year, t.cat AS category, {dbl('s', 'total_spent')}, {_ratio('s', '(SELECT sum(z.s) FROM t z WHERE z.y = t.y)')} AS pct_of_total,
       {per('s', '12', 2)} AS monthly_average, {big('12 * coalesce(budget, 0)', 'annual_budget')}, {dbl('12 * coalesce(budget, 0) - s', 'over_under')},
       CASE WHEN s <= 12 * coalesce(budget, 0) THEN 'Under Budget' ELSE 'Over Budget' END AS status
FROM t LEFT JOIN b ON b.cat = t.cat""")
ORACLE["top_expense_categories"] = sql("g", f"""
SELECT year(day) AS year, cat AS category, {dbl('sum(amt)', 'total_spent')}, {big('row_number() OVER (PARTITION BY year(day) ORDER BY sum(amt) DESC, cat)', 'rank')}
FROM g WHERE NOT inc GROUP BY 1, 2 QUALIFY rank <= 5""")
ORACLE["month_profile"] = sql("g", f"""
SELECT year(day) AS year, monthname(min(day)) AS month_name, {dbl(_IN, 'income')}, {dbl(_OUT, 'expense')} FROM g GROUP BY year(day), month(day)""").replace(
    "SELECT year(day) AS year,", "SELECT CAST(year(day) AS BIGINT) AS year,")
ORACLE["annual_summary"] = sql("g b", f"""more: mo AS (SELECT year(day) AS y, month(day) AS mm, {_NET} AS v FROM g GROUP BY ALL),
ca AS (SELECT year(day) AS y, cat, sum(amt) AS v FROM g WHERE NOT inc GROUP BY ALL), t AS (SELECT year(day) AS y, {_IN} AS i, {_OUT} AS e FROM g GROUP BY 1),
bb AS (SELECT 12 * sum(budget) AS tot FROM b)
SELECT y AS year, {dbl('i', 'total_income')}, {dbl('e', 'total_expenses')}, {dbl('i - e', 'net_savings')}, {_ratio('i - e', 'i')} AS savings_rate,
       {per('i', '12', 2)} AS avg_monthly_income, {per('e', '12', 2)} AS avg_monthly_expenses, {per('i - e', '12', 2)} AS avg_monthly_savings,
       (SELECT monthname(make_date(2000, mm, 1)) FROM mo WHERE mo.y = t.y ORDER BY v DESC, mm LIMIT 1) AS best_month,
       (SELECT monthname(make_date(2000, mm, 1)) FROM mo WHERE mo.y = t.y ORDER BY v, mm LIMIT 1) AS worst_month,
       (SELECT cat FROM ca WHERE ca.y = t.y ORDER BY v DESC, cat LIMIT 1) AS largest_expense_category,
       {dbl('tot - e', 'overall_variance')}, CASE WHEN e <= tot THEN 'On Track' ELSE 'Over Budget' END AS budget_health
FROM t CROSS JOIN bb""")
ORACLE["quarterly_summary"] = sql("g", f"""more: t AS (SELECT year(day) AS y, concat('Q', quarter(day)) AS q, {_IN} AS i, {_OUT} AS e FROM g GROUP BY ALL)
SELECT y AS year, q AS quarter, {dbl('i', 'income')}, {dbl('e', 'expense')}, {dbl('i - e', 'net')}, {_ratio('i - e', 'i')} AS savings_rate FROM t""")

# ---------------------------------------------------------------- series
FRAMES["ser"] = f"""SELECT mon, year(mon) AS yr, CAST({per('sum(net)', '1000', 2)} AS DECIMAL(18,2)) AS a, CAST({half_up('sum(disc) * 100', 'count(*)', 2)} AS DECIMAL(18,2)) AS b
                   FROM x GROUP BY mon"""
_STATS = ", ".join(f"{per(f'sum({k})', 'count(*)', 2)} AS avg_{n}, {dbl(f'min({k})', f'min_{n}')}, {dbl(f'max({k})', f'max_{n}')}" for k, n in (("a", "x"), ("b", "y")))
_CORR = """CASE WHEN count(*) < 2 THEN NULL WHEN min(a) = max(a) OR min(b) = max(b) THEN 0
            ELSE round(covar_pop(CAST(a AS DOUBLE), CAST(b AS DOUBLE)) / (stddev_pop(CAST(a AS DOUBLE)) * stddev_pop(CAST(b AS DOUBLE))), 3) END AS corr"""
ORACLE["yearly_stats"] = sql("ser", f"""
SELECT yr AS year, {big('count(*)', 'n')}, {_STATS}, {_CORR}, sum(a) > 50 * count(*) AS high_x,
       sum(a) * (SELECT count(*) FROM ser) > (SELECT sum(a) FROM ser) * count(*) AS above_average_x
FROM ser GROUP BY yr""")
_AT = ", ".join(f"(SELECT min(mon) FROM ser WHERE {k} = (SELECT {f}({k}) FROM ser)) AS {f}_{n}_month" for k, n in (("a", "x"), ("b", "y")) for f in ("min", "max"))
ORACLE["overall_stats"] = sql("ser", f"""
SELECT {big('count(*)', 'n')}, {_STATS}, {_CORR}, {_AT}, max(mon) AS latest_month, {dbl('arg_max(a, mon)', 'latest_x')}, {dbl('arg_max(b, mon)', 'latest_y')} FROM ser""")

# ---------------------------------------------------------------- cleaning
_NA = "('', 'N/A', 'n/a', 'NA', 'null', 'NULL', 'none', 'None', '-')"


def _na(c: str) -> str:
    return f"CASE WHEN {c} IN {_NA} THEN NULL ELSE {c} END AS {c}"


def _caps(x: str) -> str:
    """First letter of each run of letters upper case, the others lower case."""
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '(\\p{{L}}+|[^\\p{{L}}]+)'), lambda w: upper(w[1]) || w[2:]), '')")


def _tidy(x: str) -> str:
    return f"trim(regexp_replace({x}, '[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+', ' ', 'g'))"


FRAMES["da"] = f"SELECT doc_id, {_na('text')}, {_na('lang')}, {_na('source')} FROM documents"
FRAMES["ca"] = f"SELECT conv_id, turn, {_na('role')}, {_na('text')} FROM conversations"
FRAMES["dz"] = f"""SELECT doc_id, {_tidy('text')} AS text,
                          CASE lower(trim(lang)) WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' WHEN 'es' THEN 'Spanish'
                               ELSE {_caps('trim(lang)')} END AS lang, {_caps(_tidy('source'))} AS source
                   FROM da QUALIFY row_number() OVER (PARTITION BY text, lang, source ORDER BY doc_id) = 1"""
FRAMES["cz"] = f"""SELECT conv_id, turn, {_caps(_tidy('role'))} AS role, {_tidy('text')} AS text
                   FROM (SELECT DISTINCT conv_id, turn, role, text FROM ca)"""
NEEDS |= {"dz": ["da"], "cz": ["ca"]}
_DOC = ("documents", "da", "dz", ["text", "lang", "source"], ["text", "lang", "source"])
_CONV = ("conversations", "ca", "cz", ["role", "text"], ["conv_id", "turn", "role", "text"])


def _missing(frame: str, columns: list[str]) -> str:
    return f"(SELECT {' + '.join(f'count(*) FILTER ({c} IS NULL)' for c in columns)} FROM {frame})"


ORACLE["cleaned_documents"] = sql("dz", "SELECT * FROM dz")
ORACLE["cleaned_conversations"] = sql("cz", "SELECT * FROM cz")
ORACLE["cleaning_null_report"] = sql("dz cz", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {big(_missing(a, [c]), 'nulls_before')}, {big(_missing(z, [c]), 'nulls_after')}, '{t}' AS \"table\""
    for t, a, z, columns, _ in (_DOC, _CONV) for c in columns))
ORACLE["cleaning_summary"] = sql("dz cz", "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {big(f'(SELECT count(*) FROM {a})', 'rows_before')}, "
    f"{big(f'(SELECT count(*) FROM {a}) - (SELECT count(*) FROM (SELECT DISTINCT ' + ', '.join(equal) + f' FROM {a}))', 'duplicates_removed')}, "
    f"{big(f'(SELECT count(*) FROM {z})', 'rows_after')}, {big(_missing(a, columns), 'nulls_before')}, {big(_missing(z, columns), 'nulls_after')}"
    for t, a, z, columns, equal in (_DOC, _CONV)))
ORACLE["cleaning_value_counts"] = sql("dz cz", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count, '{t}' AS \"table\" FROM {z} GROUP BY {c}"
    for t, z, c in (("documents", "dz", "lang"), ("documents", "dz", "source"), ("conversations", "cz", "role"))))

# ---------------------------------------------------------------- constraints
FRAMES["tree"] = """SELECT CAST(r_regionkey AS BIGINT) AS id, CAST(NULL AS BIGINT) AS up, r_name AS name FROM region
                    UNION ALL SELECT 100 + n_nationkey, n_regionkey, n_name FROM nation"""


def _rule(table: str, rule: str, frame: str, broken: str) -> str:
    return f"SELECT '{rule}' AS rule, '{table}' AS \"table\", (SELECT count(*) FROM {frame}) AS checked, {big(broken, 'violations')}"


def _false(frame: str, cond: str) -> str:
    return f"(SELECT count(*) FROM {frame} WHERE ({cond}) IS FALSE)"


def _twice(frame: str, key: str) -> str:
    null = " OR ".join(f"{k.strip()} IS NULL" for k in key.split(","))
    return f"(SELECT count(*) FROM (SELECT count(*) OVER (PARTITION BY {key}) AS n, ({null}) AS hollow FROM {frame}) WHERE n > 1 AND NOT hollow)"


def _lost(frame: str, key: str, parent: str, pk: str) -> str:
    return f"(SELECT count(*) FROM {frame} z WHERE z.{key} IS NOT NULL AND z.{key} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL))"


_CHECKS = [  # table, frame, not null (name, column), rules (name, condition), unique (name, key), foreign (name, column, parent, key)
    ("categories", "tree", [("id", "id"), ("name", "name")], [("length(name) <= 100", "length(name) <= 100")], [("id", "id"), ("name", "name")],
     [("parent_id", "up", "tree", "id")]),
    ("customers", "c", [("customer_id", "cid"), ("first_name", "first"), ("last_name", "last"), ("email", "mail"), ("country", "region")],
     [("length(first_name) <= 50", "length(first) < 51"), ("length(last_name) <= 50", "length(last) < 51"), ("length(email) <= 255", "length(mail) < 256"),
      ("length(city) <= 100", "length(nation) < 101"), ("length(country) <= 100", "length(region) < 101"),
      ("email_format", "regexp_full_match(mail, '[a-z0-9._%+-]+@[a-z0-9.-]+[.][a-z]{2,}', 'i')")],
     [("customer_id", "cid"), ("email", "mail")], []),
    ("products", "p", [("product_id", "pid"), ("category", "cat"), ("name", "pname"), ("price", "price"), ("sku", "sku"), ("is_active", "active")],
     [("length(name) <= 200", "length(pname) < 201"), ("length(sku) <= 50", "length(sku) < 51"), ("price > 0", "price > 0"), ("size is null or > 0", "size IS NULL OR size > 0")],
     [("product_id", "pid"), ("sku", "sku")], []),
    ("orders", "o", [("order_id", "oid"), ("customer_id", "cid"), ("status", "state"), ("total_amount", "amount"), ("order_date", "ts")],
     [("length(status) <= 20", "length(state) < 21"), ("status in enum", "state IN ('pending', 'processing', 'shipped', 'delivered', 'cancelled', 'refunded')"),
      ("total_amount >= 0", "amount >= 0")], [("order_id", "oid")], [("customer_id", "cid", "c", "cid")]),
    ("order_items", "l", [("order_id", "oid"), ("product_id", "pid"), ("quantity", "qty"), ("gross", "gross"), ("discount", "disc"), ("line_total", "net")],
     [("quantity > 0", "qty > 0"), ("gross > 0", "gross > 0"), ("discount between 0 and 1", "disc >= 0 AND disc <= 1"),
      ("line_total generated", "net = CAST(round(gross - gross * disc, 2) AS DECIMAL(12,2))"),
      ("line_total generated from percent", "net = CAST(round(gross * (100 - disc * 100) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2))")],
     [("order_id, line_no", "oid, lno")], [("order_id", "oid", "o", "oid"), ("product_id", "pid", "p", "pid")]),
    ("inventory", "p", [("product_id", "pid"), ("quantity", "stock"), ("reorder_level", "level"), ("reorder_quantity", "50")],
     [("quantity >= 0", "stock >= 0"), ("reorder_level >= 0", "level >= 0"), ("reorder_quantity > 0", "true")], [("product_id", "pid")], [("product_id", "pid", "p", "pid")]),
    ("reviews", "r", [("product_id", "pid"), ("customer_id", "cid"), ("rating", "stars")], [("rating between 1 and 5", "stars >= 1 AND stars <= 5")],
     [("product_id, customer_id", "pid, cid")], [("product_id", "pid", "p", "pid"), ("customer_id", "cid", "c", "cid")]),
]
ORACLE["constraint_report"] = sql("tree c p o l r", "\nUNION ALL ".join(
    q for t, f, filled, rules, unique, foreign in _CHECKS for q in (
        *(_rule(t, f"not_null({n})", f, _false(f, f"{k} IS NOT NULL")) for n, k in filled), *(_rule(t, n, f, _false(f, k)) for n, k in rules),
        *(_rule(t, f"unique({n})", f, _twice(f, k)) for n, k in unique), *(_rule(t, f"foreign_key({n})", f, _lost(f, k, pf, pk)) for n, k, pf, pk in foreign))))

# ---------------------------------------------------------------- pages
# Markup that isn't shown, whichever opens first; what is never closed runs to the end.
_HIDDEN = r"(?is)<(?:!--.*?(?:-->|$)|script[^>]*>.*?(?:</script>|$)|style[^>]*>.*?(?:</style>|$))"


def _shown(fragment: str) -> str:
    out = f"regexp_replace({fragment}, '<[^>]*>', ' ', 'g')"
    for code, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("nbsp", " "), ("amp", "&")):
        out = f"replace({out}, '&{code};', '{char}')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'), ' ')"


def _inside(tag: str) -> str:
    return f"regexp_extract(h, '(?s)<{tag}[^>]*>(.*?)(?:</{tag}>|$)', 1)"


FRAMES["pg"] = f"SELECT page_id, url, regexp_replace(html, '{_HIDDEN}', '', 'g') AS h FROM pages"
FRAMES["rec"] = f"""SELECT page_id, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1) AS host, regexp_extract(h, '<html[^>]*\\slang="([^"]*)"', 1) AS lang,
                           coalesce(nullif({_shown(_inside('h1'))}, ''), 'N/A') AS title, len(regexp_extract_all({_inside('nav')}, '<a[\\s>/]')) AS nav_links,
                           len(regexp_extract_all({_inside('article')}, '<p[\\s>/]')) AS paragraphs,
                           len(list_filter(string_split({_shown(_inside('article'))}, ' '), lambda w: w <> '')) AS words
                    FROM pg"""
FRAMES["pods"] = """SELECT try_cast(replace(replace(trim(regexp_extract(pod, 'class="[^"]*price_color[^"]*"[^>]*>([^<]*)<', 1)), '£', ''), 'Â', '') AS DOUBLE) AS price,
                           greatest(list_position(['One', 'Two', 'Three', 'Four', 'Five'], regexp_extract(pod, '<p[^>]*class="star-rating\\s+([A-Za-z]+)', 1)), 0) AS rating,
                           'Unknown' AS category
                    FROM (SELECT unnest(regexp_extract_all(h, '(?s)<article[^>]*class="[^"]*product_pod[^"]*"[^>]*>(.*?)</article>', 1)) AS pod FROM pg)"""
NEEDS |= {"rec": ["pg"], "pods": ["pg"]}
ORACLE["page_records"] = sql("rec", f"SELECT page_id, host, lang, title, {big('nav_links', 'nav_links')}, {big('paragraphs', 'paragraphs')}, {big('words', 'words')} FROM rec")
ORACLE["page_summary"] = sql("rec pods", f"""
SELECT {big('count(*)', 'pages')}, {big("count(*) FILTER (title <> 'N/A')", 'titled_pages')}, {big('count(DISTINCT host)', 'hosts')}, {big('count(DISTINCT lang)', 'languages')},
       {big('sum(words)', 'total_words')}, {big('sum(nav_links)', 'total_nav_links')}, {big('(SELECT count(*) FROM pods)', 'product_records')},
       (SELECT round(avg(price), 2) FROM pods) AS product_avg_price, (SELECT round(avg(rating), 1) FROM pods) AS product_avg_rating,
       {big('(SELECT count(DISTINCT category) FROM pods)', 'product_categories')}
FROM rec""")

# ---------------------------------------------------------------- profiles
# Numeric columns (1-based position, name) of the driver tables.
NUMERIC_COLUMNS = {
    "region": [(1, "r_regionkey")],
    "nation": [(1, "n_nationkey"), (3, "n_regionkey")],
    "customer": [(1, "c_custkey"), (3, "c_nationkey"), (4, "c_acctbal")],
    "supplier": [(1, "s_suppkey"), (3, "s_nationkey"), (4, "s_acctbal")],
    "part": [(1, "p_partkey"), (5, "p_size"), (6, "p_retailprice")],
    "orders": [(1, "o_orderkey"), (2, "o_custkey"), (4, "o_totalprice")],
    "lineitem": [(1, "l_orderkey"), (2, "l_partkey"), (3, "l_suppkey"), (4, "l_linenumber"), (5, "l_quantity"),
                 (6, "l_extendedprice"), (7, "l_discount"), (8, "l_tax")],
    "events": [(1, "event_id"), (3, "user_id"), (5, "value")],
    "documents": [(1, "doc_id"), (5, "n_chars")],
    "embeddings": [(1, "vec_id"), (3, "label")],
    "pages": [(1, "page_id")],
    "benchmark": [(1, "item_id")],
    "labels": [(1, "doc_id"), (2, "quality"), (3, "toxic")],
    "conversations": [(1, "conv_id"), (2, "turn")],
}
ORACLE["folder_profile"] = "WITH f AS (" + "\nUNION ALL ".join(
    f"SELECT '{t}.parquet' AS file_name, count(*) AS data_rows, (SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}') AS column_count, "
    f"{big(str(len(cols)), 'numeric_column_count')}, 'OK' AS status FROM {t}"
    for t, cols in NUMERIC_COLUMNS.items()) + ")\nFROM f UNION ALL SELECT 'TOTAL', CAST(sum(data_rows) AS BIGINT), NULL, NULL, NULL FROM f"
ORACLE["folder_column_profile"] = "\nUNION ALL ".join(
    f"SELECT '{t}.parquet' AS file_name, {big(str(i), 'col_no')}, '{c}' AS col_name, {dbl(f'min({c})', 'min')}, {dbl(f'max({c})', 'max')}, round(avg(CAST({c} AS DOUBLE)), 4) AS avg FROM {t}"
    for t, cols in NUMERIC_COLUMNS.items() for i, c in cols)

# A document is a file: lines, then cells at commas outside double quotes.
FRAMES["ln"] = """SELECT doc_id, i - 1 AS no, list_transform(string_split(array_to_string(list_transform(string_split(s[i], '"'), lambda q, k:
                           CASE WHEN k % 2 = 0 THEN q WHEN q = '' AND k > 1 AND k < len(string_split(s[i], '"')) THEN '"' ELSE replace(q, ',', chr(1)) END), ''), chr(1)),
                         lambda v: trim(v, ' ')) AS cells
                  FROM (SELECT doc_id, string_split(CASE WHEN right(text, 1) = chr(10) THEN left(text, -1) ELSE text END, chr(10)) AS s FROM documents WHERE text <> ''),
                       unnest(range(1, len(s) + 1)) t(i)"""
FRAMES["cl"] = """SELECT doc_id, no, k AS col, CASE WHEN regexp_full_match(v, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN CAST(v AS DOUBLE) END AS num
                  FROM (SELECT doc_id, no, k, replace(replace(trim(cells[k], ' '), '$', ''), ',', '') AS v FROM ln, unnest(range(1, len(cells) + 1)) t(k) WHERE no > 0)"""
FRAMES["cp"] = """SELECT doc_id, col, min(num) AS lo, max(num) AS hi, avg(num) AS mean, count(num) AS nums, count(*) AS n,
                         count(*) FILTER (no <= 10) > 0 AND 10 * count(num) FILTER (no <= 10) >= 7 * count(*) FILTER (no <= 10)
                           AND col <= any_value(h.w) AS numeric, any_value(h.cells[col]) AS title
                  FROM cl JOIN (SELECT doc_id, cells, len(cells) AS w FROM ln WHERE no = 0) h USING (doc_id) GROUP BY doc_id, col"""
NEEDS |= {"cl": ["ln"], "cp": ["cl", "ln"]}
_SIZE = """CASE WHEN size_bytes >= 1073741824 THEN format('{:.1f} GB', size_bytes / 1073741824.0) WHEN size_bytes >= 1048576 THEN format('{:.1f} MB', size_bytes / 1048576.0)
            WHEN size_bytes >= 1024 THEN format('{:.1f} KB', size_bytes / 1024.0) ELSE size_bytes || ' bytes' END"""
ORACLE["document_profile"] = sql("cp", f"""more: f AS (
  SELECT doc_id AS file_idx, CAST(doc_id AS VARCHAR) AS file_name, strlen(coalesce(text, '')) AS size_bytes, left(doc_id || '_' || doc_id, 31) AS sheet_name,
         (SELECT count(*) FROM ln WHERE ln.doc_id = d.doc_id) AS row_count, (SELECT count(*) FROM ln WHERE ln.doc_id = d.doc_id AND no > 0) AS data_row_count,
         coalesce((SELECT len(cells) FROM ln WHERE ln.doc_id = d.doc_id AND no = 0), 0) AS column_count,
         (SELECT count(*) FROM cp WHERE cp.doc_id = d.doc_id AND numeric) AS numeric_column_count
  FROM documents d)
SELECT *, {_SIZE} AS size_text, CASE WHEN size_bytes = 0 THEN 'Empty' ELSE 'OK' END AS status FROM f
UNION ALL SELECT NULL, 'TOTAL', CAST(sum(size_bytes) AS BIGINT), NULL, CAST(sum(row_count) AS BIGINT), NULL, NULL, NULL, NULL, NULL FROM f""")
ORACLE["document_column_profile"] = sql("cp", """
SELECT CAST(doc_id AS VARCHAR) AS file_name, col AS col_no, title AS col_name, lo AS min, hi AS max, round(mean, 4) AS avg, n AS cells, nums AS numeric_cells, numeric AS is_numeric
FROM cp""")
ORACLE["document_preview"] = sql("ln", "SELECT CAST(doc_id AS VARCHAR) AS file_name, no AS row_no, array_to_string(cells, '|') AS cells FROM ln WHERE no BETWEEN 1 AND 5")

# ---------------------------------------------------------------- tree, formulas
ORACLE["tree_rollup"] = sql("tree ok c", f"""more: own AS (SELECT 100 + nat AS id, count(DISTINCT cid) AS n, coalesce(sum(net), 0) AS v FROM c LEFT JOIN ok USING (cid) GROUP BY nat),
sub AS (SELECT t.id, t.name, t.up, coalesce(sum(own.n), 0) AS n, coalesce(sum(own.v), 0) AS v
        FROM tree t LEFT JOIN tree k ON k.id = t.id OR k.up = t.id LEFT JOIN own ON own.id = k.id GROUP BY ALL)
SELECT s.id, s.name, {big('CASE WHEN s.up IS NULL THEN 1 ELSE 2 END', 'level')}, coalesce(q.name, s.name) AS root_name,
       concat_ws(' > ', q.name, s.name) AS path, {big('s.n', 'customers')}, {dbl('s.v', 'revenue')}
FROM sub s LEFT JOIN tree q ON q.id = s.up""")
# Business days are counted over generated calendars, not by a closed form.
ORACLE["order_calendar"] = sql("ship", f"""more: d AS (SELECT oid, day AS a, CAST(s1 AS DATE) AS z FROM ship WHERE s1 IS NOT NULL)
SELECT oid AS order_id, a AS order_day, concat('Q', quarter(a)) AS quarter, strftime(a, '%b-%Y') AS month_label, last_day(a) AS month_end,
       last_day(a + INTERVAL 1 MONTH) AS next_month_end, {big('len([t FOR t IN range(a, z + 1, INTERVAL 1 DAY) IF isodow(t) < 6])', 'business_days_to_deliver')},
       CAST([t FOR t IN range(a + 1, a + 31, INTERVAL 1 DAY) IF isodow(t) < 6][10] AS DATE) AS tenth_business_day,
       CAST([t FOR t IN range(a - 1, a - 15, INTERVAL (-1) DAY) IF isodow(t) < 6][3] AS DATE) AS third_business_day_before,
       {big("datediff('month', a, z) - CAST(day(z) < day(a) AS INTEGER)", 'months_to_deliver')}, {big('z - a', 'days_to_deliver')}
FROM d""")
ORACLE["customer_text"] = sql("c", f"""
SELECT cid AS customer_id, string_split(mail, '@')[1] AS user, left(mail, 4) AS email_head, strpos(mail, '@') AS at_position, {_caps('last')} AS segment_proper,
       right(first, 4) AS name_tail, substr(first, 10, 3) AS name_mid, replace(first, '#', ' No. ') AS name_label,
       array_to_string(list_filter(string_split(nation || ' ' || region, ' '), lambda w: w <> ''), ' ') AS place, 'Hello, ' || coalesce({_caps('nation')}, '') || '!' AS greeting
FROM c""")
ORACLE["order_lookups"] = sql("o c", """
SELECT oid AS order_id, c.first AS customer_name, coalesce((SELECT n_name FROM nation WHERE n_nationkey = c.nat AND n_regionkey <> 0), 'Not found') AS nation,
       CASE WHEN amount >= 300000 THEN 'Key account' WHEN amount >= 150000 THEN 'Large' WHEN amount >= 50000 THEN 'Medium' WHEN amount >= 0 THEN 'Small' END AS tier
FROM o LEFT JOIN c USING (cid)""")

# ---------------------------------------------------------------- files written and read back
ORACLE["documents_csv"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
ORACLE["region_rewrite"] = sql("o c", f"""more: k AS (SELECT region, oid, amount, region = 'ASIA' AS new FROM o JOIN c USING (cid) WHERE region <> 'ASIA' OR state = 'delivered')
SELECT region, count(*) AS rows, {dbl("sum(CASE WHEN new THEN round(amount * 1.02, 2) ELSE amount END)", 'amount')}, count(*) FILTER (new) AS revised_rows, CAST(sum(oid) AS DOUBLE) AS id_sum
FROM k GROUP BY region""")
ORACLE["report_bundle"] = sql("o l p", "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", CAST(2 AS BIGINT) AS version, count(*) AS rows, {dbl(f'sum({m})', 'total')} FROM {f}" for t, f, m in (("orders", "o", "amount"), ("items", "l", "net"), ("products", "p", "price"))))
ORACLE["quarantined_rows"] = sql("o c r", """more: b AS (
  SELECT 'orders' AS "table", oid AS key, list_filter([CASE WHEN cid IS NOT NULL AND cid NOT IN (SELECT cid FROM r WHERE cid IS NOT NULL) THEN 'foreign_key(customer_id)' END,
         CASE WHEN cid IS NULL THEN 'not_null(customer_id)' END, CASE WHEN state NOT IN ('delivered', 'processing', 'pending') THEN 'status in list' END,
         CASE WHEN amount < 1000 THEN 'total_amount >= 1000' END, CASE WHEN count(*) OVER (PARTITION BY oid) > 1 THEN 'unique(order_id)' END], lambda v: v IS NOT NULL) AS bad FROM o
  UNION ALL
  SELECT 'customers', cid, list_filter([CASE WHEN NOT regexp_full_match(mail, '[a-z0-9._%+-]+@[a-z0-9.-]+[.][a-z]{2,}', 'i') THEN 'email_format' END,
         CASE WHEN cid NOT IN (SELECT cid FROM o WHERE cid IS NOT NULL) THEN 'foreign_key(customer_id)' END, CASE WHEN region = 'EUROPE' THEN 'region isn''t EUROPE' END,
         CASE WHEN count(*) OVER (PARTITION BY cid) > 1 THEN 'unique(customer_id)' END, CASE WHEN count(*) OVER (PARTITION BY mail) > 1 THEN 'unique(email)' END], lambda v: v IS NOT NULL) FROM c)
SELECT "table", CAST(key AS BIGINT) AS key, array_to_string(bad, '; ') AS broken FROM b WHERE len(bad) > 0""")
ORACLE["cleaned_sales"] = """WITH x AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_id, CAST(o_orderdate AS DATE) AS day, (l_orderkey * 7 + l_linenumber) % 12 AS kind, CAST(l_quantity AS INTEGER) AS qty,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price, l_returnflag AS flag, concat(lower(l_linestatus), '-line o''part') AS item, l_orderkey % 10 AS clerk
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
), w AS (
  SELECT DISTINCT order_id, kind, CASE WHEN kind < 10 THEN day END AS day, CASE WHEN kind NOT IN (8, 10) THEN qty END AS qty, CASE WHEN kind <> 10 THEN price END AS price, flag, item, clerk FROM x
), y AS (
  SELECT *, day AS d, CASE WHEN kind < 6 THEN qty WHEN kind < 8 THEN qty + qty % 2 WHEN kind = 9 AND qty <= 1 THEN qty * 1000 END AS q,
         CASE WHEN kind NOT IN (8, 9) THEN price END AS p FROM w
)
SELECT order_id, d AS date, CASE kind % 3 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Home & Garden' ELSE FALLBACK END AS category, CAPS AS product_name, CAST(q AS BIGINT) AS quantity, p AS unit_price,
       CASE flag WHEN 'A' THEN 'North' WHEN 'N' THEN 'South' ELSE 'Mid West' END AS region, concat('clerk ', clerk) AS salesperson,
       array_to_string(list_filter([CASE WHEN kind = 10 THEN 'date' END, CASE WHEN kind IN (8, 11) OR kind = 9 AND qty > 1 THEN 'quantity' END, CASE WHEN kind IN (8, 9) THEN 'unit_price' END], lambda v: v IS NOT NULL), ' ') AS rejected
FROM y""".replace("FALLBACK", _caps("item")).replace("CAPS", _caps("item"))
ORACLE["product_records"] = """WITH n AS (SELECT page_id AS i FROM pages), cost AS (SELECT i, lpad(CAST((i * 7) % 100 AS VARCHAR), 2, '0') AS cents FROM n)
SELECT i AS page_id, CAST(0 AS BIGINT) AS pod_no, concat('set > ', i) AS title, CAST(concat(i % 90 + 10, '.', cents) AS DOUBLE) AS price,
       CAST(CASE WHEN i % 6 = 5 THEN 0 ELSE i % 6 + 1 END AS BIGINT) AS rating, 'Unknown' AS availability FROM cost
UNION ALL
SELECT i, 1, concat('part & ', i), CAST(concat((i * 3) % 90 + 10, '.', cents) AS DOUBLE), 2, 'In stock' FROM cost"""
