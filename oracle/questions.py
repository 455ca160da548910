"""Stand-alone questions about orders and customers."""

from oracle.prelude import cavg, money, pct, rdiv


def months(n: int, start: str, end: str = "2001-08-01") -> str:
    return f"""SELECT cid AS customer_id, customer_name, customer_tier, k AS active_months FROM (SELECT cid, count(DISTINCT m) AS k FROM ord WHERE dlv AND m BETWEEN DATE '{start}' AND DATE '{end}' GROUP BY cid HAVING count(DISTINCT m)={n}) JOIN cust USING (cid)"""


def ends(limit: str) -> str:
    return f""", q AS (SELECT cid, restaurant_name, ts, row_number() OVER (PARTITION BY cid ORDER BY ts, oid) AS a, row_number() OVER (PARTITION BY cid ORDER BY ts DESC, oid DESC) AS b, count(*) OVER (PARTITION BY cid) AS n
 FROM ord JOIN (SELECT rid, restaurant_name FROM rest) USING (rid) WHERE dlv)
SELECT x.cid AS customer_id, customer_name, x.ts AS first_order_time, x.restaurant_name AS first_restaurant, y.ts AS last_order_time, y.restaurant_name AS last_restaurant, x.n AS total_orders
FROM q x JOIN q y ON x.cid=y.cid AND x.a=1 AND y.b=1 JOIN cust ON cust.cid=x.cid ORDER BY x.cid {limit}"""


def seasoned(n: int) -> str:
    return f"SELECT partner_name, vehicle_type, city_name, {money('rating_c')} AS rating, total_deliveries, {money('earn_c')} AS total_earnings FROM prt JOIN city USING (city_id) WHERE total_deliveries>={n} AND rating_c>=450"


SQL = {
    "i1_orders_per_city": "SELECT city_name, count(*) AS order_count FROM ord JOIN (SELECT cid, city_id FROM cust) USING (cid) JOIN city USING (city_id) WHERE m=DATE '2001-07-01' GROUP BY 1",
    "i3_value_by_payment": f"SELECT pay AS payment_method, count(*) AS orders, {cavg('total_c')} AS avg_order_value, {money('sum(total_c)')} AS total_revenue FROM ord WHERE dlv GROUP BY 1",
    "i4_never_ordered": "SELECT cid AS customer_id, customer_name, email, registration_date FROM cust WHERE cid NOT IN (SELECT cid FROM ord)",
    "i4_never_ordered_1995": "SELECT cid AS customer_id, customer_name, email, registration_date FROM cust WHERE cid NOT IN (SELECT cid FROM ord WHERE d<DATE '1995-07-01')",
    "i4_dormant": "SELECT cid AS customer_id, customer_name, email, registration_date FROM cust WHERE cid NOT IN (SELECT cid FROM ord WHERE dlv AND d>=DATE '2000-08-02')",
    "i6_partners_by_vehicle": "SELECT city_name, vehicle_type, count(*) AS partner_count, count_if(is_active)::BIGINT AS active_partners FROM prt JOIN city USING (city_id) GROUP BY 1, 2",
    "i9_promotion_usage": f"SELECT count(pid) AS promo_orders, count(*) AS total_orders, {pct('count(pid)', 'count(*)', 2)} AS promo_usage_pct FROM ord",
    "i12_orders_by_hour": f"SELECT hour(ts)::INT AS hour, count(*) AS order_count, {cavg('total_c')} AS avg_order_value FROM ord WHERE NOT can GROUP BY 1",
    "i13_big_spenders": f"SELECT cid AS customer_id, customer_name, customer_tier, n AS orders_last_30d, {money('c')} AS spend_last_30d FROM (SELECT cid, count(*) AS n, sum(total_c) AS c FROM ord WHERE dlv AND d>=DATE '2001-07-03' GROUP BY cid) q JOIN cust USING (cid) WHERE c>1000000",
    "i19_food_explorers": """SELECT cid AS customer_id, customer_name, customer_tier, k AS unique_cuisines_tried, r AS unique_restaurants, n AS total_orders FROM (SELECT cid, count(DISTINCT cuisine_type) AS k, count(DISTINCT rid) AS r, count(*) AS n
 FROM ord JOIN (SELECT rid, cuisine_type FROM rest) USING (rid) WHERE dlv GROUP BY cid) q JOIN cust USING (cid) WHERE k>=5""",
    "i21_seasoned_partners": seasoned(500),
    "i21_seasoned_partners_50": seasoned(50),
    "i23_active_every_month": months(6, "2001-03-01"),
    "i23_active_every_month_2": months(2, "2001-06-01", "2001-07-01"),
    "i25_above_own_average": f""", q AS (SELECT cid, count(*) AS n, sum(total_c) AS s FROM ord WHERE dlv GROUP BY cid)
SELECT oid AS order_id, customer_name, {money('total_c')} AS this_order, {rdiv('s', 'n*100', 6)} AS customer_avg, {rdiv('total_c*n-s', 'n*100', 2)} AS above_avg_by FROM ord JOIN q USING (cid) JOIN (SELECT cid, customer_name FROM cust) USING (cid)
WHERE dlv AND total_c*n*2>s*3 ORDER BY above_avg_by DESC, oid LIMIT 20""",
    "i30_first_and_last": ends("LIMIT 20"),
    "i30_first_and_last_all": ends(""),
    "i38_more_in_second_quarter": """, q AS (SELECT cid, count_if(quarter(d)=1) AS a, count_if(quarter(d)=2) AS b FROM ord WHERE dlv AND year(d)=2001 GROUP BY cid)
SELECT customer_name, customer_tier, a::BIGINT AS q1_orders, b::BIGINT AS q2_orders, (b-a)::BIGINT AS improvement FROM q JOIN cust USING (cid) WHERE b>a ORDER BY b-a DESC, cid LIMIT 20""",
    "nb6_status_distribution": f"SELECT st AS order_status, count(*) AS count, {pct('count(*)', '(SELECT count(*) FROM ord)', 1)} AS pct FROM ord GROUP BY 1",
    "rd1_demand_by_day_name": f""", c AS (SELECT dayname(ts) AS day_name, hour(ts)::INT AS hour_of_day, count(*) AS n, {cavg('total_c')} AS avg_order_value FROM ord GROUP BY 1, 2)
SELECT day_name, hour_of_day, n AS orders, avg_order_value, {rdiv('n*(SELECT count(*) FROM c)', '(SELECT sum(n) FROM c)', 2)} AS demand_index FROM c""",
}
