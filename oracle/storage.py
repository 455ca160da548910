"""Loading, storing, refreshing, reporting, searching and global order."""

from oracle.prelude import money, sql
from oracle.quality import CATS
from oracle.reports import SQL as REPORTS
from oracle.executive import SQL as EXECUTIVE
from oracle.views import SQL as VIEWS

SIZES = {"cities": "city", "zones": "zn", "restaurants": "rest", "menu_categories": CATS, "menu_items": "item", "customers": "cust", "customer_addresses": "customer",
         "delivery_partners": "prt", "promotions": "promo", "orders": "ord", "order_items": "oi", "deliveries": "dl", "payments": "pay", "reviews": "rv",
         "support_tickets": "tk", "order_status_history": "hist"}
LOADED = {"restaurants": ("rest", "sum(rating_c)"), "menu_items": ("item", "sum(price_c)"), "customers": ("cust", "sum(city_id)*100"), "delivery_partners": ("prt", "sum(rating_c)"),
          "orders": ("ord", "sum(total_c)"), "order_items": ("oi", "sum(item_c)"), "deliveries": ("dl", "sum(earn_c)"), "payments": ("pay", "sum(amount_c)")}
REPORT = {"platform_kpis": EXECUTIVE["ru1_platform_kpis"], "peak_hours": REPORTS["ru2_peak_cells"], "top_restaurants": REPORTS["ru3_top_restaurants"],
          "rfm_segments": REPORTS["ru4_rfm_segments"], "delivery_performance": REPORTS["ru5_delivery_profiles"], "churn_segments": REPORTS["ru6_churn_segments"]}
STORED = {"daily_kpi": "v2_daily_kpi", "restaurant_performance": "v3_restaurant_performance", "hourly_demand": "v4_hourly_demand",
          "partner_performance": "v5_partner_performance", "customer_rfm": "v6_customer_rfm"}


FIGURES = {"daily_kpi": "total_orders", "restaurant_performance": "total_orders", "hourly_demand": "order_count",
           "partner_performance": "total_deliveries", "customer_rfm": "recency_days"}
REPORT_FIGURES = {"platform_kpis": "gmv", "peak_hours": "order_count", "top_restaurants": "gross_revenue",
                  "rfm_segments": "total_revenue", "delivery_performance": "total_deliveries", "churn_segments": "customers"}


def views(names) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS view, (SELECT count(*) FROM ({sql(VIEWS[STORED[n]])})) AS rows, (SELECT sum({FIGURES[n]})::BIGINT FROM ({sql(VIEWS[STORED[n]])})) AS figure" for n in names)


def grams(word: str) -> str:
    return f"list_transform(range(1, length({word})+2), lambda i: substr('  '||{word}||' ', i::INT, 3))"


def pieces(text: str) -> str:
    words = f"list_filter(regexp_split_to_array(lower({text}), '[^0-9a-z]+'), lambda w: length(w)>0)"
    return f"list_distinct(flatten(list_transform({words}, lambda w: {grams('w')})))"


SQL = {
    "s1_csv_round_trip": " UNION ALL ".join(f"SELECT '{t}' AS entity, count(*) AS rows, {money(f)} AS figure FROM {r}" for t, (r, f) in LOADED.items()),
    "s12_table_sizes": " UNION ALL ".join(f"SELECT '{t}' AS entity, count(*) AS rows FROM {r}" for t, r in SIZES.items()),
    "s10_inserted_customers": "SELECT cid AS customer_id, CASE WHEN cid%2=0 THEN upper(customer_name) ELSE customer_name END || '!' AS customer_name FROM cust",
    "s11_filled_zones": """, z AS (SELECT city_id, city_name, unnest(range(1, 11))::INT AS z FROM city),
 n AS (SELECT city_id, count(*) AS n FROM ord JOIN zn ON zid=zone_id GROUP BY 1)
SELECT (city_id-1)*10+z AS zone_id, city_id, city_name||' Zone '||z AS zone_name, 20+2*z AS avg_delivery_time_mins, true AS is_active, coalesce(n, 0) AS orders_in_city FROM z LEFT JOIN n USING (city_id)""",
    "s15_report_run": " UNION ALL ".join(f"SELECT '{n}' AS query, (SELECT count(*) FROM ({sql(q)})) AS rows, true AS as_stated, (SELECT sum({REPORT_FIGURES[n]})::DECIMAL(20,2) FROM ({sql(q)})) AS figure" for n, q in REPORT.items()),
    "s16_order_store": f"SELECT m AS month, count(*) AS orders, {money('sum(total_c)')} AS total_amount FROM ord GROUP BY 1",
    "s18_refreshed_views": views(STORED),
    "s19_after_load": views([n for n in STORED if n != "customer_rfm"]),
    "f21_name_search": f""", nm AS (SELECT DISTINCT item_name FROM item), g AS (SELECT item_name, {pieces('item_name')} AS a, {pieces("'blue rings'")} AS b FROM nm),
 h AS (SELECT item_name, len(list_intersect(a, b)) AS s, len(a)+len(b)-len(list_intersect(a, b)) AS u FROM g)
SELECT item_name, round(s*1000.0/u)/10 AS similarity_pct FROM h WHERE u>0 AND s*100>=u*30""",
    "f21_indexed_search": f""", nm AS (SELECT DISTINCT item_name FROM item), qs AS (SELECT * FROM (VALUES (0,'blue rings'),(1,'gren froste'),(2,'smoke almnd linen'),(3,'x'),(4,'')) v(query_id, query)),
 g AS (SELECT query_id, item_name, {pieces('item_name')} AS a, {pieces('query')} AS b FROM nm, qs),
 h AS (SELECT query_id, item_name, len(list_intersect(a, b)) AS s, len(a)+len(b)-len(list_intersect(a, b)) AS u, len(b) AS n FROM g)
SELECT query_id::INT AS query_id, item_name AS name, round(s*1000.0/u)/10 AS similarity_pct FROM h WHERE n>0 AND u>0 AND s*100>=u*30""",
    "g1_global_order": f""", sp AS (SELECT cid, count(*) AS n, sum(total_c) AS c FROM ord WHERE dlv GROUP BY cid)
SELECT cid AS customer_id, n AS orders, {money('c')} AS spent, row_number() OVER (ORDER BY n DESC, cid) AS position, rank() OVER (ORDER BY n DESC) AS rank, dense_rank() OVER (ORDER BY n DESC) AS dense_rank,
 count(*) OVER () AS customers, ntile(7) OVER (ORDER BY n DESC, cid)::INT AS tile, {money('sum(c) OVER (ORDER BY n DESC, cid ROWS UNBOUNDED PRECEDING)')} AS running_spent FROM sp""",
}
