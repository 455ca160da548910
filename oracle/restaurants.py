"""Restaurants, cuisines, menus."""

from oracle.prelude import money, pct, rdiv

SALES = ", s AS (SELECT rid, count(*) AS n, sum(total_c) AS c FROM ord WHERE dlv GROUP BY rid)"
ITEMS = ", it AS (SELECT item_id, count(order_item_id) AS n, sum(item_c) AS c FROM oi JOIN (SELECT oid FROM ord WHERE dlv) USING (oid) GROUP BY item_id)"
NAMED = "(SELECT rid, restaurant_name, cuisine_type, city_name, joining_date, total_orders, rating_c, is_active FROM rest JOIN city USING (city_id))"


def health(fix: bool) -> str:
    m, t, fan, food = (("1", "coalesce(t,0)", "1", 4) if fix else
                       ("greatest(coalesce(t,0),1)", "coalesce(t,0)", "greatest(coalesce(rc,0),1)", 20))
    w = "1" if fix else "greatest(coalesce(t,0),1)"
    return f""", tt AS (SELECT oid, count(*) AS t FROM tk GROUP BY oid),
a AS (SELECT rid, sum({m}) AS n, sum(CASE WHEN can THEN {m} ELSE 0 END) AS x, sum(CASE WHEN d>=DATE '2001-07-03' THEN {m} ELSE 0 END) AS l30, sum({t}) AS tk,
 sum(mins*{w}) AS ms, sum(CASE WHEN mins IS NOT NULL THEN {w} END) AS mc FROM ord LEFT JOIN (SELECT oid, mins FROM dl) USING (oid) LEFT JOIN tt USING (oid) GROUP BY rid),
f AS (SELECT rid, count(*) AS rc, round({rdiv('sum(food)', 'count(food)', 2)}*100)::BIGINT AS food_c FROM rv GROUP BY rid),
h AS (SELECT rid, restaurant_name, cuisine_type, city_name, rating_c, food_c, round({rdiv('ms', 'mc', 1)}*10)::BIGINT AS prep10,
 (coalesce(n,0)*{fan})::BIGINT AS n, (coalesce(x,0)*{fan})::BIGINT AS x, (coalesce(l30,0)*{fan})::BIGINT AS l30, (coalesce(tk,0)*{fan})::BIGINT AS tk
 FROM {NAMED} LEFT JOIN a USING (rid) LEFT JOIN f USING (rid) WHERE is_active)
SELECT rid AS restaurant_id, restaurant_name, cuisine_type, city_name, n AS total_orders, l30 AS orders_last_30d, food_c::DOUBLE/100 AS avg_food_rating,
 rating_c::DOUBLE/100 AS platform_rating, {pct('x', 'n', 2)} AS cancellation_rate_pct, prep10::DOUBLE/10 AS avg_prep_to_delivery, tk AS support_tickets,
 {rdiv(f'(coalesce(food_c,0)*{food} + least(2000, l30*20) + rating_c*4 + greatest(0, 2000-coalesce(prep10,400)*10))*greatest(n,1) + CASE WHEN n>0 THEN 100*greatest(0, 20*n-200*x) ELSE 0 END', 'greatest(n,1)*100', 1)} AS health_score,
 CASE WHEN food_c>=450 AND 100*x<3*n THEN '⭐ Star Partner' WHEN food_c>=400 THEN '✅ Good Partner' WHEN food_c<350 THEN '⚠️  Needs Improvement' ELSE '📊 Average' END AS partner_status FROM h"""


SQL = {
    "re1_monthly_ranking": f""", a AS (SELECT rid, m, count(*) AS n, sum(total_c) AS c, sum(comm_c) AS k, count(DISTINCT cid) AS u FROM ord WHERE dlv GROUP BY 1, 2),
 b AS (SELECT *, lag(c) OVER (PARTITION BY rid ORDER BY m) AS p FROM a)
SELECT rid AS restaurant_id, restaurant_name, cuisine_type, city_name, m AS month, n AS orders, {money('c')} AS revenue, {money('k')} AS platform_revenue, u AS unique_customers,
 {money('p')} AS prev_month_rev, {pct('c-p', 'p', 1)} AS mom_growth_pct, rank() OVER (PARTITION BY m ORDER BY c DESC) AS month_rank,
 ntile(4) OVER (PARTITION BY m ORDER BY c, rid)::INT AS revenue_quartile,
 coalesce({pct('rank() OVER (PARTITION BY m ORDER BY c)-1', 'count(*) OVER (PARTITION BY m)-1', 1)},0) AS revenue_percentile FROM b JOIN {NAMED} USING (rid)""",
    "re2_cuisine_share": SALES + f""" SELECT cuisine_type, count(*) AS restaurants, sum(n)::BIGINT AS total_orders, {money('sum(c)')} AS total_revenue, {rdiv('sum(c)', 'sum(n)*100', 2)} AS avg_order_value,
 {rdiv('sum(rating_c*n)', 'sum(n)*100', 2)} AS avg_restaurant_rating, {pct('sum(c)', '(SELECT sum(c) FROM s)', 2)} AS revenue_share_pct, rank() OVER (ORDER BY sum(c) DESC)::INT AS revenue_rank
 FROM s JOIN rest USING (rid) GROUP BY cuisine_type""",
    "re3_health_scores": health(False),
    "re3_health_scores_corrected": health(True),
    "re4_top_items": ITEMS + f""", r AS (SELECT item_id, item_name, restaurant_name, cuisine_type, price_c, is_vegetarian, is_bestseller, n, c, rank() OVER (ORDER BY n DESC)::INT AS r1,
  rank() OVER (ORDER BY c DESC) AS r2, rank() OVER (PARTITION BY cuisine_type ORDER BY n DESC)::INT AS r3 FROM it JOIN item USING (item_id) JOIN rest USING (rid))
SELECT item_id, item_name, restaurant_name, cuisine_type, {money('price_c')} AS price, is_vegetarian, is_bestseller, n AS times_ordered, {money('c')} AS total_revenue,
 r1 AS order_freq_rank, r2 AS revenue_rank, r3 AS cuisine_rank, is_bestseller AS officially_bestseller FROM r ORDER BY n DESC, item_id LIMIT 50""",
    "re5_onboarding_ramp": f""", q AS (SELECT rid, d, row_number() OVER (PARTITION BY rid ORDER BY ts, oid) AS k FROM ord WHERE dlv),
 g AS (SELECT rid, max(d) FILTER (WHERE k=100) AS d1, max(d) FILTER (WHERE k=500) AS d5 FROM q GROUP BY rid), t AS (SELECT rid, count(*) AS n, min(d) AS f FROM ord GROUP BY rid HAVING count(*)>=100)
SELECT restaurant_name, cuisine_type, city_name, joining_date, n AS total_orders, f AS first_order_date, d1 AS date_100th_order, datediff('day', joining_date, d1)::INT AS days_to_100_orders,
 datediff('day', joining_date, d5)::INT AS days_to_500_orders, CASE WHEN d1-joining_date<=30 THEN 'Fast Ramp' WHEN d1-joining_date<=60 THEN 'Normal Ramp' WHEN d1-joining_date<=90 THEN 'Slow Ramp' ELSE 'Struggling' END AS ramp_category
FROM t LEFT JOIN g USING (rid) JOIN {NAMED} USING (rid)""",
    "i2_rated_active": f"SELECT rid AS restaurant_id, restaurant_name, cuisine_type, {money('rating_c')} AS rating, total_orders FROM rest WHERE is_active AND rating_c>450",
    "i7_cancellation_by_cuisine": f"""SELECT cuisine_type, count(*) AS total_orders, count_if(can)::BIGINT AS cancellations, {pct('count_if(can)', 'count(*)', 2)} AS cancel_rate_pct
FROM ord JOIN (SELECT rid, cuisine_type FROM rest) USING (rid) GROUP BY 1""",
    "i10_recent_busy": f"SELECT rid AS restaurant_id, restaurant_name, cuisine_type, city_name, joining_date, total_orders, {money('rating_c')} AS rating FROM {NAMED} WHERE joining_date>=DATE '2001-05-02' AND total_orders>100",
    "i10_recent_busy_84": f"SELECT rid AS restaurant_id, restaurant_name, cuisine_type, city_name, joining_date, total_orders, {money('rating_c')} AS rating FROM {NAMED} WHERE joining_date>=DATE '1994-08-02' AND total_orders>100",
    "i11_ratings_by_cuisine": f"""SELECT cuisine_type, {rdiv('sum(food)', 'count(food)', 2)} AS avg_food_rating, {rdiv('sum(dr)', 'count(dr)', 2)} AS avg_delivery_rating, count(*) AS review_count
FROM rv JOIN rest USING (rid) GROUP BY 1 HAVING count(*)>=50""",
    "i15_unreviewed": f"SELECT rid AS restaurant_id, restaurant_name, cuisine_type, city_name, joining_date, total_orders FROM {NAMED} WHERE is_active AND rid NOT IN (SELECT rid FROM rv)",
    "i16_city_ranking": SALES + f""" SELECT city_name, restaurant_name, {money('c')} AS revenue, rank() OVER (PARTITION BY city_name ORDER BY c DESC) AS city_rank, dense_rank() OVER (ORDER BY c DESC) AS overall_dense_rank FROM s JOIN {NAMED} USING (rid)""",
    "i17_second_cuisine": SALES + f""" SELECT city_name, cuisine_type, sum(n)::BIGINT AS second_place_orders FROM s JOIN {NAMED} USING (rid) GROUP BY 1, 2 QUALIFY rank() OVER (PARTITION BY city_name ORDER BY sum(n) DESC)=2""",
    "i22_peak_hours": """, h AS (SELECT rid, hour(ts) AS h, count(*) AS n FROM ord WHERE dlv GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY rid ORDER BY count(*) DESC, hour(ts))=1)
SELECT restaurant_name, cuisine_type, h||':00' AS peak_hour, n AS peak_hour_orders FROM h JOIN rest USING (rid) ORDER BY n DESC, rid LIMIT 20""",
    "i26_improved_ratings": f""", q AS (SELECT rid, date_trunc('month', created_at)::DATE AS m, round({rdiv('sum(food)', 'count(food)', 2)}*100)::BIGINT AS a FROM rv GROUP BY 1, 2)
SELECT restaurant_name, cuisine_type, city_name, {money('x.a')} AS current_rating, {money('y.a')} AS rating_3m_ago, {money('x.a-y.a')} AS improvement
FROM q x JOIN q y ON x.rid=y.rid AND x.m=DATE '2001-08-01' AND y.m=DATE '2001-05-01' AND x.a>y.a JOIN {NAMED} nm ON nm.rid=x.rid""",
    "i26_improved_ratings_july": f""", q AS (SELECT rid, date_trunc('month', created_at)::DATE AS m, round({rdiv('sum(food)', 'count(food)', 2)}*100)::BIGINT AS a FROM rv GROUP BY 1, 2)
SELECT restaurant_name, cuisine_type, city_name, {money('x.a')} AS current_rating, {money('y.a')} AS rating_3m_ago, {money('x.a-y.a')} AS improvement
FROM q x JOIN q y ON x.rid=y.rid AND x.m=DATE '2001-07-01' AND y.m=DATE '2001-04-01' AND x.a>y.a JOIN {NAMED} nm ON nm.rid=x.rid""",
    "i28_longest_streaks": """, q AS (SELECT DISTINCT rid, d FROM ord WHERE dlv), g AS (SELECT rid, d - row_number() OVER (PARTITION BY rid ORDER BY d)::INT AS g FROM q), r AS (SELECT rid, count(*) AS n FROM g GROUP BY rid, g)
SELECT restaurant_name, max(n) AS longest_streak_days FROM r JOIN rest USING (rid) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "i29_weekday_weekend": f""", q AS (SELECT restaurant_name, total_c, extract(dow FROM ts) IN (0,6) AS we FROM ord JOIN (SELECT rid, restaurant_name FROM rest) USING (rid) WHERE dlv)
SELECT restaurant_name, {rdiv('sum(total_c) FILTER (WHERE NOT we)', 'count_if(NOT we)*100', 2)} AS weekday_aov, {rdiv('sum(total_c) FILTER (WHERE we)', 'count_if(we)*100', 2)} AS weekend_aov,
 count_if(NOT we)::BIGINT AS weekday_orders, count_if(we)::BIGINT AS weekend_orders FROM q GROUP BY 1 HAVING count(*)>100 ORDER BY round(weekend_aov*100)-round(weekday_aov*100) DESC NULLS LAST, 1 LIMIT 20""",
    "i34_declining": f""", q AS (SELECT rid, m, sum(total_c) AS c FROM ord WHERE dlv GROUP BY 1, 2), w AS (SELECT *, lag(c,1) OVER v AS a, lag(c,2) OVER v AS b, lag(c,3) OVER v AS e FROM q WINDOW v AS (PARTITION BY rid ORDER BY m))
SELECT restaurant_name, cuisine_type, city_name, m AS month, {money('c')} AS current_revenue, {money('a')} AS prev_1m, {money('b')} AS prev_2m, {money('e')} AS prev_3m
FROM w JOIN {NAMED} USING (rid) WHERE m=DATE '2001-08-01' AND c<a AND a<b AND b<e""",
    "i34_declining_july": f""", q AS (SELECT rid, m, sum(total_c) AS c FROM ord WHERE dlv GROUP BY 1, 2), w AS (SELECT *, lag(c,1) OVER v AS a, lag(c,2) OVER v AS b, lag(c,3) OVER v AS e FROM q WINDOW v AS (PARTITION BY rid ORDER BY m))
SELECT restaurant_name, cuisine_type, city_name, m AS month, {money('c')} AS current_revenue, {money('a')} AS prev_1m, {money('b')} AS prev_2m, {money('e')} AS prev_3m
FROM w JOIN {NAMED} USING (rid) WHERE m=DATE '2001-07-01' AND c<a AND a<b AND b<e""",
    "i5_popular_items": """SELECT item_name, restaurant_name, cuisine_type, sum(quantity)::BIGINT AS total_quantity_ordered, count(DISTINCT oid) AS orders_containing_item
FROM oi JOIN (SELECT item_id, item_name FROM item) USING (item_id) JOIN rest USING (rid) GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2 LIMIT 10""",
    "i39_abc_items": ITEMS + f""", w AS (SELECT item_id, c, sum(c) OVER (ORDER BY c DESC, item_id ROWS UNBOUNDED PRECEDING) AS r FROM it), p AS (SELECT *, {pct('r', '(SELECT sum(c) FROM it)', 2)} AS cp FROM w)
SELECT item_name, restaurant_name, {money('c')} AS revenue, cp AS cumulative_pct, CASE WHEN cp<=80 THEN 'A - Core (top 80%)' WHEN cp<=95 THEN 'B - Important (80-95%)' ELSE 'C - Long Tail' END AS abc_class
FROM p JOIN item USING (item_id) JOIN rest USING (rid) ORDER BY c DESC, item_id LIMIT 50""",
    "i39_abc_items_all": ITEMS + f""", w AS (SELECT item_id, c, sum(c) OVER (ORDER BY c DESC, item_id ROWS UNBOUNDED PRECEDING) AS r FROM it), p AS (SELECT *, {pct('r', '(SELECT sum(c) FROM it)', 2)} AS cp FROM w)
SELECT item_name, restaurant_name, {money('c')} AS revenue, cp AS cumulative_pct, CASE WHEN cp<=80 THEN 'A - Core (top 80%)' WHEN cp<=95 THEN 'B - Important (80-95%)' ELSE 'C - Long Tail' END AS abc_class
FROM p JOIN item USING (item_id) JOIN rest USING (rid)""",
    "i42_ordered_together": """, q AS (SELECT oid, item_name, cuisine_type FROM oi JOIN (SELECT item_id, item_name FROM item) USING (item_id) JOIN (SELECT rid, cuisine_type FROM rest) USING (rid))
SELECT item_name, cuisine_type, count(DISTINCT oid) AS co_order_count FROM q WHERE cuisine_type<>'Pizza' AND oid IN (SELECT oid FROM q WHERE cuisine_type='Pizza') GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 15""",
    "nb8_top_cuisines": SALES + f""" SELECT cuisine_type, sum(n)::BIGINT AS orders, {rdiv('sum(c)', '100', 0)} AS revenue, {rdiv('sum(c)', 'sum(n)*100', 2)} AS aov FROM s JOIN rest USING (rid) GROUP BY 1 ORDER BY revenue DESC, 1 LIMIT 12""",
}
