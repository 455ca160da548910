"""Detail view and summary views."""

from oracle.prelude import cavg, money, pct, rdiv

AS_OF = "DATE '2001-08-02'"

DAILY = f""", daily AS (
 SELECT d AS day, extract(dow FROM d)::INT AS day_of_week, dayname(d) AS day_name,
  extract(hour FROM min(ts))::INT AS peak_start_hour,
  count(*) AS total_orders, count_if(dlv)::BIGINT AS delivered_orders, count_if(can)::BIGINT AS cancelled_orders,
  count(DISTINCT cid) AS active_customers, count(DISTINCT rid) AS active_restaurants,
  sum(total_c) AS gross_c, sum(comm_c) AS plat_c, sum(disc_c) AS disc_c, {cavg('total_c')} AS avg_order_value,
  {pct('count_if(can)', 'count(*)', 2)} AS cancellation_rate_pct
 FROM ord GROUP BY d)"""

DEMAND = f""", cells AS (
 SELECT extract(dow FROM ts)::INT AS day_of_week, hour(ts)::INT AS hour_of_day, min(dayname(ts)) AS day_name,
  count(*) AS n, {cavg('total_c')} AS avg_order_value, sum(total_c) AS rev_c FROM ord WHERE NOT can GROUP BY 1, 2),
demand AS (
 SELECT day_of_week, day_name, hour_of_day, n AS order_count, avg_order_value, {money('rev_c')} AS total_revenue,
  {pct('n', '(SELECT sum(n) FROM cells)', 3)} AS pct_of_total,
  {rdiv('n*(SELECT count(*) FROM cells)', '(SELECT sum(n) FROM cells)', 3)} AS demand_index FROM cells)"""

RESTPERF = f""", rs AS (
 SELECT rid, count(*) AS total_orders, count_if(dlv)::BIGINT AS delivered_orders, sum(total_c) AS rev_c, sum(comm_c) AS plat_c,
  {cavg('total_c')} AS avg_order_value, count(DISTINCT cid) AS unique_customers FROM ord WHERE NOT can GROUP BY rid),
rr AS (SELECT rid, count(*) AS review_count, {rdiv('sum(food)', 'count(food)', 2)} AS avg_food_rating,
  {rdiv('sum(ov)', 'count(ov)', 2)} AS avg_overall_rating FROM rv GROUP BY rid),
restperf AS (
 SELECT r.rid AS restaurant_id, restaurant_name, cuisine_type, city_name, {money('rating_c')} AS rating, is_active, joining_date,
  rs.total_orders, delivered_orders, {money('rev_c')} AS gross_revenue, {money('plat_c')} AS platform_revenue, avg_order_value,
  unique_customers, review_count, avg_food_rating, avg_overall_rating,
  rank() OVER (ORDER BY rev_c DESC NULLS LAST) AS revenue_rank,
  rank() OVER (PARTITION BY cuisine_type ORDER BY rev_c DESC NULLS LAST) AS cuisine_revenue_rank,
  coalesce({pct('rank() OVER (ORDER BY rev_c NULLS LAST) - 1', 'count(*) OVER () - 1', 1)}, 0) AS revenue_percentile
 FROM rest r JOIN city USING (city_id) LEFT JOIN rs ON rs.rid=r.rid LEFT JOIN rr ON rr.rid=r.rid)"""

PARTPERF = f""", pd AS (
 SELECT partner_id, count(*) AS n, count_if(done) AS done, {rdiv('sum(mins)', 'count(mins)', 1)} AS avg_t,
  {rdiv('sum(km_c)', 'count(km_c)*100', 2)} AS avg_km, sum(earn_c) AS earn_c, count_if(breached) AS late, count_if(on_time) AS ok
 FROM dl GROUP BY partner_id),
partperf AS (
 SELECT p.partner_id, partner_name, vehicle_type, city_name, zone_name, {money('rating_c')} AS partner_rating, rating_c, joining_date,
  coalesce(n,0)::BIGINT AS total_deliveries, coalesce(done,0)::BIGINT AS completed_deliveries, avg_t AS avg_delivery_time,
  avg_km AS avg_distance_km, {money('pd.earn_c')} AS total_earnings, coalesce(late,0)::BIGINT AS sla_breaches,
  coalesce(ok,0)::BIGINT AS on_time_deliveries, {pct('coalesce(ok,0)', 'coalesce(done,0)', 1)} AS on_time_rate_pct,
  rank() OVER (ORDER BY coalesce(n,0) DESC) AS delivery_count_rank,
  ntile(4) OVER (ORDER BY coalesce(n,0), p.partner_id)::INT AS performance_quartile
 FROM prt p JOIN city USING (city_id) LEFT JOIN zn ON zn.zone_id=p.zone_id LEFT JOIN pd ON pd.partner_id=p.partner_id
 WHERE p.is_active)"""

RFM = f""", rb AS (
 SELECT cid, datediff('day', max(d), {AS_OF}) AS rec, count(DISTINCT oid) AS freq, sum(total_c) AS mon_c FROM ord WHERE dlv GROUP BY cid),
rk AS (
 SELECT *, ntile(5) OVER (ORDER BY rec DESC, cid)::INT AS r, ntile(5) OVER (ORDER BY freq, cid)::INT AS f,
  ntile(5) OVER (ORDER BY mon_c, cid)::INT AS m FROM rb),
rfm AS (
 SELECT cid AS customer_id, customer_name, customer_tier, rec::INT AS recency_days, freq AS frequency, mon_c, {money('mon_c')} AS monetary,
  r AS r_score, f AS f_score, m AS m_score, r+f+m AS rfm_total,
  CASE WHEN least(r,f,m)>=4 THEN 'Champions' WHEN least(r,f)>=3 THEN 'Loyal' WHEN r>=4 AND f<=2 THEN 'Promising'
   WHEN r<=2 AND f>=4 THEN 'At Risk' WHEN greatest(r,f)=1 THEN 'Lost' ELSE 'Needs Attention' END AS rfm_segment
 FROM rk JOIN cust USING (cid))"""

SQL = {
    "v1_order_detail": f"""SELECT oid AS order_id, ts AS order_timestamp, d AS order_date, st AS order_status, channel AS order_channel,
 cid AS customer_id, customer_name, customer_tier, city_name AS customer_city, ord.rid AS restaurant_id, restaurant_name, cuisine_type,
 zone_name, {money('sub_c')} AS subtotal_amount, {money('disc_c')} AS discount_amount, {money('ord.fee_c')} AS delivery_fee,
 {money('tax_c')} AS taxes, {money('total_c')} AS total_amount, {money('comm_c')} AS platform_commission, pay AS payment_method,
 dl.partner_id, partner_name, mins AS actual_time_mins, expected AS expected_time_mins, {money('km_c')} AS distance_km,
 breached AS sla_breached, on_time, food AS food_rating, dr AS delivery_rating, ov AS overall_rating
 FROM ord JOIN cust USING (cid) JOIN city USING (city_id) JOIN rest ON rest.rid=ord.rid LEFT JOIN zn ON zn.zone_id=zid
 LEFT JOIN dl USING (oid) LEFT JOIN prt ON prt.partner_id=dl.partner_id LEFT JOIN (SELECT oid, food, dr, ov FROM rv) USING (oid)""",
    "v2_daily_kpi": DAILY + f""" SELECT day, day_of_week, day_name, peak_start_hour, total_orders, delivered_orders, cancelled_orders,
 active_customers, active_restaurants, {money('gross_c')} AS gross_revenue, {money('plat_c')} AS platform_revenue,
 {money('disc_c')} AS discounts_given, avg_order_value, cancellation_rate_pct FROM daily""",
    "v3_restaurant_performance": RESTPERF + " SELECT * FROM restperf",
    "v4_hourly_demand": DEMAND + " SELECT * FROM demand",
    "v5_partner_performance": PARTPERF + " SELECT * EXCLUDE (rating_c) FROM partperf",
    "v6_customer_rfm": RFM + " SELECT * EXCLUDE (mon_c) FROM rfm",
}
