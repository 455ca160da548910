"""Demand, tickets, promotions, funnel, city trends, refunds."""

from oracle.prelude import cavg, money, pct, ptile, rdiv


def plan(night: str) -> str:
    return f""", c AS (SELECT extract(dow FROM ts)::INT AS day_of_week, hour(ts)::INT AS hour, min(dayname(ts)) AS day_name, count(*) AS orders, {cavg('total_c')} AS avg_order_value FROM ord GROUP BY 1, 2),
 n AS (SELECT *, round({rdiv('sum(orders) OVER w', 'count(*) OVER w', 1)}*10)::BIGINT AS s10, sum(orders) OVER () AS tot, count(*) OVER () AS k FROM c
  WINDOW w AS (PARTITION BY day_of_week ORDER BY hour ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
SELECT day_name, day_of_week, hour, lpad(hour::VARCHAR,2,'0')||':00' AS hour_label, orders, {rdiv('s10', '10', 0)} AS smoothed_orders, avg_order_value, {pct('orders*k', 'tot', 1)} AS demand_index,
 CASE WHEN hour IN (12,13,14) THEN 'Lunch Rush 🍱' WHEN hour IN (19,20,21,22) THEN 'Dinner Rush 🍽️' WHEN {night} THEN 'Late Night 🌙' WHEN hour IN (7,8,9) THEN 'Breakfast 🌅' ELSE 'Off-Peak' END AS time_period,
 CASE WHEN orders*k*10>tot*18 THEN 'Max staffing needed' WHEN orders*k*10>tot*13 THEN 'Increased staffing' WHEN orders*k*10>tot*8 THEN 'Normal staffing' ELSE 'Reduced staffing OK' END AS staffing_recommendation FROM n"""


def friday(p: int) -> str:
    return f""", q AS (SELECT zid, extract(dow FROM ts) AS w, count(*) AS n FROM ord WHERE dlv GROUP BY 1, 2), z AS (SELECT zid, max(n) FILTER (WHERE w=5) AS f, sum(n) AS s, count(*) AS k FROM q GROUP BY zid)
SELECT zone_name, city_name, f AS friday_orders, {rdiv('s', 'k', 0)} AS avg_daily_orders, {rdiv('f*k', 's', 2)} AS friday_spike FROM z JOIN zn ON zone_id=zid JOIN city USING (city_id) WHERE f*k*100>s*{p}"""


SQL = {
    "operations_1_demand_plan": plan("false"),
    "operations_1_demand_plan_late_night": plan("hour IN (23,0,1)"),
    "operations_2_ticket_service": f"""SELECT issue_type, priority, count(*) AS total_tickets, count_if(status='Resolved')::BIGINT AS resolved, count_if(status IN ('Open','In Progress'))::BIGINT AS open_tickets,
 count_if(breached)::BIGINT AS sla_breaches, {pct('count_if(breached)', 'count(*)', 1)} AS sla_breach_pct, {rdiv("sum(datediff('second', created_at, resolved_at))", 'count(resolved_at)*3600', 1)} AS avg_resolution_hrs,
 {ptile("datediff('second', created_at, resolved_at)", 90, 1, 3600)} AS p90_resolution_hrs FROM tk GROUP BY 1, 2""",
    "operations_3_promotion_effect": f""", b AS (SELECT round({rdiv('sum(total_c)', 'count(*)', 0)})::BIGINT AS base_c FROM ord WHERE dlv AND pid IS NULL),
 p AS (SELECT pid, count(*) AS n, {rdiv('sum(total_c)', 'count(*)', 0)}::BIGINT AS aov_c, {cavg('disc_c')} AS avg_discount, sum(total_c) AS g, sum(disc_c) AS dc, sum(comm_c) AS k FROM ord WHERE dlv AND pid IS NOT NULL GROUP BY pid)
SELECT promo_code, promo_name, promo_type, {money('value_c')} AS discount_value, n AS promo_orders, {money('aov_c')} AS avg_order_value, {money('base_c')} AS baseline_aov, {money('aov_c-base_c')} AS aov_lift, avg_discount,
 {money('g')} AS total_gmv, {money('dc')} AS total_discount_cost, {money('k')} AS total_commission, {money('k-dc')} AS net_platform_gain, {pct('k-dc', 'dc', 1)} AS promotion_roi_pct FROM p JOIN promo ON promotion_id=pid, b""",
    "operations_4_order_funnel": f""", f AS (SELECT count(*) AS n, count_if(NOT can) AS a, count(confirmed_at) AS b, count(prepared_at) AS c, count(picked_up_at) AS d, count_if(dlv) AS e FROM ord),
 u AS (SELECT unnest(['Placed','Not Cancelled','Confirmed','Prepared','Picked Up','Delivered']) AS stage, unnest([n,a,b,c,d,e])::BIGINT AS orders, n FROM f) SELECT stage, orders, {pct('orders', 'n', 1)} AS conversion_pct FROM u""",
    "operations_5_city_monthly_revenue": f""", g AS (SELECT city_id, m, count(*) AS n, sum(total_c) AS c, count(DISTINCT cid) AS u FROM ord JOIN (SELECT cid, city_id FROM cust) USING (cid) WHERE dlv GROUP BY 1, 2),
 w AS (SELECT *, lag(c) OVER v AS p, sum(c) OVER (v ROWS UNBOUNDED PRECEDING) AS cum, sum(c) OVER (v ROWS 2 PRECEDING) AS s3, count(*) OVER (v ROWS 2 PRECEDING) AS n3 FROM g WINDOW v AS (PARTITION BY city_id ORDER BY m))
SELECT city_name, m AS month, n AS orders, {money('c')} AS revenue, u AS active_customers, {rdiv('c', 'n*100', 2)} AS aov, {money('p')} AS prev_month, {pct('c-p', 'p', 1)} AS mom_growth_pct, {money('cum')} AS cumulative_revenue,
 {rdiv('s3', 'n3*100', 2)} AS ma_3month FROM w JOIN city USING (city_id)""",
    "operations_6_refund_leakage": f"""SELECT m AS month, count_if(refunded)::BIGINT AS refunded_orders, {money('sum(refund_c) FILTER (WHERE refunded)')} AS total_refunds, {money('sum(total_c)')} AS gross_revenue,
 {pct('sum(refund_c) FILTER (WHERE refunded)', 'sum(total_c)', 2)} AS refund_rate_pct, count_if(can)::BIGINT AS cancellations, {pct('count_if(can)', 'count(*)', 2)} AS cancellation_rate_pct, {money('sum(disc_c)')} AS discount_cost,
 {pct('sum(disc_c)', 'sum(total_c)', 2)} AS discount_rate_pct FROM ord GROUP BY m""",
    "i14_tickets_by_status": f"SELECT issue_type, status, count(*) AS tickets, {pct('count(*)', 'sum(count(*)) OVER (PARTITION BY issue_type)', 1)} AS pct_within_type FROM tk GROUP BY 1, 2",
    "i35_order_values": f"""SELECT city_name, extract(dow FROM ts)::INT AS dow, dayname(ts) AS day_name, count(*) AS orders, {cavg('total_c')} AS mean_aov, {ptile('total_c', 50, 2, 100)} AS median_aov, {ptile('total_c', 75, 2, 100)} AS p75_aov,
 {ptile('total_c', 90, 2, 100)} AS p90_aov FROM ord JOIN (SELECT cid, city_id FROM cust) USING (cid) JOIN city USING (city_id) WHERE dlv GROUP BY 1, 2, 3""",
    "i40_friday_zones": friday(130),
    "i40_friday_zones_105": friday(105),
}
